"""Importing this module registers every query."""

from clickloom.workload import (  # noqa: F401
    aggregate_queries,
    closed_form_queries,
    group_queries,
    join_queries,
    model_queries,
    row_queries,
    series_queries,
    sources_queries,
)
from clickloom.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
