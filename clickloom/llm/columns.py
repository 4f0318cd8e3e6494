"""Columns that only pass through an operator, out of the way of the operator's own names."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame


def shield(df: DataFrame, used: Sequence[str]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``df`` with all columns but ``used`` under names of no meaning, and the way back.

    ``back(out, added)`` gives them their names again; a column that bears the name of an added one is dropped for it.
    """
    hidden = {c: f"loom_passes_{i}" for i, c in enumerate(df.columns) if c not in used}

    def back(out: DataFrame, added: Sequence[str] = ()) -> DataFrame:
        out = out.drop(*[inner for c, inner in hidden.items() if c in added])
        return out.withColumnsRenamed({inner: c for c, inner in hidden.items() if inner in out.columns})

    return df.withColumnsRenamed(hidden), back
