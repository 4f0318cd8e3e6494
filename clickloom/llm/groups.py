"""Whole groups out of sorted Arrow batches, and connected components of written edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import pin


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal ``keys`` (integers), from batches in which they stand together."""
    waiting: list[pa.RecordBatch] = []

    def key_of(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(batch.column(k)[row].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            values = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(change).tolist()
        if waiting and key_of(waiting[0], 0) != key_of(batch, 0):
            yield pa.Table.from_batches(waiting)
            waiting = []
        at = 0
        for start in starts:
            yield pa.Table.from_batches([*waiting, batch.slice(at, start - at)])
            waiting, at = [], start
        waiting.append(batch.slice(at))
    if waiting:
        yield pa.Table.from_batches(waiting)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Written table (node, label) for the nodes of a written table of edges (a, b): label is the least node reached.

    Every round a node takes the least label of itself and its neighbours, then the label of its
    label; labels are written after each round, with those before it, so one scan tells when nothing has changed and no link is
    collected.  Hub nodes cost no more than their edges: minima combine in the map task.
    """
    both = pin(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
               .filter(F.col("a") != F.col("b")).distinct(), f"{name}-edges")
    labels = pin(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least"))
                 .select("node", F.least("node", "_least").alias("label")), f"{name}-labels")
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("_of_b"))
        seen = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("_of_b").alias("_seen"))
        moved = pin(labels.join(seen, "node", "left")
                    .select("node", F.col("label").alias("_old"), F.least("label", "_seen").alias("_new")), f"{name}-moved")
        jump = moved.select(F.col("node").alias("_new"), F.col("_new").alias("_next"))
        labels = pin(moved.join(jump, "_new", "left").select(
            "node", "_old", F.least("_new", F.col("_next")).alias("label")), f"{name}-labels")
        if labels.filter(F.col("label") != F.col("_old")).isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
