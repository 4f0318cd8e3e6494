"""Sharding by longest-processing-time scheduling of groups that stay together."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.columns import shield
from clickloom.operators.ordered import with_row_index
from clickloom.session import pin


def schedule(items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Largest item first, each to the least-loaded shard (the lowest of equals): a heap of (load, shard)."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for name, size in sorted(items, key=lambda item: (-item[1], item[0])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        placed[name] = shard
    return placed


def group_key(text: Column) -> Column:
    """Equal texts have equal keys; null is a text of its own."""
    return F.coalesce(F.md5(text), F.lit("null"))


def assign_shards(df: DataFrame, shards: int, group: str, size: str, units: int = 1024,
                  name: str = "shard", sizes: DataFrame | None = None) -> DataFrame:
    """Add the shard of each row; rows with equal ``group`` (a string, not null) share one.

    Groups of at least ``1 / (shards * units)`` of all bytes are scheduled on their own.
    There are at most ``shards * units`` of them.  Smaller groups are first bundled by the
    hash of their key into as many bundles, and each bundle is scheduled like a group.  So
    at most ``2 * shards * units`` (name, size) pairs reach the driver's heap, whatever the
    number of rows; below that many groups it is the plain rule.  The shards differ by no
    more than the smallest items placed last, unless one group alone exceeds a shard.

    Groups and sizes are read first, from ``sizes`` (a written table of the two columns) or else from ``df``, which should then be a
    written table.  An empty table stays empty; a null size counts as 0.
    """
    spark = df.sparkSession
    slots = shards * units
    groups = pin((df if sizes is None else sizes).groupBy(F.col(group).alias("_key"))
                 .agg(F.sum(F.coalesce(F.col(size), F.lit(0))).cast("long").alias("_size")), "shard-groups")
    total = groups.agg(F.sum("_size")).first()[0] or 0
    alone = F.col("_size") * slots >= F.lit(max(total, 1))
    bundle = F.concat(F.lit("~"), F.pmod(F.xxhash64("_key"), F.lit(slots)).cast("string"))
    items = (groups.groupBy(F.when(alone, F.col("_key")).otherwise(bundle).alias("_item"))
             .agg(F.sum("_size").alias("_size")))
    placed = schedule([(r._item, r._size) for r in items.collect()], shards)
    table = pd.DataFrame({"_item": list(placed), "_shard": list(placed.values())}).astype({"_shard": "int32"})
    # at most 2 * shards * units rows, hence the broadcast
    of_item = pin(spark.createDataFrame(table, "_item string, _shard int"), "shard-items")
    bundles = of_item.filter(F.col("_item").startswith("~")).select(
        F.col("_item").alias("_bundle"), F.col("_shard").alias("_of_bundle"))
    own = of_item.filter(~F.col("_item").startswith("~")).select(
        F.col("_item").alias("_own"), F.col("_shard").alias("_of_group"))
    df, back = shield(df, [group, size])
    key = F.col(group)
    place = F.concat(F.lit("~"), F.pmod(F.xxhash64(key), F.lit(slots)).cast("string"))
    out = (df.join(F.broadcast(own), key == F.col("_own"), "left")
           .join(F.broadcast(bundles), place == F.col("_bundle"), "left")
           .withColumn(name, F.coalesce("_of_group", "_of_bundle"))
           .drop("_own", "_of_group", "_bundle", "_of_bundle"))
    return back(out, [name])


def with_slots(df: DataFrame, shard: str, order: list[str], name: str = "slot") -> DataFrame:
    """Add the gapless 0-based place of each row in its shard, in the given order.

    Rows are numbered over all shards in ranges of the whole order, so a shard is
    never one task; the number minus the rows of the shards before is the place.  Rows equal in the whole order take their
    places in any order, so name columns that tell rows apart where that matters.
    """
    df, back = shield(df, [shard, *order])
    numbered = with_row_index(df, [shard, *order], "_place")
    # one row per shard
    starts = numbered.groupBy(F.col(shard).alias("_of")).agg(F.min("_place").alias("_first"))
    out = (numbered.join(F.broadcast(starts), F.col(shard) == F.col("_of"))
           .withColumn(name, F.col("_place") - F.col("_first")).select(*df.columns, name))
    return back(out, [name])
