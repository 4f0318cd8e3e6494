"""Joins.

No side is broadcast by hint: whether a table is small enough is left to its
measured size.  Where one key holds a large share of the left rows, adaptive
execution splits that partition; it does so only if the right side comes straight
from a shuffle, not out of an aggregate.  So key sets are made distinct (collapsing
hot keys in the map task) and written before the join, and tables joined by
``lookup``, ``matching`` or ``star`` should be written tables too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.codes import same_known_or_unknown
from clickloom.session import pin


def lookup(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left outer equi-join with a table that has one row per key; left columns first, in their order."""
    added = [c for c in right.columns if c not in left.columns]
    return left.join(right, on, "left").select(*left.columns, *added)


def lookup_placed(left: DataFrame, right: DataFrame, on: Sequence[str], hot_share: float = 1 / 256) -> DataFrame:
    """``lookup`` in a table that is stored in buckets by ``on`` (``read_placed``): its rows stay where they are.

    Only the left side is shuffled.  Adaptive execution cannot split a key then, so keys with at least ``hot_share`` of
    the left rows are counted first (there are at most ``1 / hot_share``), and their rows meet the few right rows in a broadcast
    where they are; rows with a null key pass through.
    """
    on, added = list(on), [c for c in right.columns if c not in left.columns]
    columns = [*left.columns, *added]
    missing = F.lit(False)
    for c in on:
        missing = missing | F.col(c).isNull()
    counts = pin(left.filter(~missing).groupBy(*on).agg(F.count("*").alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.filter(F.col("_n") >= max(total * hot_share, 2)).select(*on)
    absent = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in added]
    out = left.filter(missing).select(*left.columns, *absent)
    if not hot.isEmpty():
        few = pin(hot.join(right, on, "left").withColumn("_hot", F.lit(True)), "hot-keys")        # at most 1 / hot_share rows
        marked = left.filter(~missing).join(F.broadcast(few), on, "left")
        out = out.unionByName(marked.filter(F.col("_hot")).select(*columns))
        left = marked.filter(F.col("_hot").isNull()).select(*left.columns)
    return out.unionByName(left.filter(~missing).join(right, on, "left").select(*columns))


def matching(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner equi-join."""
    return left.join(right, on, "inner")


def key_set(keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Distinct keys as a written table."""
    return pin(keys.select(*([on] if isinstance(on, str) else on)).distinct(), "keys")


def members(df: DataFrame, keys: DataFrame, on: str | Sequence[str], unique: bool = False) -> DataFrame:
    """Rows whose key occurs in ``keys``; null keys never match.

    ``unique`` says that ``keys`` is already a written table with one row per key.
    """
    return df.join(keys if unique else key_set(keys, on), on, "left_semi").select(*df.columns)


def non_members(df: DataFrame, keys: DataFrame, on: str | Sequence[str], unique: bool = False) -> DataFrame:
    """Rows whose key does not occur in ``keys``."""
    return df.join(keys if unique else key_set(keys, on), on, "left_anti").select(*df.columns)


def members_of_both(df: DataFrame, first: DataFrame, second: DataFrame,
                    first_key: str, second_key: str, unique: bool = False) -> DataFrame:
    """Rows whose first key is in ``first`` and whose second key is in ``second`` (not pairwise)."""
    return members(members(df, first, first_key, unique), second, second_key, unique)


def flag_members(df: DataFrame, keys: DataFrame, on: Sequence[str], name: str, unique: bool = False) -> DataFrame:
    """Boolean column: does the key combination of the row occur in ``keys``?"""
    marked = (keys.select(*on) if unique else key_set(keys, on)).withColumn(name, F.lit(True))
    return lookup(df, marked, list(on)).withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def star(fact: DataFrame, user: DataFrame, ad: DataFrame) -> DataFrame:
    """Fact joined with its user and ad groups, plus the preferred-category flag."""
    wide = matching(matching(fact, user, "userID"), ad, "creativeID")
    flag = same_known_or_unknown(F.col("appCategory"), F.col("cat_pref"))
    return wide.withColumn("is_pref_cat", flag)


def aligned(left: DataFrame, right: DataFrame, key: str, combine) -> DataFrame:
    """Arithmetic on two keyed series: full outer join, null where either side is missing.

    ``combine(left_value, right_value)`` gives the result column; both inputs have
    the columns ``key`` and ``value``.
    """
    a = left.select(key, F.col("value").alias("_left"))
    b = right.select(key, F.col("value").alias("_right"))
    value: Column = combine(F.col("_left"), F.col("_right"))
    return a.join(b, key, "full").select(key, value.alias("value"))
