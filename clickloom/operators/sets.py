"""Set operators on key columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keys_of(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def union_keys(*sets: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, sets).distinct()


def common_keys(first: DataFrame, second: DataFrame) -> DataFrame:
    """Intersection; both sides collapse before they are shuffled for it."""
    return first.distinct().intersect(second.distinct())


def only_in_first(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.distinct().subtract(second.distinct())


def append(*parts: DataFrame) -> DataFrame:
    """Union of all rows, duplicates kept, columns matched by name."""
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def append_checked(key: str, *parts: DataFrame) -> DataFrame:
    """Union of all rows that fails at run time when a key occurs twice.

    The check is part of the same plan: the number of duplicate keys is a scalar
    subquery, and a non-zero number raises.
    """
    whole = append(*parts)
    extra = duplicate_keys(whole, key).agg(F.count("*").alias("n")).scalar()
    good = F.assert_true(extra == 0, F.lit(f"duplicate values of {key}"))
    return whole.filter(good.isNull())


def containment(relations: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """One row per relation: keys of the first set missing in the second.

    Each pair holds two one-column key tables of the same name.
    """
    rows = []
    for name, (inner, outer) in relations.items():
        key = inner.columns[0]
        missing = keys_of(inner, key).join(keys_of(outer, key), key, "left_anti")
        rows.append(missing.agg(F.count("*").alias("missing")).select(
            F.lit(name).alias("relation"), "missing", (F.col("missing") == 0).alias("contained")))
    return reduce(DataFrame.unionByName, rows)


def venn(sets: Mapping[str, DataFrame]) -> DataFrame:
    """Sizes of the regions of a Venn diagram: one boolean column per set, and ``n``.

    Each key carries one bit per set; bits are combined before and after the
    shuffle, so no key set is gathered.
    """
    names = list(sets)
    tagged = [keys.select(F.col(keys.columns[0]).alias("_key"), F.lit(1 << i).alias("_bit"))
              for i, keys in enumerate(sets.values())]
    mask = append(*tagged).groupBy("_key").agg(F.bit_or("_bit").alias("_mask"))
    counted = mask.groupBy("_mask").agg(F.count("*").alias("n"))
    flags = [(F.col("_mask").bitwiseAND(1 << i) != 0).alias(name) for i, name in enumerate(names)]
    return counted.select(*flags, "n")
