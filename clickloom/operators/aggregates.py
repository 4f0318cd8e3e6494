"""Aggregations.

Everything here is a hash aggregate with a map-side part, so a hot key costs one
partial row per task.  Scalars that feed back into rows are scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.codes import cut
from clickloom.functions.packed_time import whole


def value_counts(df: DataFrame, *columns: str, keep_null: bool = False, name: str = "n") -> DataFrame:
    """Rows per value; rows with a null key are dropped unless ``keep_null``."""
    rows = df if keep_null else df.dropna(subset=list(columns))
    return rows.groupBy(*columns).agg(F.count("*").alias(name))


def count_of_counts(df: DataFrame, column: str) -> DataFrame:
    """How many values occur how often."""
    return value_counts(df, column, name="occurs").groupBy("occurs").agg(F.count("*").alias("n"))


def count_per_key(df: DataFrame, key: str, other: str, name: str) -> DataFrame:
    """Non-null values of ``other`` per key."""
    return df.dropna(subset=[key]).groupBy(key).agg(F.count(other).alias(name))


def distinct_per_key(df: DataFrame, key: str, other: str, name: str = "n_distinct") -> DataFrame:
    return df.groupBy(key).agg(F.count_distinct(other).alias(name))


def conversion_ratio(df: DataFrame, key: str, label: str = "label") -> DataFrame:
    """Clicks, conversions and their ratio by key, in one scan.

    A key without conversions has null conversions and a null ratio.
    """
    counted = df.groupBy(key).agg(
        F.count("*").alias("clicks"),
        F.nullif(F.count_if(F.col(label) == 1), F.lit(0)).alias("conversions"))
    return counted.withColumn("ratio", F.col("conversions") / F.col("clicks"))


def scale_min_max(df: DataFrame, column: str, fitted_on: DataFrame | None = None) -> DataFrame:
    """Rescale ``column`` to [0, 1]; null when all values are equal.

    The bounds come from ``fitted_on`` (default: ``df`` itself).
    """
    base = df if fitted_on is None else fitted_on
    bounds = base.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("b")).scalar()
    value = F.try_divide(F.col(column) - F.col("_b.lo"), F.col("_b.hi") - F.col("_b.lo"))
    return df.withColumn("_b", bounds).withColumn(column, value).drop("_b")


def normalised_ratio(df: DataFrame, key: str, name: str) -> DataFrame:
    """Conversion ratio by key, rescaled to [0, 1] over the keys."""
    ratio = conversion_ratio(df, key).select(key, F.col("ratio").alias(name))
    return scale_min_max(ratio, name)


def top_category(df: DataFrame, user: str = "userID", category: str = "appCategory",
                 name: str = "cat_pref") -> DataFrame:
    """Most frequent known category per user; the smallest category wins a tie.

    Count and category are compared as one long (the category, a non-negative
    integer, in its low half, falling), so that both steps are hash aggregates.
    """
    known = df.filter(F.col(category) != schemas.UNKNOWN_CODE).dropna(subset=[user])
    counted = known.groupBy(user, category).agg(F.count("*").alias("n"))
    low = 1 << 32
    best = F.max(F.col("n") * low - F.col(category))
    return counted.groupBy(user).agg(F.pmod(-best, F.lit(low)).cast("int").alias(name))


def click_profile(df: DataFrame, user: str = "userID") -> DataFrame:
    """Clicks and conversions per user, their ratio and the click-count bin."""
    counted = df.groupBy(user).agg(
        F.count("*").alias("click_count"),
        F.count_if(F.col("label") == 1).alias("conversion_count"))
    return counted.select(
        user, "click_count", "conversion_count",
        cut(F.col("click_count"), schemas.CLICK_COUNT_EDGES).alias("click_count_group"),
        (F.col("conversion_count") / F.col("click_count")).alias("conversion_ratio_click"))


def describe(df: DataFrame, *columns: str) -> DataFrame:
    """One row per column: count, min, max, mean and sample deviation of the non-null values.

    One aggregate over all columns; the single row is then unpivoted.
    """
    stats = []
    for c in columns:
        value = F.col(c).cast("double")
        stats.append(F.struct(
            F.lit(c).alias("column"), F.count(value).alias("n"), F.min(value).alias("min"),
            F.max(value).alias("max"), F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std")).alias(c))
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def sizes(df: DataFrame, *columns: str, approximate: bool = False) -> DataFrame:
    """Row count and the number of distinct values of each column.

    Exact distinct counts of several columns in one aggregate multiply the rows;
    here each column is its own two-step count, joined as scalars.
    ``approximate`` uses one pass of sketches instead.
    """
    if approximate:
        return df.agg(F.count("*").alias("rows"),
                      *[F.approx_count_distinct(c).alias(f"distinct_{c}") for c in columns])
    row = df.agg(F.count("*").alias("rows"))
    for c in columns:
        distinct = df.select(c).dropna().distinct().agg(F.count("*").alias("n")).scalar()
        row = row.withColumn(f"distinct_{c}", distinct)
    return row


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Positives, negatives and the whole number of negatives per positive."""
    counted = df.agg(F.count_if(F.col(label) == 1).alias("positives"),
                     F.count_if(F.col(label) == 0).alias("negatives"))
    ratio = F.floor(F.try_divide(F.col("negatives"), F.col("positives")))
    return counted.withColumn("negatives_per_positive", ratio.cast("long"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed, empty bins included.

    ``bin`` counts from 0; when all values are equal they fall in the middle bin.
    """
    spark = df.sparkSession
    values = df.select(F.col(column).cast("double").alias("v")).dropna()
    bounds = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("b")).scalar()
    width = F.col("b.hi") - F.col("b.lo")
    position = F.least(F.floor((F.col("v") - F.col("b.lo")) * bins / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    number = F.when(width == 0, F.lit(bins // 2)).otherwise(position).cast("int")
    counted = (values.withColumn("b", bounds).select(number.alias("bin"))
               .groupBy("bin").agg(F.count("*").alias("n")))
    every = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def paired_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows per pair of values: the data of a scatter plot."""
    return df.groupBy(first, second).agg(F.count("*").alias("n"))


def single_click_users(df: DataFrame, user: str = "userID", label: str = "label") -> DataFrame:
    """Users with exactly one click, and how many of those clicks converted."""
    per_user = df.groupBy(user).agg(F.count("*").alias("clicks"), F.max(label).alias("converted"))
    once = per_user.filter(F.col("clicks") == 1)
    return once.agg(F.count("*").alias("users"), F.count_if(F.col("converted") == 1).alias("converted"))


def value_distribution(df: DataFrame, column: str, digits: int = 6) -> DataFrame:
    """Rows per value of a real column, compared at ``digits`` decimals."""
    return (df.select(F.round(column, digits).alias(column)).dropna()
            .groupBy(column).agg(F.count("*").alias("n")))


def top_values(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The ``k`` most frequent values; smaller values win ties."""
    return value_counts(df, column).orderBy(F.desc("n"), F.asc(column)).limit(k)


def fold_summary(scores: DataFrame, by: str | Sequence[str], *measures: str) -> DataFrame:
    """Mean and population deviation of each measure across folds."""
    keys = [by] if isinstance(by, str) else list(by)
    parts: list[Column] = []
    for m in measures:
        parts += [F.avg(m).alias(f"mean_{m}"), F.stddev_pop(m).alias(f"std_{m}")]
    return scores.groupBy(*keys).agg(*parts)


def weight_by_hour(df: DataFrame, packed: str, name: str = "hour_weight") -> DataFrame:
    """Rows per hour of a packed time."""
    hour = (whole(F.col(packed), 100) % 100).cast("int")
    return value_counts(df.select(hour.alias("hour")), "hour", name=name)
