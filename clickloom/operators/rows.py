"""Row and column level operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.calendar import hour_in


def move_last(df: DataFrame, *columns: str) -> DataFrame:
    """Reorder so that ``columns`` come last."""
    return df.select(*[c for c in df.columns if c not in columns], *columns)


def replace_where(df: DataFrame, column: str, condition: Column, value) -> DataFrame:
    """Overwrite ``column`` where ``condition`` holds (a null condition does not)."""
    return df.withColumn(column, F.when(condition, F.lit(value)).otherwise(F.col(column)))


def settled_clicks(df: DataFrame, before: int = schemas.LAST_SETTLED_CLICK_TIME) -> DataFrame:
    """Drop late negatives: their conversions may not have been reported yet."""
    return df.filter((F.col("clickTime") < before) | (F.col("label") != 0))


def half_open(df: DataFrame, column: str, begin, end) -> DataFrame:
    return df.filter((F.col(column) >= begin) & (F.col(column) < end))


def choose_samples(df: DataFrame, ts: str, samples: str = "all") -> DataFrame:
    """Training rows by mode: ``all``, ``rush`` (8-10 and 17-19 h) or ``split``.

    ``split`` keeps the rush hours and tags them ``am`` or ``pm`` in ``part``, so
    that one model per part can be fitted.
    """
    if samples not in ("all", "rush", "split"):
        raise ValueError(f"unknown sample mode {samples!r}")
    if samples == "all":
        return df
    rush = df.filter(hour_in(F.col(ts), (8, 10), (17, 19)))
    if samples == "rush":
        return rush
    return rush.withColumn("part", F.when(F.hour(ts) < 12, F.lit("am")).otherwise(F.lit("pm")))


def fill_with_truncated_mean(df: DataFrame, column: str) -> DataFrame:
    """Replace nulls by the mean of the column, truncated to a whole number."""
    mean = df.agg(F.avg(column).cast("long").alias("m")).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def separate_label(df: DataFrame, label: str = "label") -> tuple[list[str], str]:
    """Feature names and label name; both stay in one row."""
    return [c for c in df.columns if c != label], label


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)
