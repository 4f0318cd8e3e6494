"""Construction of regular series, lag blocks and training matrices."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions import calendar as cal
from clickloom.operators.ordered import (
    as_of,
    carry_forward,
    drop_outliers,
    fill_backward,
    fill_forward,
)

STEP = 1200  # seconds per slot
SLOTS = 6  # slots per block
BLOCK = STEP * SLOTS
REPORT_CHUNK = 30 * 86400


def extract_series(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """Key columns, time ``ts`` and ``value`` of all series at once."""
    return df.select(*keys, F.col(ts).alias("ts"), F.col(value).alias("value"))


def first_last_day(df: DataFrame, ts: str) -> tuple[date, date]:
    """First and last day of the rows (one aggregate); 1970-01-01 without rows."""
    row = df.agg(F.to_date(F.min(ts)).alias("begin"), F.to_date(F.max(ts)).alias("end")).first()
    return row.begin or date(1970, 1, 1), row.end or date(1970, 1, 1)


def bin_means(df: DataFrame, keys: Sequence[str], step: int = STEP) -> DataFrame:
    """Mean value per left-closed bin of ``step`` seconds; empty bins are absent."""
    return (df.groupBy(*keys, cal.bin_start(F.col("ts"), step).alias("ts"))
            .agg(F.avg("value").alias("value")))


def _interval(step: int) -> Column:
    return F.make_dt_interval(secs=F.lit(step).cast("decimal(18,6)"))


def resample(df: DataFrame, keys: Sequence[str], step: int = STEP) -> DataFrame:
    """Regular series from the first to the last bin of each key; empty bins repeat the last mean.

    Each bin that has a mean is stretched up to the next one, which fills the
    gaps without building and joining a grid.  A window sees bins, not raw rows:
    at most span / step per series.
    """
    whole = Window.partitionBy(*keys)
    # bins whose values are all null keep their place: the first and last bin mark the ends
    marked = bin_means(df, keys, step).select(
        "*", F.max("ts").over(whole).alias("_last"), F.min("ts").over(whole).alias("_first"))
    known = marked.filter(F.col("value").isNotNull() | (F.col("ts") == F.col("_first")))
    until = F.coalesce(F.lead("ts").over(whole.orderBy("ts")) - _interval(step), F.col("_last"))
    return (known.withColumn("_until", until)
            .select(*keys, F.explode(F.sequence("ts", "_until", _interval(step))).alias("ts"), "value"))


def resample_onto(df: DataFrame, keys: Sequence[str], start: str, end: str, step: int = STEP) -> DataFrame:
    """``resample`` laid on the grid from ``start`` to ``end``: the head repeats the first mean,
    and times after the last bin are null.

    The same as ``on_grid(resample(df), fill="backward")`` in one pass over the input
    and without a join.
    """
    whole = Window.partitionBy(*keys)
    ordered = whole.orderBy("ts")
    marked = bin_means(df, keys, step).select("*", F.max("ts").over(whole).alias("_last"))
    known = marked.filter(F.col("value").isNotNull())
    following = F.lead("ts").over(ordered)
    first = F.when(F.lag("ts").over(ordered).isNull(), F.least(F.col("ts"), cal.ntz(start))).otherwise(F.col("ts"))
    known = known.select(*keys, "value", first.alias("_from"), following.isNull().alias("_ends"),
                         F.coalesce(following - _interval(step), F.col("_last")).alias("_last"))
    # the final run goes on to the end of the grid, without values after the last bin
    until = F.when(F.col("_ends"), F.greatest(F.col("_last"), cal.ntz(end))).otherwise(F.col("_last"))
    rows = known.select(*keys, "value", "_last", "_ends",
                        F.explode(F.sequence("_from", until, _interval(step))).alias("ts"))
    value = F.when(~F.col("_ends") | (F.col("ts") <= F.col("_last")), F.col("value"))
    return (rows.filter((F.col("ts") >= cal.ntz(start)) & (F.col("ts") <= cal.ntz(end)))
            .select(*keys, "ts", value.alias("value")))


def grid(series: DataFrame, keys: Sequence[str], start: str, end: str, step: int = STEP) -> DataFrame:
    """Every time from ``start`` to ``end`` (inclusive) for every key."""
    times = F.sequence(cal.ntz(start), cal.ntz(end), _interval(step))
    return series.select(*keys).distinct().select(*keys, F.explode(times).alias("ts"))


def on_grid(series: DataFrame, keys: Sequence[str], start: str, end: str, step: int = STEP,
            fill: str | None = None) -> DataFrame:
    """Series on a fixed grid: exact values, with missing ones left null, or filled
    ``backward`` or ``forward`` from the grid rows that have one."""
    laid = grid(series, keys, start, end, step).join(series, [*keys, "ts"], "left")
    if fill == "backward":
        return fill_backward(laid, keys, "ts", ["value"])
    if fill == "forward":
        return fill_forward(laid, keys, "ts", ["value"])
    return laid


def with_head(series: DataFrame, keys: Sequence[str], start: str) -> DataFrame:
    """Prepend one row at ``start`` with the first value, for series that begin later."""
    first = series.groupBy(*keys).agg(F.min_by("value", "ts").alias("value"), F.min("ts").alias("_first"))
    head = first.filter(F.col("_first") > cal.ntz(start)).select(
        *keys, cal.ntz(start).alias("ts"), "value")
    return series.select(*keys, "ts", "value").unionByName(head)


def slot_blocks(series: DataFrame, keys: Sequence[str], name: str = "tt") -> DataFrame:
    """One row per key and two-hour block, with its slot values in ``name_0..5``.

    ``block`` numbers the blocks since 1970.
    """
    seconds = cal.epoch(F.col("ts"))
    placed = series.select(*keys, F.floor(seconds / BLOCK).alias("block"),
                           (F.pmod(seconds, F.lit(BLOCK)) / STEP).cast("int").alias("_slot"), "value")
    return placed.groupBy(*keys, "block").agg(
        *[F.max(F.when(F.col("_slot") == i, F.col("value"))).alias(f"{name}_{i}") for i in range(SLOTS)])


def _slots_of_block(ahead: int, keys: Sequence[str], name: str) -> dict[str, Column]:
    """The six values of the block ``ahead`` of a row's own, for rows with ``_block`` and ``_slot``: windows over a regular grid."""
    there = Window.partitionBy(*keys).orderBy("_block").rangeBetween(ahead, ahead)
    return {f"{name}_{i}": F.max(F.when(F.col("_slot") == i, F.col("value"))).over(there) for i in range(SLOTS)}


def with_previous_block(series: DataFrame, keys: Sequence[str], seasonal: DataFrame | None = None,
                        period: int | None = None) -> DataFrame:
    """Add ``prev_tt_0..5``: the six values of the block before the row's own block.

    Rows of the first block have none; with ``seasonal`` (columns keys, ts, value)
    they get the seasonal values one period after that missing block.  ``series`` is a regular grid; a series that is clustered by
    its keys already is not moved.
    """
    seconds = cal.epoch(F.col("ts"))
    rows = series.withColumns({"_block": F.floor(seconds / BLOCK), "_slot": (F.pmod(seconds, F.lit(BLOCK)) / STEP).cast("int")})
    rows = rows.withColumns(_slots_of_block(-1, keys, "prev_tt"))
    if seasonal is None:
        return rows.drop("_block", "_slot")
    rows = rows.withColumn("_first", F.min("_block").over(Window.partitionBy(*keys)))
    first = (series.groupBy(*keys).agg(F.min("ts").alias("_start"))
             .select(*keys, F.floor(cal.epoch(F.col("_start")) / BLOCK).alias("_seeded")))
    curve = slot_blocks(seasonal, keys, "_seed").withColumn("block", F.col("block") + 1 - period // SLOTS)
    seeds = curve.join(first, list(keys)).filter(F.col("block") == F.col("_seeded")).drop("block", "_seeded")      # one row a key
    filled = {f"prev_tt_{i}": F.when(F.col("_block") == F.col("_first"), F.col(f"_seed_{i}")).otherwise(F.col(f"prev_tt_{i}"))
              for i in range(SLOTS)}
    return (rows.join(seeds, list(keys), "left").withColumns(filled)
            .drop("_block", "_slot", "_first", *[f"_seed_{i}" for i in range(SLOTS)]))


def twelve_slots(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two-hour stride, four-hour width: ``prev_tt_0..5`` and the six targets ``tt_0..5``."""
    past = slot_blocks(series, keys, "prev_tt")
    following = Window.partitionBy(*keys).orderBy("block").rangeBetween(1, 1)
    rows = past.withColumns({**{f"tt_{i}": F.max(f"prev_tt_{i}").over(following) for i in range(SLOTS)},
                             "_more": F.count("*").over(following)})
    return (rows.filter(F.col("_more") > 0).withColumn("ts", cal.from_epoch(F.col("block") * BLOCK))
            .select(*keys, *[f"prev_tt_{i}" for i in range(SLOTS)], *[f"tt_{i}" for i in range(SLOTS)], "ts"))


def clean_weather(weather: DataFrame) -> DataFrame:
    """Weather rows by time, wind-direction outliers replaced by the last ordinary value.

    Reports are hourly at most, so a chunk of 30 days is a few hundred rows.
    """
    placed = weather.withColumn("ts", cal.at_hour(F.col("date"), F.col("hour"))).drop("date", "hour")
    return carry_forward(drop_outliers(placed, "wind_direction"), [], "ts", ["wind_direction"], REPORT_CHUNK)


def add_weather(df: DataFrame, weather: DataFrame) -> DataFrame:
    """The last weather report at or before each row's ``ts``, for rows on a grid of slots.

    Distinct slots and reports of 30 days are a few thousand rows, whatever the number of series.
    """
    return as_of(df, weather, "ts", schemas.WEATHER_COLUMNS, chunk=REPORT_CHUNK)


def add_calendar(df: DataFrame) -> DataFrame:
    return (df.withColumn("time_window_num", cal.slot_of_day(F.col("ts")))
            .withColumn("day_of_week", cal.monday_first(F.col("ts"))))


def unpivot_targets(df: DataFrame, keys: Sequence[str], columns: Sequence[str], lead_seconds: int = 0,
                    name: str = "prediction") -> DataFrame:
    """Wide targets to one row per slot; slot i of a row at ``ts`` is at ts + lead + i steps."""
    slots = df.select(*keys, "ts", F.posexplode(F.array(*columns)).alias("_i", name))
    return slots.select(*keys, cal.plus_seconds(F.col("ts"), F.col("_i") * STEP + lead_seconds).alias("ts"), name)
