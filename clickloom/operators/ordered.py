"""Operators that depend on row order.

Order is always named, never taken from storage.  Two kinds of input occur:

* raw rows, where one key may hold a large share of the table: these are cut
  into time chunks (``carry_forward``, ``as_of``) or ranges of the full sort key
  (``with_row_index``, ``tag_blocks``), so no key is gathered in one task;
* regular grids, which have at most span / step rows per series whatever the
  number of raw rows behind them: these use windows per series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.calendar import epoch, in_days, plus_seconds
from clickloom.session import pin

DAY = 86400
# candidate chunk lengths, longest first, and the rows one key may have in a chunk
CHUNKS = [30 * DAY, DAY, 3600, 60, 1]
CHUNK_ROWS = 2_000_000
# right sides of as-of joins up to this size are cut into intervals, which the left side meets without being moved
SMALL_RIGHT, PER_BUCKET = 100_000, 64


# --- filling -----------------------------------------------------------------

def pick_chunk(df: DataFrame, keys: Sequence[str], order: str, limit: int = CHUNK_ROWS) -> int:
    """Longest chunk, in seconds, of which no key has more than ``limit`` rows.

    The rows are counted once, by key and minute, and these counts are summed for all candidates together, in one job that
    writes nothing.  The shortest is one second: times are unique within a key and have microseconds, so it
    holds a million rows at most.
    """
    minute = F.floor(epoch(F.col(order)) / 60)
    counted = df.groupBy(*keys, minute.alias("_minute")).agg(F.count("*").alias("n"))
    each = counted.withColumn("_length", F.explode(F.array(*[F.lit(c) for c in CHUNKS[:-1]])))
    held = each.groupBy(*keys, "_length", F.floor(F.col("_minute") * 60 / F.col("_length"))).agg(F.sum("n").alias("n"))
    most = {r["_length"]: r.n for r in held.groupBy("_length").agg(F.max("n").alias("n")).collect()}
    return next((c for c in CHUNKS[:-1] if most.get(c, 0) <= limit), CHUNKS[-1])


def _carry(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str],
           chunk: int | None, forward: bool, then: Sequence[str] = ()) -> DataFrame:
    """``then`` orders rows of one key and time, of which only one may hold a value."""
    chunk = chunk or pick_chunk(df, keys, order)
    chunked = df.withColumn("_chunk", F.floor(epoch(F.col(order)) / chunk))
    part = [*keys, "_chunk"]
    sort = [F.col(c).asc() if forward else F.col(c).desc() for c in (order, *then)]
    inside = Window.partitionBy(*part).orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)

    # last known value of each chunk: one small row per chunk, combined before the shuffle
    pick = F.max_by if forward else F.min_by
    edges = chunked.groupBy(*part).agg(
        *[pick(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])
    chunk_sort = F.col("_chunk").asc() if forward else F.col("_chunk").desc()
    before = Window.partitionBy(*keys).orderBy(chunk_sort).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(*part, *[F.last(c, ignorenulls=True).over(before).alias(f"_carry_{c}")
                                    for c in columns])

    local = chunked.select("*", *[F.last(c, ignorenulls=True).over(inside).alias(f"_local_{c}")
                                  for c in columns])
    joined = local.join(carried, part, "left")
    filled = {c: F.coalesce(f"_local_{c}", f"_carry_{c}") for c in columns}
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def carry_forward(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str],
                  chunk: int | None = None) -> DataFrame:
    """Replace nulls by the last non-null value at or before the row; leading nulls stay.

    ``order`` is a timestamp, unique within ``keys`` (which must not be null).
    Rows are sorted within chunks of ``chunk`` seconds (default: ``pick_chunk``), so
    that one hot key is many tasks; what a chunk inherits comes from a table with
    one row per key and chunk.
    """
    return _carry(df, keys, order, columns, chunk, forward=True)


def carry_backward(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str],
                   chunk: int | None = None) -> DataFrame:
    """Replace nulls by the first non-null value at or after the row; trailing nulls stay."""
    return _carry(df, keys, order, columns, chunk, forward=False)


def _intervals(left: DataFrame, right: DataFrame, order: str, columns: Sequence[str], keys: Sequence[str],
               small: int) -> tuple[DataFrame, int, int] | None:
    """Written table of the right rows with the time each is valid until, one row per bucket of time it reaches into; with
    the first time and the width of the buckets (seconds).  None if there are more than ``small`` rows or one bucket is crowded.

    There are about as many buckets as rows of a key, up to the last time of the left side: the table has at most a few times the rows.
    """
    at = epoch(F.col(order))
    ends = right.agg(F.count("*").alias("rows"), F.min(at).alias("begin"), F.max(at).alias("end"),
                     (F.approx_count_distinct(F.struct(*keys)) if keys else F.lit(1)).alias("of")).first()
    if ends.begin is None or ends.rows > small:
        return None
    end = max(ends.end, left.agg(F.max(at).alias("end")).first().end or ends.end)
    width = max(1, (end - ends.begin) * max(1, ends.of) // ends.rows)
    following = F.lead(order).over(Window.partitionBy(*keys).orderBy(order))     # at most ``small`` rows
    rows = right.dropna(subset=[*keys, order]).select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], F.col(order).alias("_r_from"), following.alias("_r_until"), *columns)
    first = F.floor((epoch(F.col("_r_from")) - ends.begin) / width)
    last = F.floor((F.coalesce(epoch(F.col("_r_until")), F.lit(end)) - ends.begin) / width)
    reach = pin(rows.withColumn("_r_bucket", F.explode(F.sequence(first, F.greatest(first, last)))), "intervals")
    seen = reach.groupBy("_r_bucket", *[f"_r_{k}" for k in keys]).agg(
        F.count("*").alias("n"), F.max(F.col("_r_from") == F.col("_r_until")).alias("twice")).agg(
        F.max("n").alias("most"), F.max("twice").alias("twice")).first()
    if seen.twice:
        raise ValueError(_repeated(keys, order))
    return (reach, ends.begin, width) if seen.most <= PER_BUCKET else None


def _repeated(keys: Sequence[str], order: str) -> str:
    return f"right rows of an as-of join repeat {[*keys, order]}"


def as_of(left: DataFrame, right: DataFrame, order: str, columns: Sequence[str],
          keys: Sequence[str] = (), chunk: int | None = None, small: int = SMALL_RIGHT) -> DataFrame:
    """Join to each left row the last right row at or before its time; none gives nulls.

    ``right`` is unique in (keys, order), null keys and times aside, which no left row finds; if it is not, that is a ValueError
    whatever its size.  A right side of at most ``small`` rows is counted, written as intervals spread over
    buckets of time, and joined on the bucket: it is broadcast by its size, and the left side stays where it is.

    Otherwise only times are sorted: each distinct (keys,
    order) of the left side finds the time of its right row, then two equi-joins bring
    the columns.  So many left rows with one key or one time are only ever moved by a
    join, and wide right rows by one.
    """
    cut = _intervals(left, right, order, columns, keys, small) if small else None
    if cut:
        reach, begin, width = cut
        inside = (F.floor((epoch(F.col(order)) - begin) / width) == F.col("_r_bucket")) & (F.col(order) >= F.col("_r_from")) & (
            F.col("_r_until").isNull() | (F.col(order) < F.col("_r_until")))
        for k in keys:
            inside = inside & (F.col(k) == F.col(f"_r_{k}"))
        return left.join(reach, inside, "left").drop("_r_bucket", "_r_from", "_r_until", *[f"_r_{k}" for k in keys])
    on = [*keys, order]
    known = right.dropna(subset=on)
    if not known.groupBy(*on).count().filter(F.col("count") > 1).isEmpty():      # counts collapse before they are moved
        raise ValueError(_repeated(keys, order))
    chunk = chunk or pick_chunk(left.select(*on).unionByName(right.select(*on)), keys, order)
    asks = left.select(*on).distinct().withColumns({"_found": F.lit(None).cast("timestamp_ntz"), "_ask": F.lit(True)})
    offers = right.select(*on, F.col(order).alias("_found"), F.lit(False).alias("_ask"))
    # at equal times the offer sorts before the ask
    filled = _carry(offers.unionByName(asks), keys, order, ["_found"], chunk, forward=True, then=["_ask"])
    rows = right.select(*keys, F.col(order).alias("_found"), *columns)
    found = filled.filter("_ask").drop("_ask").join(rows, [*keys, "_found"], "left").drop("_found")
    return left.join(found, on, "left")


def impute_operator(df: DataFrame, user: str = "userID", operator: str = "telecomsOperator") -> DataFrame:
    """Fill unknown operators (0 or null) of users whose clicks name exactly one other operator.

    A user qualifies with exactly two distinct codes, one of them 0: then the
    smallest and largest known code agree and that code fills the gaps.  All
    other gaps become 0.  Plain min/max aggregates need no distinct count.  The users
    to fill are written, so that the join is planned from their size and can split a
    hot user.
    """
    code = F.col(operator)
    known = F.when(code != schemas.UNKNOWN_CODE, code)
    per_user = df.groupBy(user).agg(
        F.min(known).alias("_low"), F.max(known).alias("_high"),
        F.max(code == schemas.UNKNOWN_CODE).alias("_gap"))
    fill = pin(per_user.filter((F.col("_low") == F.col("_high")) & F.col("_gap")).select(
        user, F.col("_low").alias("_fill")), "fill")
    missing = code.isNull() | (code == schemas.UNKNOWN_CODE)
    value = F.when(missing, F.coalesce("_fill", F.lit(schemas.UNKNOWN_CODE))).otherwise(code)
    return df.join(fill, user, "left").withColumn(operator, value).select(*df.columns)


# --- regular grids -------------------------------------------------------------

def fill_forward(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """``carry_forward`` for regular series: one window per series, one reference to the input."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in columns})


def fill_backward(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """``carry_backward`` for regular series."""
    upto = Window.partitionBy(*keys).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in columns})


def rolling_mean(df: DataFrame, keys: Sequence[str], order: str, column: str, size: int = 3,
                 name: str = "rolling_mean") -> DataFrame:
    """Trailing mean of ``size`` rows of a regular series; null until that many values exist."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(1 - size, 0)
    mean = F.when(F.count(column).over(frame) == size, F.avg(column).over(frame))
    return df.withColumn(name, mean)


def _without_outliers(value: Column, mean: Column, deviation: Column, sigmas: float) -> Column:
    outlier = F.abs(value - mean) > sigmas * deviation
    return F.when(F.coalesce(outlier, F.lit(False)), F.lit(None)).otherwise(value)


def drop_outliers(df: DataFrame, column: str, keys: Sequence[str] = (), sigmas: float = 3) -> DataFrame:
    """Null every value further than ``sigmas`` sample deviations from the mean of its key.

    For raw rows: the statistics are a pre-aggregated, written table that is joined back.
    """
    value = F.col(column)
    if keys:
        stats = pin(df.groupBy(*keys).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std")), "spread")
        spread = df.join(stats, list(keys), "left")
    else:
        stats = df.agg(F.struct(F.avg(value).alias("m"), F.stddev_samp(value).alias("s")).alias("b")).scalar()
        spread = df.withColumn("_b", stats).withColumn("_mean", F.col("_b.m")).withColumn("_std", F.col("_b.s"))
    kept = _without_outliers(value, F.col("_mean"), F.col("_std"), sigmas)
    return spread.withColumn(column, kept).select(*df.columns)


def clean_series(df: DataFrame, keys: Sequence[str], order: str, column: str, sigmas: float = 3) -> DataFrame:
    """Regular series whose outliers become the last ordinary value.

    Statistics and filling are windows by series: one shuffle, one scan.
    """
    whole = Window.partitionBy(*keys)
    value = F.col(column)
    kept = _without_outliers(value, F.avg(value).over(whole), F.stddev_samp(value).over(whole), sigmas)
    return fill_forward(df.withColumn(column, kept), keys, order, [column])


def decompose(df: DataFrame, keys: Sequence[str], order: str, column: str, step: int,
              period: int) -> DataFrame:
    """Additive decomposition of a regular series without gaps.

    Adds ``trend`` (centred moving average over ``period`` rows; for an even
    period both ends count half; null near the edges), ``seasonal`` (mean of
    value - trend per phase, centred to mean zero), ``residual``, and
    ``seasonal_level`` = seasonal + mean trend + mean residual.

    The moving average is a difference of running sums, so its cost does not grow
    with the period.  All windows cluster by the series key: one shuffle.
    """
    whole = Window.partitionBy(*keys)
    ordered = whole.orderBy(order)
    running = ordered.rowsBetween(Window.unboundedPreceding, 0)
    half = period // 2
    rows = df.withColumn("_sum", F.sum(column).over(running)).withColumn("_n", F.count(column).over(running))

    def between(name: str, first: int, last: int) -> Column:
        upper = F.lead(name, last).over(ordered)
        lower = F.coalesce(F.lag(name, 1 - first).over(ordered), F.lit(0))
        return upper - lower

    if period % 2 == 0:
        total = between("_sum", -half, half - 1) + between("_sum", 1 - half, half)
        trend, need = total / (2 * period), period + 1
        have = between("_n", -half, half)
    else:
        trend, need = between("_sum", -half, half) / period, period
        have = between("_n", -half, half)
    rows = rows.withColumn("trend", F.when(have == need, trend))

    position = (epoch(F.col(order)) - F.min(epoch(F.col(order))).over(whole)) / step
    rows = rows.withColumn("_phase", (position % period).cast("int"))
    phase = Window.partitionBy(*keys, "_phase")
    rows = rows.withColumn("_raw", F.avg(F.col(column) - F.col("trend")).over(phase))
    # mean over phases: each phase weighs the same, however many rows it has
    weight = F.lit(1.0) / F.count("*").over(phase)
    rows = rows.withColumn("_weight", weight)
    centre = F.sum(F.col("_raw") * F.col("_weight")).over(whole) / F.sum("_weight").over(whole)
    rows = rows.withColumn("seasonal", F.col("_raw") - centre)
    rows = rows.withColumn("residual", F.col(column) - F.col("trend") - F.col("seasonal"))
    level = F.col("seasonal") + F.avg("trend").over(whole) + F.avg("residual").over(whole)
    return rows.withColumn("seasonal_level", level).select(
        *df.columns, "trend", "seasonal", "residual", "seasonal_level")


def shift_cycle(df: DataFrame, order: str, first: str, last: str, days: int) -> DataFrame:
    """Rows of the days ``first`` to ``last``, moved ``days`` later: a seasonal-naive forecast."""
    moved = plus_seconds(F.col(order), F.lit(days * DAY))
    return df.filter(in_days(F.col(order), first, last)).withColumn(order, moved)


# --- positions -------------------------------------------------------------------

def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row in the given total order.

    Rows are range-partitioned on the whole sort key (ending in a unique column, so
    that equal leading values spread over tasks), numbered inside each range and
    written once; the position is that number plus the sizes of the ranges before.
    The table of range sizes has one row per partition, hence the broadcast.
    """
    placed = pin(df.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("_at", F.monotonically_increasing_id()), "row-index")
    placed = (placed.withColumn("_range", F.shiftright("_at", 33))
              .withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1)))
    count = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = count.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (placed.join(F.broadcast(starts), "_range")
            .withColumn(name, F.col("_start") + F.col("_at"))
            .select(*df.columns, name))


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows in the given order (n may be large: no limit operator)."""
    return with_row_index(df, order, "_row").filter(F.col("_row") < n).drop("_row")


def every_nth(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """Rows 0, n, 2n, ... in the given order."""
    return with_row_index(df, order, "_row").filter(F.col("_row") % n == 0).drop("_row")


def tag_blocks(df: DataFrame, order: Sequence[str], starts: Callable[[int], Sequence[int]],
               name: str) -> DataFrame:
    """Number consecutive blocks of the ordered rows; ``starts(n)`` gives the first
    position of blocks 1, 2, ... for ``n`` rows.

    Only the sort key is sorted; the key at each block start (a handful of rows)
    then decides the block of every row by comparison, so the wide rows are not
    moved.  ``order`` must identify a row and hold no nulls: equal rows on both sides of a start are an error.
    """
    keys = with_row_index(df.select(*order), order, "_row")
    ranks = list(starts(keys.count()))
    types = dict(keys.dtypes)
    near = {*ranks, *(rank - 1 for rank in ranks)}
    found = {row["_row"]: row for row in keys.filter(F.col("_row").isin(list(near))).collect()} if ranks else {}
    cuts = [found[rank] for rank in sorted(set(ranks)) if rank in found]
    for cut in cuts:
        before = found.get(cut["_row"] - 1)
        if before is not None and all(before[c] == cut[c] for c in order):
            raise ValueError(f"rows are equal in {list(order)} where a block begins")
    key = F.struct(*order)
    block = F.lit(0)
    for cut in cuts:
        start = F.struct(*[F.lit(str(cut[c])).cast(types[c]).alias(c) for c in order])
        block = block + F.when(key >= start, 1).otherwise(0)
    return df.withColumn(name, block)
