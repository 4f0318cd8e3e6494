"""F and I: ordered operators and regular series."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.calendar import hour_in, plus_seconds
from clickloom.operators import ordered, series
from clickloom.operators.rows import replace_where
from clickloom.operators.series import SLOTS, STEP, extract_series
from clickloom.plans import travel_time as plan
from clickloom.session import pin, scratch_path
from clickloom.streaming.windows import WindowedStream
from clickloom.workload.registry import query, rounded, with_time_text
from clickloom.workload.roles import Roles

KEYS = plan.KEYS
PERIOD = 72  # a season of one day of slots
_TS = "intersection_id, tollgate_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts"
_WEATHER = ", ".join(f"round({c}, 6) AS {c}" for c in schemas.WEATHER_COLUMNS)
_PREVIOUS = ", ".join(f"round(p.v{i}, 6) AS prev_tt_{i}" for i in range(SLOTS))


def grid_ends(r: Roles) -> tuple[str, str]:
    """First slot of the first day with a trip, last slot of the last."""
    first, last = r.days
    return f"{first} 00:00:00", f"{last} 23:40:00"


def last_week(r: Roles) -> tuple[str, str]:
    return str(r.days[1] - timedelta(days=6)), str(r.days[1])


def split_day(r: Roles) -> str:
    """Forecast models are fitted before this time; the last six days test them."""
    return f"{r.days[1] - timedelta(days=5)} 00:00:00"


def regular(r: Roles) -> DataFrame:
    return plan.regular_series(r.trips, *grid_ends(r))


def _shown(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return rounded(with_time_text(df, "ts"), *columns, digits=digits)


def _raw(r: Roles) -> DataFrame:
    return extract_series(r.trips, KEYS, "starting_time", "travel_time")


def _laid(r: Roles) -> DataFrame:
    return series.on_grid(series.resample(_raw(r), KEYS), KEYS, *grid_ends(r), fill="backward")


@query("f01_impute_operator", """
    SELECT userID, clickTime, creativeID, label, telecomsOperator, count(*) AS n FROM clean_wide GROUP BY ALL""")
def impute_operator(r: Roles) -> DataFrame:
    columns = ["userID", "clickTime", "creativeID", "label", "telecomsOperator"]
    return ordered.impute_operator(r.wide).groupBy(*columns).agg(F.count("*").alias("n"))


@query("f01b_impute_by_order", """
    SELECT i.l_orderkey, CASE WHEN flag = 0 THEN coalesce(known, 0) ELSE flag END::INTEGER AS flag, count(*) AS n
    FROM (SELECT l_orderkey, (CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END)::INTEGER AS flag
          FROM lineitem) i
    LEFT JOIN (SELECT l_orderkey, max(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) AS known
               FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 2 AND min(l_returnflag) = 'A') f
         ON f.l_orderkey = i.l_orderkey
    GROUP BY ALL""")
def impute_by_order(r: Roles) -> DataFrame:
    """Orders as users and return flags as operators, A being unknown."""
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    lines = r.table("lineitem").select("l_orderkey", flag.alias("flag"))
    return ordered.impute_operator(lines, "l_orderkey", "flag").groupBy("l_orderkey", "flag").agg(F.count("*").alias("n"))


@query("f02_forward_fill", """
    SELECT event_id, user_id, last_value(v IGNORE NULLS) OVER (
               PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS v
    FROM (SELECT *, CASE WHEN event_type = 'view' THEN value END AS v FROM events)""")
def forward_fill(r: Roles) -> DataFrame:
    """Raw rows: the last value of a view, carried along each user's events."""
    seen = r.table("events").withColumn("v", F.when(F.col("event_type") == "view", F.col("value")))
    return ordered.carry_forward(seen, ["user_id"], "ts", ["v"]).select("event_id", "user_id", "v")


@query("f02b_forward_fill_series", f"""
    SELECT {_TS}, round(last_value(value IGNORE NULLS) OVER (
               PARTITION BY intersection_id, tollgate_id ORDER BY g.ts ROWS UNBOUNDED PRECEDING), 6) AS value
    FROM grid g LEFT JOIN bins USING (intersection_id, tollgate_id, ts)""")
def forward_fill_series(r: Roles) -> DataFrame:
    laid = series.on_grid(series.bin_means(_raw(r), KEYS), KEYS, *grid_ends(r), fill="forward")
    return _shown(laid, "value")


@query("f03_backward_fill", """
    SELECT event_id, user_id, first_value(v IGNORE NULLS) OVER (
               PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v
    FROM (SELECT *, CASE WHEN event_type = 'view' THEN value END AS v FROM events)""")
def backward_fill(r: Roles) -> DataFrame:
    seen = r.table("events").withColumn("v", F.when(F.col("event_type") == "view", F.col("value")))
    return ordered.carry_backward(seen, ["user_id"], "ts", ["v"]).select("event_id", "user_id", "v")


@query("f03b_backward_fill_series", f"SELECT {_TS}, round(value, 6) AS value FROM laid")
def backward_fill_series(r: Roles) -> DataFrame:
    return _shown(_laid(r), "value")


def _streamed(r: Roles, raw: DataFrame, rows, keys: list[str], measures: list, length: str, parts: int = 4) -> DataFrame:
    """The windows of a stream of the rows of ``raw`` (with ``time``) that come part by part in the order of time, a run for each."""
    path, spread = scratch_path(r.spark, "stream-in"), pin(raw, "stream-rows")
    ends = spread.agg(F.percentile_approx("time", [i / parts for i in range(1, parts)], 1000)).first()[0] or []
    stream = WindowedStream(r.spark, path, raw.schema, scratch_path(r.spark, "stream-out"), scratch_path(r.spark, "stream-state"),
                            keys, measures, rows, length)
    for lo, hi in zip([None, *ends], [*ends, None]):
        part = spread if lo is None else spread.filter(F.col("time") > F.lit(lo))
        (part if hi is None else part.filter(F.col("time") <= F.lit(hi))).write.mode("append").parquet(path)
        stream.run()
    return stream.close(spread.limit(1).withColumn("time", F.lit("2999-01-01").cast("timestamp")))


@query("i02c_streamed_means", """
    SELECT intersection_id, tollgate_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(value, 6) AS value, n
    FROM (SELECT intersection_id, tollgate_id, time_bucket(INTERVAL 20 MINUTE, starting_time) AS ts, avg(travel_time) AS value,
                 count(*) AS n FROM trips GROUP BY ALL)""")
def streamed_means(r: Roles) -> DataFrame:
    """Means of 20 minutes over a stream of files, once it is closed."""
    raw = r.trips.withColumn("time", F.col("starting_time").cast("timestamp")).drop("starting_time")
    means = _streamed(r, raw, lambda df: df, KEYS, [F.avg("travel_time").alias("value"), F.count("*").alias("n")], "20 minutes")
    return rounded(with_time_text(means, "ts"), "value")


@query("e08c_streamed_ratio", """
    SELECT event_type AS kind, strftime(ts::DATE, '%Y-%m-%d %H:%M:%S') AS ts, count(*) AS n,
           round(count_if(value > 50) / count(*), 6) AS ratio FROM events GROUP BY 1, 2""")
def streamed_ratio(r: Roles) -> DataFrame:
    """Share of events above a value by kind and day, over a stream of files, once it is closed."""
    raw = r.table("events").select(F.col("event_type").alias("kind"), "value", F.col("ts").cast("timestamp").alias("time"))
    share = F.count_if(F.col("value") > 50) / F.count("*")
    found = _streamed(r, raw, lambda df: df, ["kind"], [F.count("*").alias("n"), share.alias("ratio")], "1 day")
    return rounded(with_time_text(found, "ts"), "ratio")


@query("i02b_resample_onto_grid", f"SELECT {_TS}, round(value, 6) AS value FROM laid")
def resampled_onto_grid(r: Roles) -> DataFrame:
    return _shown(series.resample_onto(_raw(r), KEYS, *grid_ends(r)), "value")


@query("f04_rolling_mean", f"""
    SELECT {_TS}, round(CASE WHEN count(value) OVER w = 3 THEN avg(value) OVER w END, 6) AS rolling_mean
    FROM series WINDOW w AS (PARTITION BY intersection_id, tollgate_id ORDER BY series.ts ROWS 2 PRECEDING)""")
def rolling_mean(r: Roles) -> DataFrame:
    return _shown(ordered.rolling_mean(regular(r), KEYS, "ts", "value").drop("value"), "rolling_mean")


@query("f05_previous_block", f"""
    SELECT s.intersection_id, s.tollgate_id, strftime(s.ts, '%Y-%m-%d %H:%M:%S') AS ts, round(s.value, 6) AS value,
           {_PREVIOUS}
    FROM slots s LEFT JOIN blocks p ON p.intersection_id = s.intersection_id AND p.tollgate_id = s.tollgate_id
                                   AND p.block = s.block - 1""")
def previous_block(r: Roles) -> DataFrame:
    return _shown(series.with_previous_block(regular(r), KEYS), "value", *plan.PREVIOUS)


@query("f06_twelve_slots", f"""
    SELECT p.intersection_id, p.tollgate_id,
           strftime(TIMESTAMP '1970-01-01' + to_seconds(p.block * 7200), '%Y-%m-%d %H:%M:%S') AS ts, {_PREVIOUS},
           {", ".join(f"round(f.v{i}, 6) AS tt_{i}" for i in range(SLOTS))}
    FROM blocks p JOIN blocks f ON p.intersection_id = f.intersection_id AND p.tollgate_id = f.tollgate_id
                               AND f.block = p.block + 1""")
def twelve_slots(r: Roles) -> DataFrame:
    return _shown(series.twelve_slots(regular(r), KEYS), *plan.PREVIOUS, *plan.TARGETS)


@query("f07_outliers", """
    SELECT event_id, user_id, CASE WHEN abs(value - m) > 3 * s THEN NULL ELSE value END AS value
    FROM events JOIN (SELECT user_id, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY 1) USING (user_id)""")
def outliers(r: Roles) -> DataFrame:
    """Raw rows, by user."""
    return ordered.drop_outliers(r.table("events").select("event_id", "user_id", "value"), "value", ["user_id"])


@query("f07b_clean_series", f"SELECT {_TS}, round(value, 6) AS value FROM series")
def clean_series(r: Roles) -> DataFrame:
    return _shown(regular(r), "value")


def _parts(r: Roles) -> DataFrame:
    return ordered.decompose(regular(r), KEYS, "ts", "value", STEP, PERIOD)


# many means end exactly half-way between two sixth decimals, so eight are kept
@query("f08_trend", f"SELECT {_TS}, round(trend, 8) + 0.0 AS trend FROM trended")
def trend(r: Roles) -> DataFrame:
    return _shown(_parts(r).select(*KEYS, "ts", "trend"), "trend", digits=8)


@query("f09_seasonal", f"""
    SELECT {_TS}, round(seasonal, 6) + 0.0 AS seasonal, round(residual, 6) + 0.0 AS residual,
           round(seasonal_level, 6) + 0.0 AS seasonal_level
    FROM decomposed""")
def seasonal(r: Roles) -> DataFrame:
    return _shown(_parts(r).drop("value", "trend"), "seasonal", "residual", "seasonal_level")


@query("f10_shifted_cycle", """
    SELECT intersection_id, tollgate_id, strftime(ts + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS ts,
           round(seasonal_level, 6) AS value
    FROM decomposed WHERE ts::DATE >= (SELECT max(starting_time)::DATE - 6 FROM trips)""")
def shifted_cycle(r: Roles) -> DataFrame:
    curve = plan.seasonal_curve(regular(r), PERIOD)
    return _shown(ordered.shift_cycle(curve, "ts", *last_week(r), 7), "value")


@query("f11_row_index", """
    SELECT event_id, user_id, row_number() OVER (ORDER BY user_id, ts) - 1 AS row_index FROM events""")
def row_index(r: Roles) -> DataFrame:
    return ordered.with_row_index(r.table("events").select("event_id", "user_id", "ts"), ["user_id", "ts"]).drop("ts")


@query("f12_prefix", """
    SELECT event_id, value FROM events
    QUALIFY row_number() OVER (ORDER BY ts) <= (SELECT count(*) // 2 FROM events)""")
def prefix(r: Roles) -> DataFrame:
    events = r.table("events").select("event_id", "ts", "value")
    return ordered.first_rows(events, ["ts"], events.count() // 2).drop("ts")


@query("f12b_every_sixth", """
    SELECT event_id, value FROM events QUALIFY (row_number() OVER (ORDER BY ts) - 1) % 6 = 0""")
def every_sixth(r: Roles) -> DataFrame:
    return ordered.every_nth(r.table("events").select("event_id", "ts", "value"), ["ts"], 6).drop("ts")


# --- series construction ------------------------------------------------------------------

@query("i01_extract_series", """
    SELECT intersection_id, tollgate_id, starting_time::VARCHAR[:19] AS ts, travel_time AS value FROM trips""".replace(
    "starting_time::VARCHAR[:19]", "strftime(starting_time, '%Y-%m-%d %H:%M:%S')"))
def extracted(r: Roles) -> DataFrame:
    return with_time_text(_raw(r), "ts")


@query("i02_resample", f"SELECT {_TS}, round(value, 6) AS value FROM resampled")
def resampled(r: Roles) -> DataFrame:
    return _shown(series.resample(_raw(r), KEYS), "value")


@query("i03_grid", f"SELECT {_TS} FROM grid")
def calendar_grid(r: Roles) -> DataFrame:
    return with_time_text(series.grid(_raw(r), KEYS, *grid_ends(r)), "ts")


@query("i04_head", f"""
    SELECT {_TS}, round(value, 6) AS value FROM resampled
    UNION ALL
    SELECT intersection_id, tollgate_id, '2023-12-31 23:40:00', round(arg_min(value, ts), 6) FROM resampled
    GROUP BY ALL""")
def head(r: Roles) -> DataFrame:
    return _shown(series.with_head(series.resample(_raw(r), KEYS), KEYS, "2023-12-31 23:40:00"), "value")


@query("i05_weather_on_grid", f"""
    SELECT strftime(g.ts, '%Y-%m-%d %H:%M:%S') AS ts, {_WEATHER}
    FROM (SELECT DISTINCT ts FROM grid) g ASOF LEFT JOIN weather_clean w ON g.ts >= w.ts""")
def weather_on_grid(r: Roles) -> DataFrame:
    times = series.grid(_raw(r), KEYS, *grid_ends(r)).select("ts").distinct()
    return _shown(series.add_weather(times, plan.ready_weather(r.weather)), *schemas.WEATHER_COLUMNS)


@query("i06_single_target_matrix", f"""
    SELECT d.intersection_id, d.tollgate_id, strftime(d.ts, '%Y-%m-%d %H:%M:%S') AS ts,
           {", ".join(f"round(coalesce(p.v{i}, q.v{i}), 6) AS prev_tt_{i}" for i in range(SLOTS))},
           round(seasonal_level, 6) AS seasonal_tt, round(seasonal_level * seasonal_level, 4) AS seasonal_tt_square,
           {_WEATHER}, ((hour(d.ts) * 60 + minute(d.ts)) // 20)::INTEGER AS time_window_num,
           (isodow(d.ts) - 1)::INTEGER AS day_of_week, round(d.value, 6) AS travel_time
    FROM (SELECT *, epoch(ts)::BIGINT // 7200 AS block,
                 min(epoch(ts)::BIGINT // 7200) OVER (PARTITION BY intersection_id, tollgate_id) AS first_block
          FROM decomposed) d
    LEFT JOIN blocks p ON p.intersection_id = d.intersection_id AND p.tollgate_id = d.tollgate_id
                      AND p.block = d.block - 1
    LEFT JOIN (SELECT intersection_id, tollgate_id, epoch(ts)::BIGINT // 7200 AS block,
                      {", ".join(f"max(seasonal_level) FILTER (epoch(ts)::BIGINT % 7200 // 1200 = {i}) AS v{i}"
                                 for i in range(SLOTS))}
               FROM decomposed GROUP BY ALL) q
           ON q.intersection_id = d.intersection_id AND q.tollgate_id = d.tollgate_id
          AND d.block = d.first_block AND q.block = d.block - 1 + 12
    ASOF LEFT JOIN weather_clean w ON d.ts >= w.ts""")
def single_target_matrix(r: Roles) -> DataFrame:
    matrix = plan.single_target_matrix(regular(r), r.weather, PERIOD)
    shown = _shown(matrix, *plan.PREVIOUS, "seasonal_tt", *schemas.WEATHER_COLUMNS, "travel_time")
    return rounded(shown, "seasonal_tt_square", digits=4)


@query("i07_six_target_matrix", f"""
    SELECT t.intersection_id, t.tollgate_id, strftime(t.ts, '%Y-%m-%d %H:%M:%S') AS ts,
           {", ".join(f"round(p{i}, 6) AS prev_tt_{i}" for i in range(SLOTS))},
           {", ".join(f"round(f{i}, 6) AS tt_{i}" for i in range(SLOTS))}, {_WEATHER}
    FROM (SELECT p.intersection_id, p.tollgate_id, TIMESTAMP '1970-01-01' + to_seconds(p.block * 7200) AS ts,
                 {", ".join(f"p.v{i} AS p{i}, f.v{i} AS f{i}" for i in range(SLOTS))}
          FROM blocks p JOIN blocks f ON p.intersection_id = f.intersection_id AND p.tollgate_id = f.tollgate_id
                                     AND f.block = p.block + 1) t
    ASOF LEFT JOIN weather_clean w ON t.ts >= w.ts""")
def six_target_matrix(r: Roles) -> DataFrame:
    return _shown(plan.six_target_matrix(regular(r), r.weather), *plan.PREVIOUS, *plan.TARGETS, *schemas.WEATHER_COLUMNS)


_OBSERVED = """(
        SELECT intersection_id, tollgate_id, ts, last_value(kept IGNORE NULLS) OVER (
                   PARTITION BY intersection_id, tollgate_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS value
        FROM (SELECT *, CASE WHEN abs(value - avg(value) OVER k) > 3 * stddev_samp(value) OVER k THEN NULL
                             ELSE value END AS kept
              FROM resampled WHERE hour(ts) IN (6, 7, 15, 16)
              WINDOW k AS (PARTITION BY intersection_id, tollgate_id)))"""
_WINDOWS = f"""(
        SELECT intersection_id, tollgate_id, begin,
               {", ".join(f"max(value) FILTER (ts = begin + INTERVAL {20 * i} MINUTE) AS v{i}" for i in range(SLOTS))}
        FROM (SELECT *, CASE WHEN hour(ts) < 12 THEN date_trunc('day', ts) + INTERVAL 6 HOUR
                             ELSE date_trunc('day', ts) + INTERVAL 15 HOUR END AS begin FROM {_OBSERVED})
        GROUP BY ALL)"""


@query("i08_scoring_matrix", f"""
    SELECT t.intersection_id, t.tollgate_id, strftime(t.ts, '%Y-%m-%d %H:%M:%S') AS ts,
           {", ".join(f"round(v{i}, 6) AS prev_tt_{i}" for i in range(SLOTS))},
           round(c.seasonal_level, 6) AS seasonal_tt, {_WEATHER},
           ((hour(t.ts) * 60 + minute(t.ts)) // 20)::INTEGER AS time_window_num,
           (isodow(t.ts) - 1)::INTEGER AS day_of_week
    FROM (SELECT o.intersection_id, o.tollgate_id, o.ts + INTERVAL 2 HOUR AS ts, p.*
              EXCLUDE (intersection_id, tollgate_id)
          FROM {_OBSERVED} o JOIN {_WINDOWS} p
            ON p.intersection_id = o.intersection_id AND p.tollgate_id = o.tollgate_id
           AND o.ts >= p.begin AND o.ts < p.begin + INTERVAL 2 HOUR) t
    LEFT JOIN (SELECT intersection_id, tollgate_id, ts + INTERVAL 7 DAY AS ts, seasonal_level
               FROM decomposed) c
           ON c.intersection_id = t.intersection_id AND c.tollgate_id = t.tollgate_id AND c.ts = t.ts
    ASOF LEFT JOIN weather_placed w ON t.ts >= w.ts""")
def scoring_matrix(r: Roles) -> DataFrame:
    """Rows to forecast on the same trips, with the seasonal curve of the week before."""
    curve = plan.seasonal_curve(regular(r), PERIOD)
    moved = curve.withColumn("ts", plus_seconds(F.col("ts"), F.lit(7 * 86400)))
    rows = plan.scoring_matrix(r.trips, r.weather, moved)
    return _shown(rows, *plan.PREVIOUS, "seasonal_tt", *schemas.WEATHER_COLUMNS)


@query("i08b_six_target_scoring_matrix", f"""
    SELECT p.intersection_id, p.tollgate_id, strftime(begin, '%Y-%m-%d %H:%M:%S') AS ts,
           {", ".join(f"round(v{i}, 6) AS prev_tt_{i}" for i in range(SLOTS))}, {_WEATHER}
    FROM {_WINDOWS} p ASOF LEFT JOIN weather_placed w ON p.begin >= w.ts""")
def six_target_scoring_matrix(r: Roles) -> DataFrame:
    return _shown(plan.six_target_scoring_matrix(r.trips, r.weather), *plan.PREVIOUS, *schemas.WEATHER_COLUMNS)


@query("i09_unpivot_targets", f"""
    SELECT intersection_id, tollgate_id, strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS ts,
           round(value, 6) AS prediction
    FROM series""")
def unpivot_targets(r: Roles) -> DataFrame:
    """Blocks of six values back to one row per slot, two hours later."""
    blocks = series.slot_blocks(regular(r), KEYS, "tt")
    placed = blocks.withColumn("ts", series.cal.from_epoch(F.col("block") * series.BLOCK))
    return _shown(series.unpivot_targets(placed, KEYS, plan.TARGETS, 7200), "prediction")


@query("i10_hour_filter_on_series", f"""
    SELECT {_TS}, round(CASE WHEN value > 200 THEN NULL ELSE value END, 6) AS value
    FROM series WHERE hour(series.ts) IN (6, 7, 15, 16)""")
def hour_filter_on_series(r: Roles) -> DataFrame:
    chosen = regular(r).filter(hour_in(F.col("ts"), (6, 8), (15, 17)))
    return _shown(replace_where(chosen, "value", F.col("value") > 200, None), "value")
