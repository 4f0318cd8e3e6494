"""Fits, searches and forecasts of models whose result is known in closed form.

Without a penalty and on one categorical feature a logistic model gives the conversion rates; a linear model of one
feature is least squares, or a covariance over a variance plus the penalty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators import encode, moments, passes
from clickloom.operators import modelling as m
from clickloom.plans import run, training
from clickloom.plans import travel_time as plan
from clickloom.session import scratch_path
from clickloom.workload.model_queries import ORDER, rate_model
from clickloom.workload.registry import query, rounded, with_time_text
from clickloom.workload.roles import Roles
from clickloom.workload.series_queries import _OBSERVED, _WINDOWS, KEYS, PERIOD, regular, split_day

FEATURE = "connectionType"
_LOSS = "-(label * ln(p) + (1 - label) * ln(1 - p))"
_NUMBERED = """(SELECT *, row_number() OVER (ORDER BY clickTime, event_id) - 1 AS pos, count(*) OVER () AS n FROM clicks_with_id)"""


def _rated(r: Roles) -> DataFrame:
    """Clicks with their one feature encoded, and the columns that order them."""
    clicks = r.clicks_with_id
    return encode.encode_rows(clicks, encode.dictionary(clicks, [FEATURE]), [FEATURE], keep=[*ORDER, "label"])


@query("j14b_logistic_rates", f"""
    SELECT event_id, round(avg(label) OVER (PARTITION BY {FEATURE}), 5) AS prob FROM clicks_with_id""")
def logistic_rates(r: Roles) -> DataFrame:
    data = _rated(r)
    return rounded(m.score(rate_model().fit(data), data).select("event_id", "prob"), "prob", digits=5)


LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
PENALTIES = [0.0, 100_000.0, 1_000_000.0]


@query("j15b_grid_search_regressor", f"""
    WITH b AS (
        SELECT l_quantity AS x, l_extendedprice AS y,
               CASE WHEN p < n - 3 * (n // 4) THEN 0 ELSE (p - (n - 3 * (n // 4))) // (n // 4) + 1 END AS block
        FROM (SELECT *, row_number() OVER (ORDER BY {", ".join(LINE_ORDER)}) - 1 AS p, count(*) OVER () AS n FROM lineitem)),
    fits AS (
        SELECT fold, param, my - slope * mx AS intercept, slope
        FROM (SELECT fold, covar_pop(y, x) AS c, var_pop(x) AS v, stddev_pop(y) AS sd, avg(y) AS my, avg(x) AS mx
              FROM b, range(1, 4) f(fold) WHERE block < fold GROUP BY fold),
             (SELECT unnest({PENALTIES}) AS param), LATERAL (SELECT c / (v + param / sd) AS slope)),
    losses AS (SELECT param, fold, avg(e) FILTER (block < fold) AS train, avg(e) FILTER (block = fold) AS valid
               FROM (SELECT *, abs((y - intercept - slope * x) / nullif(y, 0)) AS e FROM b JOIN fits ON block <= fold) GROUP BY ALL)
    SELECT param::DOUBLE AS param, round(avg(train), 5) AS mean_train_loss, round(avg(valid), 5) AS mean_val_loss,
           rank() OVER (ORDER BY avg(valid))::INTEGER AS rank_val_loss
    FROM losses GROUP BY param""")
def grid_search_regressor(r: Roles) -> DataFrame:
    """Ranking of the penalties of a linear model by relative error, over expanding folds."""
    lines = encode.concatenate(r.table("lineitem").withColumn("label", F.col("l_extendedprice")), ["l_quantity"])
    samples = m.in_blocks(lines.select(*LINE_ORDER, "label", "features"), LINE_ORDER, 3)
    _, _, ranking = m.grid_search(samples, lambda a: m.linear(a), PENALTIES, 3, m.mape_measure)
    return rounded(ranking, "mean_train_loss", "mean_val_loss", digits=5)


@query("j17c_learning_curve_unpenalised", f"""
    WITH cut AS (
        SELECT label, {FEATURE}, pos, size, fold, size - (3 - fold) * (size // 3) AS lo, size // 3 AS step
        FROM {_NUMBERED}, LATERAL (SELECT unnest([n // 2, n]) AS size), range(1, 3) f(fold)),
    rates AS (SELECT size, fold, {FEATURE}, avg(label) AS p FROM cut WHERE pos < lo GROUP BY ALL)
    SELECT size::DOUBLE AS param, fold::INTEGER AS fold, round(avg({_LOSS}) FILTER (pos < lo), 5) AS train_loss,
           round(avg({_LOSS}) FILTER (pos >= lo), 5) AS valid_loss
    FROM cut JOIN rates USING (size, fold, {FEATURE}) WHERE pos < lo + step GROUP BY size, fold""")
def learning_curve_unpenalised(r: Roles) -> DataFrame:
    samples = m.positioned(_rated(r), ORDER)
    n = samples.count()
    return rounded(m.learning_curve(samples, rate_model, [n // 2, n], 2), "train_loss", "valid_loss", digits=5)


@query("k21b_tune_unpenalised", f"""
    WITH size AS (SELECT count(*) AS n, floor(0.8 * count(*))::BIGINT AS s FROM clicks_with_id),
    b AS (SELECT label, {FEATURE}, CASE WHEN pos >= s THEN 6 WHEN pos < s - 5 * (s // 6) THEN 0
                                        ELSE (pos - (s - 5 * (s // 6))) // (s // 6) + 1 END AS block
          FROM {_NUMBERED}, size),
    rates AS (SELECT fold, {FEATURE}, avg(label) AS p FROM b, range(1, 7) f(fold) WHERE block < fold GROUP BY ALL),
    losses AS (SELECT fold, avg({_LOSS}) FILTER (block < fold) AS train, avg({_LOSS}) FILTER (block = fold) AS valid
               FROM b JOIN rates USING ({FEATURE}) WHERE block <= fold GROUP BY fold)
    SELECT 0.0::DOUBLE AS param, round(avg(train) FILTER (fold < 6), 5) AS mean_train_loss,
           round(avg(valid) FILTER (fold < 6), 5) AS mean_val_loss, 1 AS rank_val_loss, 0.0::DOUBLE AS best,
           round(max(valid) FILTER (fold = 6), 5) AS held_out_loss
    FROM losses""")
def tune_unpenalised(r: Roles) -> DataFrame:
    """The whole search, with no penalty as the only candidate: losses over the folds and on the held-out end."""
    _, best, ranking, held_out = training.tune(_rated(r), ORDER, alphas=[0.0], iterations=200)
    shown = ranking.withColumns({"best": F.lit(float(best)), "held_out_loss": F.lit(held_out)})
    return rounded(shown, "mean_train_loss", "mean_val_loss", "held_out_loss", digits=5)


@query("k22b_quick_fit_unpenalised", f"""
    SELECT round(avg({_LOSS}), 5) AS log_loss FROM (SELECT label, avg(label) OVER (PARTITION BY {FEATURE}) AS p FROM train)""")
def quick_fit_unpenalised(r: Roles) -> DataFrame:
    _, loss = training.quick_fit(_rated(r), alpha=0.0, iterations=200)
    return r.spark.range(1).select(F.round(F.lit(loss), 5).alias("log_loss"))


RIDGE = [float(p) for p in np.logspace(4, 9, 100)]
_PAIR = ["l_quantity", "l_tax"]


@query("j24b_hundred_penalties", f"""
    WITH b AS (
        SELECT l_quantity AS u, l_tax AS v, l_extendedprice / 1000 AS y,
               CASE WHEN p < n - 3 * (n // 4) THEN 0 ELSE (p - (n - 3 * (n // 4))) // (n // 4) + 1 END AS block
        FROM (SELECT *, row_number() OVER (ORDER BY {", ".join(LINE_ORDER)}) - 1 AS p, count(*) OVER () AS n FROM lineitem)),
    s AS (SELECT fold, avg(u) AS mu, avg(v) AS mv, avg(y) AS my, regr_sxx(u, u) AS uu, regr_sxx(v, v) AS vv,
                 regr_sxy(u, v) AS uv, regr_sxy(y, u) AS uy, regr_sxy(y, v) AS vy
          FROM b, range(1, 4) f(fold) WHERE block < fold GROUP BY fold),
    fits AS (SELECT *, my - wu * mu - wv * mv AS a
             FROM (SELECT *, (uy * (vv + param) - vy * uv) / ((uu + param) * (vv + param) - uv * uv) AS wu,
                             (vy * (uu + param) - uy * uv) / ((uu + param) * (vv + param) - uv * uv) AS wv
                   FROM s, (SELECT unnest({RIDGE}::DOUBLE[]) AS param))),
    losses AS (SELECT param, fold, avg(pow(y - a - wu * u - wv * v, 2)) FILTER (block < fold) AS train,
                      avg(pow(y - a - wu * u - wv * v, 2)) FILTER (block = fold) AS valid
               FROM b JOIN fits ON block <= fold GROUP BY ALL)
    SELECT param, round(avg(train), 5) AS mean_train_loss, round(avg(valid), 5) AS mean_val_loss,
           rank() OVER (ORDER BY round(avg(valid), 5))::INTEGER AS rank_val_loss
    FROM losses GROUP BY param""")
def hundred_penalties(r: Roles) -> DataFrame:
    """Ranking of 100 ridge penalties by squared error over expanding folds, from one scan."""
    lines = encode.concatenate(r.table("lineitem").withColumn("label", F.col("l_extendedprice") / 1000), _PAIR)
    samples = m.in_blocks(lines.select(*LINE_ORDER, "label", "features"), LINE_ORDER, 3)
    curve = moments.penalty_curve(samples, RIDGE, 3)
    means = curve.groupBy("param").agg(F.round(F.avg("train_loss"), 5).alias("mean_train_loss"),
                                       F.round(F.avg("valid_loss"), 5).alias("mean_val_loss"))
    return means.withColumn("rank_val_loss", F.rank().over(Window.orderBy("mean_val_loss")))       # one row a penalty


@query("j24c_lasso_of_one_feature", f"""
    WITH s AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice / 1000) AS my, var_pop(l_quantity) AS xx,
                      covar_pop(l_extendedprice / 1000, l_quantity) AS xy FROM lineitem)
    SELECT param, l1_share, round(slope, 6) AS slope, round(my - slope * mx, 5) AS intercept
    FROM (SELECT *, sign(xy) * greatest(abs(xy) - param * l1_share, 0) / (xx + param * (1 - l1_share)) AS slope
          FROM s, (SELECT unnest([0.5, 20.0, 400.0, 1e6]::DOUBLE[]) AS param), (SELECT unnest([1.0, 0.3]::DOUBLE[]) AS l1_share))""")
def lasso_of_one_feature(r: Roles) -> DataFrame:
    """Lasso and elastic net in closed form: the covariance moved towards 0, over the variance and the rest of the penalty."""
    lines = encode.concatenate(r.table("lineitem").withColumn("label", F.col("l_extendedprice") / 1000), ["l_quantity"])
    sums = moments.moments(lines, F.lit(0))[0]
    rows = []
    for param in (0.5, 20.0, 400.0, 1e6):
        for share in (1.0, 0.3):
            line = moments.solve(sums, param, share)
            rows.append((param, share, float(line.weights[0]), line.intercept))
    shown = r.spark.createDataFrame(rows, "param double, l1_share double, slope double, intercept double")
    return rounded(rounded(shown, "slope"), "intercept", digits=5)


@query("j17d_size_curve", f"""
    WITH cut AS (
        SELECT l_quantity AS x, l_extendedprice / 1000 AS y, p, size, fold, size - (4 - fold) * (size // 4) AS lo, size // 4 AS step
        FROM (SELECT *, row_number() OVER (ORDER BY {", ".join(LINE_ORDER)}) - 1 AS p, count(*) OVER () AS n FROM lineitem),
             LATERAL (SELECT unnest([n // 4, n // 2, n]) AS size), range(1, 4) f(fold)),
    fits AS (SELECT size, fold, regr_slope(y, x) AS w, regr_intercept(y, x) AS a FROM cut WHERE p < lo GROUP BY ALL)
    SELECT size::DOUBLE AS param, fold::INTEGER AS fold, round(avg(pow(y - a - w * x, 2)) FILTER (p < lo), 5) AS train_loss,
           round(avg(pow(y - a - w * x, 2)) FILTER (p >= lo), 5) AS valid_loss
    FROM cut JOIN fits USING (size, fold) WHERE p < lo + step GROUP BY ALL""")
def size_curve(r: Roles) -> DataFrame:
    """Losses of least squares for growing samples over expanding folds, all from one scan."""
    lines = encode.concatenate(r.table("lineitem").withColumn("label", F.col("l_extendedprice") / 1000), ["l_quantity"])
    samples = m.positioned(lines.select(*LINE_ORDER, "label", "features"), LINE_ORDER)
    n = samples.count()
    return rounded(moments.size_curve(samples, [n // 4, n // 2, n], 3), "train_loss", "valid_loss", digits=5)


@query("j15c_shared_search_unpenalised", f"""
    WITH b AS (SELECT label, {FEATURE}, CASE WHEN pos < n - 3 * (n // 4) THEN 0 ELSE (pos - (n - 3 * (n // 4))) // (n // 4) + 1 END AS block
               FROM {_NUMBERED}),
    rates AS (SELECT fold, {FEATURE}, avg(label) AS p FROM b, range(1, 4) f(fold) WHERE block < fold GROUP BY ALL)
    SELECT fold::INTEGER AS fold, round(avg({_LOSS}) FILTER (block < fold), 5) AS train_loss,
           round(avg({_LOSS}) FILTER (block = fold), 5) AS valid_loss
    FROM b JOIN rates USING ({FEATURE}) WHERE block <= fold GROUP BY fold""")
def shared_search_unpenalised(r: Roles) -> DataFrame:
    """The fits of all folds in the same scans; without a penalty they are the conversion rates."""
    samples = m.in_blocks(_rated(r), ORDER, 3)
    curve = passes.shared_curve(samples, [0.0], 3, iterations=200, tolerance=1e-12)
    return rounded(curve.drop("param"), "train_loss", "valid_loss", digits=5)


# --- forecasts: least squares on the last slot before -----------------------------------------------

LAST = ["prev_tt_5"]
_SPLIT = "(SELECT max(starting_time)::DATE - 5 FROM trips)"

_SINGLE = f"""
    WITH pairs AS (
        SELECT d.ts, d.value AS y, coalesce(p.v5, q.v5) AS x
        FROM (SELECT *, epoch(ts)::BIGINT // 7200 AS block,
                     min(epoch(ts)::BIGINT // 7200) OVER (PARTITION BY intersection_id, tollgate_id) AS first_block
              FROM decomposed) d
        LEFT JOIN blocks p ON p.intersection_id = d.intersection_id AND p.tollgate_id = d.tollgate_id
                          AND p.block = d.block - 1
        LEFT JOIN (SELECT intersection_id, tollgate_id, epoch(ts)::BIGINT // 7200 AS block,
                          max(seasonal_level) FILTER (epoch(ts)::BIGINT % 7200 // 1200 = 5) AS v5
                   FROM decomposed GROUP BY ALL) q
               ON q.intersection_id = d.intersection_id AND q.tollgate_id = d.tollgate_id
              AND d.block = d.first_block AND q.block = d.block - 1 + 12),
    fit AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM pairs WHERE ts < {_SPLIT}),
    errors AS (SELECT avg(e) FILTER (ts < {_SPLIT}) AS train, avg(e) FILTER (ts >= {_SPLIT}) AS test
               FROM (SELECT ts, abs((y - b - a * x) / nullif(y, 0)) AS e FROM pairs, fit WHERE x IS NOT NULL AND y IS NOT NULL))
    SELECT o.intersection_id, o.tollgate_id, strftime(o.ts + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS time_window_start,
           round(b + a * p.v5, 4) AS prediction{{errors}}
    FROM {_OBSERVED} o JOIN {_WINDOWS} p ON p.intersection_id = o.intersection_id AND p.tollgate_id = o.tollgate_id
                                        AND o.ts >= p.begin AND o.ts < p.begin + INTERVAL 2 HOUR, fit, errors"""
_ERRORS = ", round(train, 5) AS train_mape, round(test, 5) AS test_mape"


@query("k27b_single_target_least_squares", _SINGLE.format(errors=_ERRORS))
def single_target_least_squares(r: Roles) -> DataFrame:
    series = regular(r)
    fitted = plan.fit_single_target(plan.single_target_matrix(series, r.weather, PERIOD), split_day(r), m.linear, LAST)[0]
    rows = plan.scoring_matrix(r.trips, r.weather, plan.seasonal_curve(series, PERIOD))
    shown = with_time_text(plan.forecast_single(fitted.models[0], rows, LAST), "time_window_start").withColumns(
        {"train_mape": F.lit(fitted.train_mape), "test_mape": F.lit(fitted.test_mape)})
    return rounded(rounded(shown, "prediction", digits=4), "train_mape", "test_mape", digits=5)


@query("k28b_six_target_least_squares", f"""
    WITH pairs AS (
        SELECT TIMESTAMP '1970-01-01' + to_seconds(p.block * 7200) AS ts, p.v5 AS x,
               unnest([0, 1, 2, 3, 4, 5]) AS slot, unnest([f.v0, f.v1, f.v2, f.v3, f.v4, f.v5]) AS y
        FROM blocks p JOIN blocks f ON p.intersection_id = f.intersection_id AND p.tollgate_id = f.tollgate_id
                                   AND f.block = p.block + 1
        WHERE p.v5 IS NOT NULL AND {" AND ".join(f"f.v{i} IS NOT NULL" for i in range(6))}),
    fit AS (SELECT slot, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM pairs WHERE ts < {_SPLIT} GROUP BY slot),
    errors AS (SELECT avg(e) FILTER (ts < {_SPLIT}) AS train, avg(e) FILTER (ts >= {_SPLIT}) AS test
               FROM (SELECT ts, abs((y - b - a * x) / nullif(y, 0)) AS e FROM pairs JOIN fit USING (slot)))
    SELECT intersection_id, tollgate_id,
           strftime(p.begin + INTERVAL 2 HOUR + to_minutes(20 * slot), '%Y-%m-%d %H:%M:%S') AS time_window_start,
           round(b + a * p.v5, 4) AS prediction{_ERRORS}
    FROM {_WINDOWS} p, fit, errors""")
def six_target_least_squares(r: Roles) -> DataFrame:
    fitted = plan.fit_six_targets(plan.six_target_matrix(regular(r), r.weather), split_day(r), m.linear, LAST)
    rows = plan.six_target_scoring_matrix(r.trips, r.weather)
    shown = with_time_text(plan.forecast_six(fitted.models, rows, LAST), "time_window_start").withColumns(
        {"train_mape": F.lit(fitted.train_mape), "test_mape": F.lit(fitted.test_mape)})
    return rounded(rounded(shown, "prediction", digits=4), "train_mape", "test_mape", digits=5)


@query("k29_forecast_run", _SINGLE.format(errors=""))
def forecast_run(r: Roles) -> DataFrame:
    """Build, search, fit, forecast and write in one go; the files read back."""
    path = scratch_path(r.spark, "forecast-run")
    run.run_forecast({"trajectories": r.trips, "weather": r.weather, "trajectories_test": r.trips, "weather_test": r.weather},
                     path, split_day(r), m.linear, [0.0], LAST, PERIOD)
    saved = r.spark.read.schema("time_window_start timestamp_ntz, prediction double, intersection_id string, tollgate_id int"
                                ).csv(path, header=True)
    return rounded(with_time_text(saved, "time_window_start"), "prediction", digits=4).select(
        *KEYS, "time_window_start", "prediction")
