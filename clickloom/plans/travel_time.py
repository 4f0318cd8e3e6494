"""Travel-time forecasting for all series at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.calendar import at_hour, hour_in, plus_seconds
from clickloom.operators.encode import concatenate
from clickloom.operators.modelling import (
    boosted_trees,
    fit_targets,
    mape,
    mape_of_targets,
    predict_targets,
)
from clickloom.operators.ordered import clean_series, decompose
from clickloom.operators.rows import choose_samples, move_last
from clickloom.operators.series import (
    SLOTS,
    STEP,
    add_calendar,
    add_weather,
    clean_weather,
    extract_series,
    resample,
    resample_onto,
    twelve_slots,
    unpivot_targets,
    with_previous_block,
)
from clickloom.session import pin

KEYS = ["intersection_id", "tollgate_id"]
PREVIOUS = [f"prev_tt_{i}" for i in range(SLOTS)]
TARGETS = [f"tt_{i}" for i in range(SLOTS)]
SINGLE_FEATURES = [*PREVIOUS, *schemas.WEATHER_COLUMNS, "day_of_week", "time_window_num"]
MULTI_FEATURES = [*PREVIOUS, *schemas.WEATHER_COLUMNS]
WEEK = 504  # slots


def regular_series(trips: DataFrame, start: str, end: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """20-minute means, gaps filled, on the grid from ``start`` to ``end``, outliers replaced.

    One pass over the trips, then written: everything after it reads slots, whose
    number does not depend on the number of trips.
    """
    laid = resample_onto(extract_series(trips, keys, "starting_time", "travel_time"), keys, start, end)
    return pin(clean_series(laid, keys, "ts", "value"), "series")


def ready_weather(weather: DataFrame) -> DataFrame:
    """Cleaned weather, written: it is small, and several steps read it."""
    return pin(clean_weather(weather), "weather")


def seasonal_curve(series: DataFrame, period: int = WEEK, keys: Sequence[str] = KEYS) -> DataFrame:
    """Re-levelled seasonal component of each series."""
    parts = decompose(series, keys, "ts", "value", STEP, period)
    return parts.select(*keys, "ts", F.col("seasonal_level").alias("value"))


def single_target_matrix(series: DataFrame, weather: DataFrame, period: int = WEEK,
                         keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per slot: previous block, seasonal value and square, weather, calendar, target last."""
    curve = pin(seasonal_curve(series, period, keys), "seasonal")
    rows = with_previous_block(series, keys, curve, period)
    seasonal = curve.withColumnRenamed("value", "seasonal_tt")
    rows = rows.join(seasonal, [*keys, "ts"], "left").withColumn(
        "seasonal_tt_square", F.col("seasonal_tt") * F.col("seasonal_tt"))
    rows = add_calendar(add_weather(rows, ready_weather(weather)))
    return move_last(rows.withColumnRenamed("value", "travel_time"), "travel_time")


def six_target_matrix(series: DataFrame, weather: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per two-hour start: six past values, six targets, weather."""
    return add_weather(twelve_slots(series, keys), ready_weather(weather))


def _observed_windows(trips: DataFrame, keys: Sequence[str]) -> DataFrame:
    binned = resample(extract_series(trips, keys, "starting_time", "travel_time"), keys)
    observed = binned.filter(hour_in(F.col("ts"), (6, 8), (15, 17)))
    return pin(clean_series(observed, keys, "ts", "value"), "observed")


def _placed_weather(weather: DataFrame) -> DataFrame:
    return pin(weather.withColumn("ts", at_hour(F.col("date"), F.col("hour"))).drop("date", "hour"), "weather")


def scoring_matrix(trips: DataFrame, weather: DataFrame, seasonal: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows to forecast: the two hours after each observed window (6-8 and 15-17 h).

    ``seasonal`` is the training cycle already moved to the test week.  The
    previous block of a row is the observed window two hours before.
    """
    observed = _observed_windows(trips, keys)
    seconds = F.lit(2 * 3600)
    rows = observed.select(*keys, plus_seconds(F.col("ts"), seconds).alias("ts"))
    window = F.when(F.hour("ts") < 12, F.lit("am")).otherwise(F.lit("pm"))
    # the windows start at 6:00 and 15:00: number slots from there
    start = F.when(F.hour("ts") < 12, 6 * 60).otherwise(15 * 60)
    slot = ((F.hour("ts") * 60 + F.minute("ts") - start) / 20).cast("int")
    day = F.to_date("ts")
    past = observed.groupBy(*keys, day.alias("_day"), window.alias("_window")).agg(
        *[F.max(F.when(slot == i, F.col("value"))).alias(f"prev_tt_{i}") for i in range(SLOTS)])
    rows = rows.withColumns({"_day": day, "_window": window}).join(
        past, [*keys, "_day", "_window"], "left").drop("_day", "_window")
    curve = seasonal.select(*keys, "ts", F.col("value").alias("seasonal_tt"))
    rows = rows.join(curve, [*keys, "ts"], "left")
    return add_calendar(add_weather(rows, _placed_weather(weather)))


def six_target_scoring_matrix(trips: DataFrame, weather: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per observed window (6-8 and 15-17 h): its six values and the weather."""
    observed = _observed_windows(trips, keys)
    pm = F.hour("ts") >= 12
    start = F.when(pm, 15 * 60).otherwise(6 * 60)
    slot = ((F.hour("ts") * 60 + F.minute("ts") - start) / 20).cast("int")
    begin = plus_seconds(F.to_date("ts").cast("timestamp_ntz"), start.cast("long") * 60)
    rows = observed.groupBy(*keys, begin.alias("ts")).agg(
        *[F.max(F.when(slot == i, F.col("value"))).alias(f"prev_tt_{i}") for i in range(SLOTS)])
    return add_weather(rows, _placed_weather(weather))


@dataclass
class Fitted:
    """Fitted models and their errors."""

    models: list[Model]
    train_mape: float
    test_mape: float
    rush_mape: float | None = None


def _vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return concatenate(df.dropna(subset=list(features)), list(features))


def fit_single_target(matrix: DataFrame, split: str, make: Callable[[], Estimator] = boosted_trees,
                      features: Sequence[str] = tuple(SINGLE_FEATURES), samples: str = "all") -> list[Fitted]:
    """Fit on rows before ``split``, evaluate on the rest, and there on the rush hours alone.

    ``samples='split'`` gives two models (am, pm).
    """
    chosen = choose_samples(matrix, "ts", samples).withColumnRenamed("travel_time", "label")
    parts = [chosen.filter(F.col("part") == p) for p in ("am", "pm")] if samples == "split" else [chosen]
    fitted = []
    for part in parts:
        rows = pin(_vectors(part.dropna(subset=["label"]), features).select("ts", "label", "features"), "matrix")
        before = F.col("ts") < F.lit(split).cast("timestamp_ntz")
        model = make().fit(rows.filter(before))
        scored = model.transform(rows)
        rush = ~before & hour_in(F.col("ts"), (8, 10), (17, 19))
        errors = [mape(scored.filter(which), "label", "prediction").first().mape for which in (before, ~before, rush)]
        fitted.append(Fitted([model], *errors))
    return fitted


def fit_six_targets(matrix: DataFrame, split: str, make: Callable[[], Estimator] = boosted_trees,
                    features: Sequence[str] = tuple(MULTI_FEATURES)) -> Fitted:
    """One model per target; errors over all targets together."""
    rows = pin(_vectors(matrix.dropna(subset=TARGETS), features).select("ts", *TARGETS, "features"), "matrix")
    before = F.col("ts") < F.lit(split).cast("timestamp_ntz")
    models = fit_targets(rows.filter(before), make, TARGETS)
    scored = predict_targets(models, rows)
    predicted = [f"pred_{t}" for t in TARGETS]
    return Fitted(models, mape_of_targets(scored.filter(before), TARGETS, predicted).first().mape,
                  mape_of_targets(scored.filter(~before), TARGETS, predicted).first().mape)


def _incomplete(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    missing = F.lit(False)
    for c in features:
        missing = missing | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    return rows.filter(missing)


def forecast_single(model: Model, rows: DataFrame, features: Sequence[str] = tuple(SINGLE_FEATURES),
                    keys: Sequence[str] = KEYS) -> DataFrame:
    """One prediction per row; null where a feature is missing."""
    columns = [*keys, F.col("ts").alias("time_window_start")]
    scored = model.transform(_vectors(rows, features)).select(*columns, "prediction")
    return scored.unionByName(_incomplete(rows, features).select(*columns, F.lit(None).cast("double").alias("prediction")))


def forecast_six(models: Sequence[Model], rows: DataFrame, features: Sequence[str] = tuple(MULTI_FEATURES),
                 keys: Sequence[str] = KEYS) -> DataFrame:
    """Six predictions per observed window, two hours after its start, one row each; null where a feature is missing."""
    predicted = [f"pred_{t}" for t in TARGETS]
    scored = predict_targets(models, _vectors(rows, features)).select(*keys, "ts", *predicted)
    absent = _incomplete(rows, features).select(*keys, "ts", *[F.lit(None).cast("double").alias(c) for c in predicted])
    long = unpivot_targets(scored.unionByName(absent), keys, predicted, 2 * 3600)
    return long.withColumnRenamed("ts", "time_window_start")
