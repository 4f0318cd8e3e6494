"""End-to-end entries: full (split, tune, score) and quick (fit on all rows, score) for clicks, and forecasts of travel times."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.calendar import plus_seconds
from clickloom.operators.encode import concatenate
from clickloom.operators.modelling import grid_search, in_blocks, mape_measure
from clickloom.operators.series import first_last_day
from clickloom.plans import features, prepare, training, travel_time
from clickloom.session import pin
from clickloom.sources.sinks import read_model, write_forecast, write_model, write_submission
from clickloom.sources.store import FeatureStore
from clickloom.sources.tables import read_source

ORDER = ["_clickTime", "_row"]


def source_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The eight CSV sources of the click work."""
    return {name: read_source(spark, folder, name) for name in prepare.SOURCES}


def _encoded(made: Mapping[str, DataFrame], store: FeatureStore, keep: Sequence[str] = ()) -> training.Encoded:
    """Encoded training and scoring sets; what later scoring needs of the encoding is stored."""
    encoded = training.encode(made["dataset"], made["testset_ol"], keep=keep)
    store_encoding(encoded, store)
    return encoded


def store_encoding(encoded: training.Encoded, store: FeatureStore) -> None:
    """Dictionary, feature order and numeric columns."""
    columns = [(i, c, kind) for kind, names in (("feature", encoded.features), ("numeric", encoded.numeric))
               for i, c in enumerate(names)]
    store.put("encoding", encoded.dictionary)
    store.put("encoding_columns", store.spark.createDataFrame(columns, "place int, name string, kind string"))


def score_stored(store: FeatureStore, scoring: DataFrame, installed: bool = True) -> DataFrame:
    """Submission for rows of the assembled form (features and ``instanceID``) from what a run has stored, in any later session."""
    columns = store.get("encoding_columns", None).orderBy("place").collect()      # one row per feature
    features, numeric = ([r.name for r in columns if r.kind == kind] for kind in ("feature", "numeric"))
    rows = training.encode_scoring(scoring, store.get("encoding", None), features, numeric)
    return training.predict(read_model(store.path("model")), rows, installed=installed)


def run_quick(tables: Mapping[str, DataFrame], store: FeatureStore, iterations: int = 100, installed: bool = False) -> tuple[DataFrame, float]:
    """Prepare, construct, encode, fit with a fixed penalty, score; the submission and the train log-loss.

    With ``installed`` pairs that are installed already get probability 0.
    """
    made = features.construct_all(prepare.prepare_all(tables, store), store)
    encoded = _encoded(made, store)
    model, loss = training.quick_fit(encoded.train, iterations=iterations)
    write_model(model, store.path("model"))
    result = training.predict(model, encoded.score, installed=installed)
    write_submission(result, store.path("submission"))
    return result, loss


def run_full(tables: Mapping[str, DataFrame], store: FeatureStore, iterations: int = 100, installed: bool = False
             ) -> tuple[DataFrame, DataFrame, float]:
    """Prepare, construct, encode, hold out, tune, score; the submission, the ranking and the held-out log-loss.

    The hold-out follows click time, with a stored row number as tie-break.
    """
    ready = prepare.prepare_all(tables, store)
    ready["train"] = _numbered(ready["train"], store)
    made = features.construct_all(ready, store)
    encoded = _encoded(made, store, ORDER)
    model, _, ranking, held_out = training.tune(encoded.train, ORDER, iterations=iterations)
    write_model(model, store.path("model"))
    result = training.predict(model, encoded.score, installed=installed)
    write_submission(result, store.path("submission"))
    return result, ranking, held_out


def run_forecast(tables: Mapping[str, DataFrame], path: str, split: str, make: Callable[[float], Estimator],
                 params: Sequence[float], columns: Sequence[str] = tuple(travel_time.SINGLE_FEATURES),
                 period: int = travel_time.WEEK, folds: int = 3) -> tuple[DataFrame, DataFrame, travel_time.Fitted]:
    """Travel times: build the matrix, search ``params`` on what lies before ``split``, fit, forecast, write to ``path``.

    ``tables``: trajectories and weather of the training time and of the time to forecast (``*_test``).  The seasonal
    curve is used a week later.  Returns the forecasts, the ranking and the fitted model with its errors.
    """
    trips = tables["trajectories"]
    first, last = first_last_day(trips, "starting_time")
    series = travel_time.regular_series(trips, f"{first} 00:00:00", f"{last} 23:40:00")
    matrix = pin(travel_time.single_target_matrix(series, tables["weather"], period), "matrix")
    known = matrix.filter(F.col("ts") < F.lit(split).cast("timestamp_ntz")).dropna(subset=[*columns, "travel_time"])
    order = ["ts", *travel_time.KEYS]
    vectors = concatenate(known.withColumnRenamed("travel_time", "label"), list(columns)).select(*order, "label", "features")
    _, best, ranking = grid_search(in_blocks(vectors, order, folds), make, params, folds, mape_measure)
    fitted = travel_time.fit_single_target(matrix, split, lambda: make(best), columns)[0]
    curve = travel_time.seasonal_curve(series, period)
    rows = travel_time.scoring_matrix(tables["trajectories_test"], tables["weather_test"], curve.withColumn(
        "ts", plus_seconds(F.col("ts"), F.lit(7 * 86400))))
    forecast = pin(travel_time.forecast_single(fitted.models[0], rows, columns), "forecast")
    write_forecast(forecast, path)
    return forecast, ranking, fitted


def _numbered(train: DataFrame, store: FeatureStore) -> DataFrame:
    """Clicks with the columns that order them, which the feature groups pass on.

    Stored: a row number must not change when a task is run again.
    """
    return store.get("train_numbered", lambda: train.withColumns(
        {"_clickTime": F.col("clickTime"), "_row": F.monotonically_increasing_id()}), [train])
