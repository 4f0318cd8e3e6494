"""Sinks for design matrices, models, submissions and forecasts."""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.sources.store import save


def write_design(df: DataFrame, path: str, features: str = "features", label: str | None = "label",
                 *keep: str) -> None:
    """Design matrix: one row per sample, vector column and label side by side."""
    save(df.select(*keep, *([label] if label else []), features), path)


def read_design(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_model(model: PipelineModel, path: str) -> None:
    save(model, path, "model")


def read_model(path: str) -> Model:
    """A fitted model of whatever kind was written."""
    return DefaultParamsReader.loadParamsInstance(path, SparkSession.active())


def submission(scored: DataFrame, key: str = "instanceID", probability: str = "prob") -> DataFrame:
    """Two columns, in key order."""
    return scored.select(F.col(key), F.col(probability).alias("prob")).orderBy(key)


def write_submission(scored: DataFrame, path: str, key: str = "instanceID",
                     probability: str = "prob", compression: str = "gzip") -> None:
    """Sorted, headed, compressed CSV.

    The range sort writes one part file per key range, in order; the parts are
    not pulled into one task.
    """
    save(submission(scored, key, probability), path, "csv", compression=compression)


def write_forecast(forecast: DataFrame, path: str) -> None:
    """CSV of window start and prediction, one folder per (intersection, tollgate).

    Rows are hashed by series and day, so that a long series is written by many
    tasks and no folder gets one file per task of the whole job.
    """
    days = F.to_date("time_window_start")
    (forecast.repartition("intersection_id", "tollgate_id", days)
     .write.mode("overwrite").partitionBy("intersection_id", "tollgate_id")
     .csv(path, header=True))
