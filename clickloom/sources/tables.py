"""Catalogue of source tables, CSV and parquet readers, ingest."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clickloom import schemas
from clickloom.session import pin


@dataclass(frozen=True)
class Source:
    """One logical table: its file name in the input folder and its schema."""

    file_name: str
    schema: StructType


# Logical table name -> input file name.
CATALOG = {
    "ad": Source("ad.csv", schemas.AD),
    "app_cat": Source("app_categories.csv", schemas.APP_CATEGORY),
    "pos": Source("position.csv", schemas.POSITION),
    "test_ol": Source("test.csv", schemas.TEST),
    "train": Source("train.csv", schemas.TRAIN),
    "action": Source("user_app_actions.csv", schemas.ACTION),
    "user": Source("user.csv", schemas.USER),
    "user_app": Source("user_installedapps.csv", schemas.USER_APP),
    "trajectories": Source("trajectories(table 5)_training.csv", schemas.TRAJECTORY),
    "weather": Source("weather (table 7)_training.csv", schemas.WEATHER),
    "trajectories_test": Source("trajectories(table 5)_test1.csv", schemas.TRAJECTORY),
    "weather_test": Source("weather (table 7)_test1.csv", schemas.WEATHER),
}


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Headed CSV with a declared schema; empty fields are null."""
    return spark.read.schema(schema).option("enforceSchema", False).csv(path, header=True)


REJECTED = "rejected_line"


def read_checked(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a CSV, from one scan: rejects hold each line that does not fit the schema, whole, with its file.

    A line fits if it has as many fields as the schema and every field that is not empty is of its type.  A header that differs from the
    schema is an error.  Both are parts of one written table, so they always add up to the lines of the files.
    """
    if REJECTED in schema.names:
        raise ValueError(f"{REJECTED} is the name of the column of rejects")
    wide = StructType([*schema.fields, StructField(REJECTED, StringType())])
    read = (spark.read.schema(wide).option("enforceSchema", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", REJECTED).csv(path, header=header))
    table = pin(read.withColumn("rejected_in", F.when(F.col(REJECTED).isNotNull(), F.col("_metadata.file_name"))), "checked")
    good = table.filter(F.col(REJECTED).isNull()).select(*schema.names)
    return good, table.filter(F.col(REJECTED).isNotNull()).select(REJECTED, "rejected_in")


def ingest_checked(spark: SparkSession, csv_path: str, schema: StructType, table_path: str,
                   header: bool = True) -> tuple[DataFrame, DataFrame]:
    """``ingest_csv`` of the rows that fit; the others go to ``<table_path>-rejects``."""
    good, bad = read_checked(spark, csv_path, schema, header)
    good.write.mode("overwrite").parquet(table_path)
    bad.write.mode("overwrite").parquet(f"{table_path}-rejects")
    return spark.read.schema(schema).parquet(table_path), spark.read.schema(bad.schema).parquet(f"{table_path}-rejects")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Columnar table; column pruning and filters reach the scan."""
    return spark.read.parquet(path)


def read_source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    source = CATALOG[name]
    return read_csv(spark, f"{folder.rstrip('/')}/{source.file_name}", source.schema)


def ingest_csv(spark: SparkSession, csv_path: str, schema: StructType, table_path: str) -> DataFrame:
    """Copy a CSV unchanged into a columnar table and return that table."""
    read_csv(spark, csv_path, schema).write.mode("overwrite").parquet(table_path)
    return spark.read.schema(schema).parquet(table_path)


def ingest_sources(spark: SparkSession, folder: str, store, names: Iterable[str]) -> None:
    """Ingest several catalogue tables into a feature store, skipping those it has."""
    for name in names:
        store.get(name, lambda name=name: read_source(spark, folder, name))
