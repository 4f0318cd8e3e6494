"""Windowed aggregates over a folder that files are added to.

Each run takes what is new and ends; the state of the open windows is kept in the checkpoint between runs, so a run that dies, or
executors that are lost, repeat at most one batch, and the file sink counts a batch once.  A window is written when the watermark
has passed it; rows that are later than the watermark are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass
class WindowedStream:
    """Aggregates by ``keys`` and windows of ``length`` over the Parquet files of ``source``.

    ``rows`` turns the file's columns into the keys, ``time`` (a timestamp) and the values that ``measures`` aggregate.  Rows may come in
    any order within ``late``.  State holds one row for each key and open window, whatever the number of rows.
    """

    spark: SparkSession
    source: str
    schema: StructType
    target: str
    checkpoint: str
    keys: Sequence[str]
    measures: Sequence[Column]
    rows: Callable[[DataFrame], DataFrame]
    length: str = "20 minutes"
    late: str = "1 hour"
    files_at_once: int | None = None        # files of a batch; None: all that are new

    def table(self) -> DataFrame:
        """The streaming plan: windows by their start, in ``ts``."""
        reader = self.spark.readStream.schema(self.schema)
        if self.files_at_once:
            reader = reader.option("maxFilesPerTrigger", self.files_at_once)
        timed = self.rows(reader.parquet(self.source)).withWatermark("time", self.late)
        return (timed.groupBy(*self.keys, F.window("time", self.length).alias("_window")).agg(*self.measures)
                .withColumn("ts", F.col("_window.start").cast("timestamp_ntz")).drop("_window"))

    def run(self) -> None:
        """Take all files that have come since the last run, then stop."""
        query = (self.table().writeStream.format("parquet").outputMode("append").option("path", self.target)
                 .option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()

    def written(self) -> DataFrame:
        """The windows that are closed so far; none before the first."""
        return self.spark.read.schema(self.table().schema).parquet(self.target)

    def close(self, marker: DataFrame) -> DataFrame:
        """Add ``marker``, rows far behind all others, as a last file, so that the watermark passes every window of the data; its own windows
        stay open.  Returns the whole table."""
        marker.write.mode("append").parquet(self.source)
        self.run()
        return self.written()
