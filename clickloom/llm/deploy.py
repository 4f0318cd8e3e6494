"""Getting a session ready: runtime settings, and this package where the tasks can import it."""

from __future__ import annotations

from pyspark.sql import SparkSession

from clickloom.session import ship_package, tune


def ready(spark: SparkSession) -> SparkSession:
    """Tune the session and, once per application, hand Spark the package's sources to send to its workers."""
    ship_package(spark)
    return tune(spark)
