"""Feature store: compute a named table once, read it afterwards."""

from __future__ import annotations

import hashlib
import json
import os
import threading
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

_PLAIN = threading.Lock()       # one plan at a time is printed with all its columns


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(target)


def _delete(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.delete(target, True)


def file_manifest(df: DataFrame) -> list[list]:
    """(path, bytes, time of change) of every file ``df`` reads, in order; folders are listed, files are not opened."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = df.inputFiles()
    found = {}
    for folder in sorted({os.path.dirname(f) for f in files}):
        target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        for status in target.getFileSystem(conf).listStatus(target):
            found[f"{folder}/{status.getPath().toUri().getRawPath().rsplit('/', 1)[-1]}"] = [status.getLen(), status.getModificationTime()]
    return [[f, *found.get(f, [])] for f in sorted(files)]


def plan_text(df: DataFrame) -> str:
    """What ``df`` computes, as text that does not depend on the session: its plan with numbered columns.

    The plan of rows that come from no file does not show them; there the session's own hash is added, so such a table is
    found again in its session only.
    """
    spark, name = df.sparkSession, "spark.sql.debug.maxToStringFields"
    with _PLAIN:
        shown = spark.conf.get(name)
        spark.conf.set(name, "100000")
        try:
            plan = df._jdf.queryExecution().optimizedPlan()
            text = plan.canonicalized().toString()
            leaves = plan.collectLeaves()
            kinds = {leaves.apply(i).nodeName() for i in range(leaves.size())}
        finally:
            spark.conf.set(name, shown)
    loose = not all(k.startswith(("LogicalRelation", "Relation", "Range")) for k in kinds)
    return f"{text}\n{df.semanticHash()} {spark.sparkContext.applicationId}" if loose else text


def made_from(inputs: Iterable[DataFrame], settings: dict) -> dict:
    """What a stored table depends on: settings that are not None, and the plan and files of each input."""
    out = {k: v for k, v in settings.items() if v is not None and v is not False}
    if inputs:
        out["inputs"] = [{"columns": sorted(df.columns), "plan": hashlib.md5(plan_text(df).encode()).hexdigest(),
                          "files": file_manifest(df)} for df in inputs]
    return out


def variant(name: str, inputs: Iterable[DataFrame] = (), **settings) -> str:
    """``name`` marked with what a table is made from: other settings, another computation of an input, or files of other names,
    sizes or times give another mark."""
    return _marked(name, made_from(list(inputs), settings))


def _marked(name: str, source: dict) -> str:
    if not source:
        return name
    return f"{name}-{hashlib.md5(json.dumps(source, sort_keys=True, default=str).encode()).hexdigest()[:12]}"


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    data = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
    finally:
        data.close()


class FeatureStore:
    """Named parquet tables under one folder of a shared file system.

    A table counts as present when its write was committed (``_SUCCESS``), so a
    job that died half-way is redone instead of being read.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def has(self, name: str) -> bool:
        return _exists(self.spark, f"{self.path(name)}/_SUCCESS")

    def get(self, name: str, build: Callable[[], DataFrame], inputs: Iterable[DataFrame] = (), **settings) -> DataFrame:
        """Read ``name``; build and write it first when absent.

        A table depends on ``settings`` and on what ``inputs`` compute from which files: a filtered input, or one whose files were
        written anew, is another table (``variant``).  The list of files is kept with it, in ``_inputs.json``.
        """
        source = made_from(list(inputs), settings)
        name = _marked(name, source)
        if not self.has(name):
            self.put(name, build())
            if source:
                _write_text(self.spark, f"{self.path(name)}/_inputs.json", json.dumps(source, indent=1, default=str))
        return self.spark.read.parquet(self.path(name))

    def inputs(self, name: str, inputs: Iterable[DataFrame] = (), **settings) -> dict | None:
        """What the stored table was made from, as written with it; None if it is absent."""
        path = f"{self.path(variant(name, list(inputs), **settings))}/_inputs.json"
        return json.loads(_read_text(self.spark, path)) if _exists(self.spark, path) else None

    def get_placed(self, name: str, build: Callable[[], DataFrame], keys: Sequence[str], buckets: int,
                   inputs: Iterable[DataFrame] = (), **settings) -> DataFrame:
        """``get`` for a table that is kept in ``buckets`` by ``keys``: joins on these keys find its rows in place."""
        source = made_from(list(inputs), {**settings, "placed": [list(keys), buckets]})
        name = _marked(name, source)
        if not self.has(name):
            save_placed(build(), self.path(name), keys, buckets)
            _write_text(self.spark, f"{self.path(name)}/_inputs.json", json.dumps(source, indent=1, default=str))
        return read_placed(self.spark, self.path(name), keys, buckets)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``name``, replacing what is there."""
        save(df, self.path(name))
        return self.spark.read.parquet(self.path(name))

    def drop(self, name: str) -> bool:
        """Forget ``name`` so that the next ``get`` computes it again."""
        return self.has(name) and _delete(self.spark, self.path(name))


def save(thing, path: str, kind: str = "parquet", **options) -> None:
    """Overwrite ``path`` with a DataFrame (any Spark format) or a Spark ML model (``kind='model'``)."""
    if kind == "model":
        thing.write().overwrite().save(path)
    elif kind in {"parquet", "csv", "orc", "json"}:
        if kind == "csv":
            options.setdefault("header", True)
        thing.write.mode("overwrite").format(kind).options(**options).save(path)
    else:
        raise ValueError(f"unknown kind {kind!r}")


def _table_of(path: str) -> str:
    return f"clickloom_{hashlib.md5(path.encode()).hexdigest()[:16]}"


def save_placed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write ``df`` in ``buckets`` files by the hash of ``keys``, each in their order."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {_table_of(path)}")
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(_table_of(path)))


def read_placed(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A table of ``save_placed`` with its placement, also in a session that did not write it."""
    if not spark.catalog.tableExists(_table_of(path)):
        columns = ", ".join(f"`{name}` {kind}" for name, kind in spark.read.parquet(path).dtypes)
        named = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {_table_of(path)} ({columns}) USING parquet CLUSTERED BY ({named}) SORTED BY ({named}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(_table_of(path))
