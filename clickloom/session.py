"""Session settings and the shared scratch folder."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from threading import Lock
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Runtime settings the operators count on.  Skewed join partitions (one user or
# app holding a large share of the clicks) are split by adaptive execution; the
# force flag keeps that split even where it costs one more exchange.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, app: str = "clickloom", memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see.

    The cluster names it in ``spark.checkpoint.dir``.  Only where neither that nor a
    checkpoint folder is set, a temporary folder is made, and only on one machine: on a cluster
    each executor would write to its own disk, so there the folder must be named.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("name a folder that all machines share in spark.checkpoint.dir")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="clickloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets.

    All paths of one application share a folder, which can go when it has ended.
    """
    application = spark.sparkContext.applicationId
    scope = "".join(f"{s}/" for s in _SCOPES[-1:])
    return f"{shared_dir(spark).rstrip('/')}/clickloom/{application}/{scope}{name}-{uuid.uuid4().hex}"


_SCOPES: list[str] = []
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"
_READ = "spark.sql.parquet.columnarReaderBatchSize"


@contextmanager
def small_batches(spark: SparkSession, most: str = "4m", rows: int = 16) -> Iterator[None]:
    """Rows with whole texts go to and from the Python workers at most ``most`` at once in the block, not Spark's 10,000 rows or 64 MB; a
    larger row goes alone.  From Parquet they are read ``rows`` at once, not 4,096: the reader holds all their texts on the heap, twice while
    it makes room.

    For tables that are written inside the block: what is only planned there runs under the session's own setting.
    """
    wanted = {_BATCHES: most, _READ: str(rows)}
    usual = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in usual.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Release what is written to the shared folder inside the block when it ends.

    Results must have been written to a place of their own, or collected, by then: a DataFrame that still reads such a table fails
    afterwards.  Blocks may be nested; each frees its own tables.  Threads started inside count as inside.
    """
    scope = "/".join([*_SCOPES[-1:], f"scope-{uuid.uuid4().hex}"])
    _SCOPES.append(scope)
    try:
        yield
    finally:
        _SCOPES.remove(scope)
        jvm, context = spark.sparkContext._jvm, spark.sparkContext
        target = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/clickloom/{context.applicationId}/{scope}")
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def pin(df: DataFrame, name: str = "pin") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage so that later jobs see one fixed version of the rows even
    after executors are lost; parquet keeps column pruning and pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _package() -> bytes:
    """This package's sources as an archive: the same bytes for the same sources, whenever and wherever it is made."""
    root, out = os.path.dirname(os.path.abspath(__file__)), io.BytesIO()
    sources = sorted(os.path.join(folder, name) for folder, _, names in os.walk(root) for name in names if name.endswith(".py"))
    with zipfile.ZipFile(out, "w") as archive:
        for full in sources:
            with open(full, "rb") as f:
                archive.writestr(zipfile.ZipInfo(os.path.relpath(full, os.path.dirname(root)).replace(os.sep, "/")), f.read())
    return out.getvalue()


_SHIPPING = Lock()


def ship_package(spark: SparkSession) -> None:
    """Once per application, hand Spark this package's sources, so that the few functions that run in Python workers find it there.

    The archive is named by its contents, and Spark is asked whether it has it: a second file of one name would stop all later tasks.
    """
    code = _package()
    name = f"clickloom-{hashlib.sha256(code).hexdigest()[:16]}.zip"
    with _SHIPPING:
        if any(os.path.basename(path) == name for path in spark.sparkContext.listFiles):
            return
        path = os.path.join(tempfile.mkdtemp(prefix="clickloom-code-"), name)
        with open(path, "wb") as f:
            f.write(code)
        spark.sparkContext.addPyFile(path)


def together(spark: SparkSession, *builds: Callable[[], T]) -> list[T]:
    """Run independent builds side by side, so that one small job does not leave the cluster idle."""
    with ThreadPool(len(builds)) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda build: build()), builds)
