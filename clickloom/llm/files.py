"""Files that tasks write to, and read from, the folder all machines share."""

from __future__ import annotations

import uuid

from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession

from clickloom.session import scratch_path


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place, as a path or URI that tasks can open."""
    path = scratch_path(spark, name)
    filesystem, inside = opened(path)
    filesystem.create_dir(inside, recursive=True)
    return path


def opened(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = path[len("file:"):]
    return arrow_fs.FileSystem.from_uri(path)


def attempt_name(partition: int, suffix: str) -> str:
    """A file name no other attempt of the task uses: what a lost attempt left is never listed, so never read."""
    return f"part-{partition:06d}-{uuid.uuid4().hex}{suffix}"
