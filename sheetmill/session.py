"""Where a job may put intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

#: The JVM does not compile methods of more bytecode than this, which generated code for a
#: wide sheet can exceed. With the limit Spark runs such a step in smaller pieces instead.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}

_CHECKPOINT_DIR = "spark.checkpoint.dir"


@lru_cache(maxsize=1)
def _local_folder() -> tempfile.TemporaryDirectory:
    # Deleted when the process ends.
    return tempfile.TemporaryDirectory(prefix="sheetmill-", ignore_cleanup_errors=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting, as in tests, gets one of its own; a cluster must
    name a folder that all executors reach.
    """
    base = spark.conf.get(_CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder all executors can reach")
        base = _local_folder().name
        spark.conf.set(_CHECKPOINT_DIR, base)
    return base.rstrip("/")


def files_of(spark: SparkSession, path: str, encoded: bool = False):
    """The file system of ``path`` and the path in it; PySpark has no public API for these.

    ``encoded`` tells that special characters are percent-encoded, as Spark reports them.
    """
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if encoded else path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


_folders: set[str] = set()


def _session_folder(spark: SparkSession) -> str:
    path = f"{shared_folder(spark)}/sheetmill-{spark.sparkContext.applicationId}"
    if path not in _folders:
        files, location = files_of(spark, path)
        files.mkdirs(location)
        files.deleteOnExit(location)
        _folders.add(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, deleted when the driver ends at the latest."""
    return f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A scratch path whose content is deleted when the block ends."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        files, location = files_of(spark, path)
        files.delete(location, True)
