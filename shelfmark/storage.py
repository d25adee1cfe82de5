"""Where intermediate tables live: a folder that every executor can reach."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

# both are removed when the process ends
_handed_out: list[str] = []
_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a ``local`` master, where driver and executors are one process, may go without the
    setting; it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", master)
    if app not in _local_folders:
        _local_folders[app] = tempfile.TemporaryDirectory(
            prefix="shelfmark-", ignore_cleanup_errors=True
        )
    return _local_folders[app].name


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a table and read it back: what follows starts from files, not from lineage.

    An executor lost later costs its own tasks only, and row counts taken from the table are exact,
    whereas accumulator-based counts are raised again by every re-run shuffle task.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is stored; one that is not there is fine."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, wherever it is stored; one that is not there has none."""
    files, target = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh path for one run, removed at its end, also when it fails."""
    path = fresh_path(spark, name)
    try:
        yield path
    finally:
        remove(spark, path)


def release(spark: SparkSession) -> None:
    """Remove all folders that ``fresh_path`` gave out in this process; results over them are void."""
    while _handed_out:
        remove(spark, _handed_out.pop())


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession() if _handed_out else None
    if spark is not None and spark.sparkContext._jsc is not None:
        # the JVM may have ended before this process
        with suppress(Py4JError, OSError):
            release(spark)
