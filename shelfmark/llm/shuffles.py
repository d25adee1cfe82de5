"""Disk that finished steps still hold."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end_with_writes(spark: SparkSession) -> Iterator[None]:
    """Tables written inside drop their shuffle files as soon as they stand.

    Spark otherwise keeps them until the driver collects the objects that stand for them. Stages that
    a lost executor repeats while the table is written still find their shuffles.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)
