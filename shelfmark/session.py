"""Sessions and their sizing. Library functions never build a session: they take ``spark``."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

GIB = 1 << 30
# measured: 12.5 MB of bronze became 56.5 MB of shuffle writes
SHUFFLED_PER_BYTE = 5
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
# a shuffled byte takes six in a sort, and a task has a gigabyte or so for it
SORTED_BYTES = 64 << 20
# beyond so many partitions the blocks of a shuffle get small, and partitions grow instead
MANY_PARTITIONS = 10_000
# Parquet of bronze becomes up to 20 times as many bytes in the sort before the shuffle
SCANNED_BYTES = 32 << 20
SCAN_PARTITIONS = "spark.sql.files.maxPartitionBytes"
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
# rounds of tasks that a scan takes at least: with fewer most cores idle in the last one
ROUNDS = 4
LEAST_SCANS = "spark.sql.files.minPartitionNum"
ADVISORY_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# shuffled bytes that a task joins and writes as raw text
JOINED_BYTES = 32 << 20
PARQUET_DICTIONARY = "parquet.dictionary.page.size"
# a column's dictionary up to this size stays in a core's cache, beside those of the other columns
DICTIONARY_BYTES = 64 << 10


def build_session(app_name: str, settings: dict[str, object] | None = None) -> SparkSession:
    """Session with the settings the results depend on; the cluster decides everything else."""
    builder = (
        SparkSession.builder.appName(app_name)
        # dates and month keys must not depend on where the job runs
        .config("spark.sql.session.timeZone", "UTC")
        # AQE merges small shuffle partitions, splits skewed joins and skewed rebalances
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def planned_bytes(df: DataFrame) -> int:
    """Bytes that ``df`` reads, as the planner knows them from the file listing; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def shuffle_partitions(input_bytes: int, parallelism: int = 1, target_bytes: int = GIB) -> int:
    """Number of shuffle partitions for a job that reads ``input_bytes`` of Parquet.

    What the deduplication moves is several times what it reads: columns become rows and lose their
    encoding. Partitions are sized for that; AQE merges what turns out small.
    """
    return max(parallelism, -(-SHUFFLED_PER_BYTE * input_bytes // target_bytes))


def job_partitions(input_bytes: int, parallelism: int = 1) -> int:
    """Shuffle partitions that a task sorts in memory, while they are not too many."""
    in_memory = shuffle_partitions(input_bytes, parallelism, SORTED_BYTES)
    return max(min(in_memory, MANY_PARTITIONS), shuffle_partitions(input_bytes, parallelism))


@contextmanager
def sized_shuffles(spark: SparkSession, df: DataFrame) -> Iterator[None]:
    """Scan and shuffle partitions that tasks sort in memory, for a job over ``df``; what someone has set stays."""
    partitions = job_partitions(planned_bytes(df), spark.sparkContext.defaultParallelism)
    with _unless_set(spark, SHUFFLE_PARTITIONS, partitions), even_scans(spark):
        yield


@contextmanager
def even_scans(spark: SparkSession) -> Iterator[None]:
    """Scans are cut into several tasks per core, none over ``SCANNED_BYTES``; what someone has set stays.

    Spark otherwise gives each core about one task, and files that do not split make it one and a
    bit: half of the cores then wait for the rest. Pieces stay above ``spark.sql.files.openCostInBytes``.
    """
    least = ROUNDS * spark.sparkContext.defaultParallelism
    with _unless_set(spark, SCAN_PARTITIONS, SCANNED_BYTES), _unless_set(spark, LEAST_SCANS, least):
        yield


@contextmanager
def even_joins(spark: SparkSession) -> Iterator[None]:
    """``even_scans``, and shuffles whose small partitions are merged up to ``JOINED_BYTES`` only."""
    with even_scans(spark), _unless_set(spark, ADVISORY_BYTES, JOINED_BYTES):
        yield


@contextmanager
def unsorted_writes(spark: SparkSession, folders: int = 16) -> Iterator[None]:
    """A task writes to so many folders at a time, where Spark sorts its rows by folder otherwise.

    What goes to further folders is sorted as before. A number that someone has set stays.
    """
    with _unless_set(spark, OPEN_WRITERS, folders):
        yield


@contextmanager
def small_dictionaries(spark: SparkSession) -> Iterator[None]:
    """Parquet columns of many values give up their dictionary early; what someone has set stays.

    The values and what readers see are the same. Parquet otherwise looks each value up in up to a megabyte
    of a column's earlier ones, for every column and every folder that a task writes to.
    """
    if spark.sparkContext._jsc.hadoopConfiguration().get(PARQUET_DICTIONARY) is not None:
        yield
        return
    with _unless_set(spark, PARQUET_DICTIONARY, DICTIONARY_BYTES):
        yield


@contextmanager
def _unless_set(spark: SparkSession, name: str, value: int) -> Iterator[None]:
    if name in spark.conf.getAll:
        yield
        return
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name)
