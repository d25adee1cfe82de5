"""Parquet layers: partitioned bronze and silver, plain gold marts."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.schemas import RANGES
from shelfmark.sources.generations import Home, Version


def inferred_layer(spark: SparkSession, path: str) -> DataFrame:
    """A layer as its files describe it, for ``schema_check``."""
    return spark.read.parquet(path)


def file_schema(spark: SparkSession, path: str) -> StructType:
    """The schema of all files of a folder together; files that contradict each other raise.

    Footers are read by Spark tasks, no data is. A folder without files has no columns.
    """
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return StructType([])


def read_layer(spark: SparkSession, path: str, expected: StructType) -> DataFrame:
    """Scan a layer under its declared schema, columns in declared order.

    A declared column that the files lack raises, instead of reading as NULL. Where types differ,
    the files are read under the declared ones: a partition column whose values are all NULL gets
    its type back, and a data column of another type fails in the scan. A layer without files
    (nothing survived cleaning) is an empty table.
    """
    return _declared(lambda: spark.read, [path], expected)


def read_version(spark: SparkSession, home: Home, version: Version, expected: StructType) -> DataFrame:
    """Scan the folders that a version names, as ``read_layer`` scans one."""
    if not version.folders:
        return spark.createDataFrame([], expected)
    return _declared(lambda: spark.read.option("basePath", home.data), version.paths(home), expected)


def _declared(reader, paths: Sequence[str], expected: StructType) -> DataFrame:
    def scan(fresh: DataFrameReader) -> DataFrame:
        return fresh.parquet(*paths)

    try:
        found = scan(reader())
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return scan(reader().schema(expected)).select(*expected.names)
    missing = [name for name in expected.names if name not in found.columns]
    if missing:
        raise ValueError(f"{', '.join(paths[:3])} lacks the columns {', '.join(missing)}")
    layer = found.select(*expected.names)
    if layer.schema != expected:
        layer = scan(reader().schema(expected)).select(*expected.names)
    return layer


def write_bronze(
    df: DataFrame, path: str, dynamic: bool = False, rebalance: bool = False
) -> None:
    """Replace the bronze table, one folder per ingestion date, without a shuffle.

    A raw file holds one ingestion date or few, so each scan task writes few files. Where files mix
    many dates, ``rebalance=True`` brings the rows of a date together first; AQE then splits a date
    that is too large for one task. ``dynamic=True`` replaces only the dates present in ``df``.
    """
    if rebalance:
        df = df.hint("rebalance", "ingestion_date")
    writer = df.write.mode("overwrite").partitionBy("ingestion_date")
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_silver(df: DataFrame, path: str, rebalance: bool = False) -> None:
    """Replace the silver table, one folder per order status.

    Rows are written where they are: a file per task and status, without a shuffle. ``rebalance``
    brings the rows of a status together first, at the price of moving the whole table; AQE cuts each
    status into pieces of the advisory size.
    """
    if rebalance:
        df = df.hint("rebalance", "order_status")
    df.write.mode("overwrite").partitionBy("order_status").parquet(path)


def write_mart(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Replace a mart. ``single_file`` is for marts bounded by the calendar or by one row.

    Only the finished rows move to the one writing task; ``coalesce(1)`` would pull the aggregation
    before it into that task as well.
    """
    if single_file:
        df = df.repartition(1)
    df.write.mode("overwrite").parquet(path)


def file_ranges(mart: DataFrame, column: str) -> DataFrame:
    """(file, first_rank, n_rows, highest, lowest) of a mart written in descending order of ``column``.

    A row per file, in the order of the ranges they hold; only that small table meets in one task.
    """
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    held = mart.select(name.alias("file"), F.col(column).alias("value")).groupBy("file")
    files = held.agg(F.count(F.lit(1)).alias("n_rows"), F.max("value").alias("highest"), F.min("value").alias("lowest"))
    # the writer numbers its files by range, which also orders files of equal values
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    before = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n_rows").over(before), F.lit(0)) + 1
    return files.withColumn("first_rank", first).select(*RANGES.names)


def read_ranked(
    spark: SparkSession, path: str, expected: StructType, ranges: DataFrame, k: int | None = None
) -> DataFrame:
    """A mart in the order it was written in, without sorting it again: its files one after the other.

    With ``k`` only the first files are listed, up to the one that holds the k-th row.
    """
    needed = ranges if k is None else ranges.filter(F.col("first_rank") <= k)
    # a row per file, of those needed
    files = [row.file for row in needed.select("file", "first_rank").orderBy("first_rank").collect()]
    if not files:
        return spark.createDataFrame([], expected)
    scans = [spark.read.schema(expected).parquet(f"{path}/{file}") for file in files]
    return reduce(DataFrame.unionAll, scans)
