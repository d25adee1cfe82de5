"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.schemas import ORIGIN, RAW


def total_order(columns: Sequence[str] = RAW.names, newest: str = "ingestion_date") -> list[Column]:
    """Newest first, then every other column: rows that still tie are equal."""
    return [
        F.col(newest).desc_nulls_last(),
        *[F.col(name).asc_nulls_last() for name in columns if name != newest],
    ]


def dedupe(
    df: DataFrame, key: str = "transaction_id", order: Sequence[Column] | None = None
) -> DataFrame:
    """Keep the first row of each key by ``order``; NULL is one key.

    The survivor does not depend on partitioning or on re-run tasks. Spark turns ``row_number() = 1``
    into a limit per group that also runs before the shuffle, so a task sends one row per key at
    most, and a key that holds a third of all rows reaches its reducer as one row per task.
    """
    others = [name for name in df.columns if name != key]
    first = Window.partitionBy(key).orderBy(*(order or total_order(others)))
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def dedupe_counted(df: DataFrame, key: str = "transaction_id", newest: str = "ingestion_date") -> DataFrame:
    """The rows that ``dedupe`` keeps by the total order of the raw columns, with ``copies``, the rows per key.

    One shuffle gives both: each task sends the first row and the number of rows of each of its keys.
    Columns of ``ORIGIN`` come along where ``df`` has them, after all others in the order, so that
    they name one row's source but never decide which values survive.
    """
    raw = [name for name in df.columns if name not in {key, newest, *ORIGIN.names}]
    carried = [*raw, *[name for name in ORIGIN.names if name in df.columns]]
    # structs compare field by field with NULL first: the flag before each value puts it last
    order = [F.col(newest).isNull(), -F.unix_date(newest)]
    for name in carried:
        order += [F.col(name).isNull(), F.col(name)]
    first = F.min(F.struct(*[field.alias(f"f{n}") for n, field in enumerate(order)]))
    best = df.groupBy(key).agg(first.alias("best"), F.count(F.lit(1)).alias("copies"))
    values = {newest: F.date_from_unix_date(-F.col("best.f1"))}
    values |= {name: F.col(f"best.f{2 * n + 3}") for n, name in enumerate(carried)}
    return best.select(*[values.get(name, F.col(name)).alias(name) for name in df.columns], "copies")


def duplicate_keys(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """(key, n) of every key seen more than once; NULL is one key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
