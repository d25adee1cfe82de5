"""Facts about one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column, ascending."""
    return df.select(column).distinct().orderBy(column)


def value_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for each value of each column, NULL included, from one pass."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def row_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """(layer, n_rows) per table. On Parquet layers only file footers are read."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def partition_profile(df: DataFrame) -> DataFrame:
    """(partition, n) for each non-empty partition of the plan."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))


def table_profile(df: DataFrame, values: Sequence[str], counts: Mapping[str, Column]) -> DataFrame:
    """(fact, subject, value, n), all from one pass over ``df``.

    ``rows`` is the number of rows, ``partition`` that of each non-empty partition of the plan (its number
    is the value), ``value`` that of each value, as text and NULL included, of each column in ``values``,
    and ``count`` that of the rows where a condition of ``counts`` holds. Rows and counts are there at 0
    too. A task sends one partial total per value it meets.
    """
    keys = [f"k{i}" for i in range(len(values) + 1)]
    hits = {name: f"c{i}" for i, name in enumerate(counts)}
    narrow = df.select(
        F.spark_partition_id().cast("string").alias(keys[0]),
        *[F.col(c).cast("string").alias(key) for c, key in zip(values, keys[1:], strict=True)],
        *[counts[name].alias(hit) for name, hit in hits.items()],
    )
    totals = narrow.groupingSets([[key] for key in keys], *keys).agg(
        F.grouping_id(*keys).alias("key_set"),
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(hit).alias(hit) for hit in hits.values()],
    )

    def fact(name: str, subject: str | None, value: Column, n: Column) -> Column:
        text = F.lit(subject).cast("string")
        return F.struct(F.lit(name).alias("fact"), text.alias("subject"), value.cast("string").alias("value"), n.cast("long").alias("n"))

    def grouped_by(place: int) -> Column:
        return F.col("key_set") == (1 << len(keys)) - 1 - (1 << len(keys) - 1 - place)

    nothing, n = F.lit(None), F.col("n")
    facts = F.when(grouped_by(0), F.array(
        fact("rows", None, nothing, n),
        fact("partition", None, F.col(keys[0]), n),
        *[fact("count", name, nothing, F.col(hit)) for name, hit in hits.items()],
    ))
    for place, column in enumerate(values, 1):
        facts = facts.when(grouped_by(place), F.array(fact("value", column, F.col(keys[place]), n)))
    zeros = F.array(fact("rows", None, nothing, F.lit(0)), *[fact("count", name, nothing, F.lit(0)) for name in hits])
    found = totals.select(F.inline(facts)).unionByName(df.sparkSession.range(1).select(F.inline(zeros)))
    return found.groupBy("fact", "subject", "value").agg(F.sum("n").alias("n"))


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)
