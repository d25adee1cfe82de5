"""Checks of the layers. Each returns a DataFrame; ``plans.medallion`` fails the run on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.operators.rules import DROP, SILVER_RULES, Rule

# the column of each mart that counts delivered lines
ORDER_COUNTS = {
    "daily_sales_metrics": "total_orders",
    "product_category_performance": "order_count",
    "city_revenue_metrics": "order_count",
    "monthly_sales_metrics": "monthly_orders",
}


def schema_report(df: DataFrame, expected: StructType) -> DataFrame:
    """(column, expected, actual, n_values, ok) for every declared or present column.

    Columns are matched by name: a partition column sits at the end of a table read back.
    ``n_values`` counts the non-NULL values; a column the table lacks has none.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    names = list(dict.fromkeys([*wanted, *actual]))
    counts = df.agg(*[F.count(F.col(c) if c in actual else F.lit(None)).alias(c) for c in names])
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(wanted.get(name)).cast("string").alias("expected"),
            F.lit(actual.get(name)).cast("string").alias("actual"),
            F.col(name).alias("n_values"),
            F.lit(wanted.get(name) == actual.get(name)).alias("ok"),
        )
        for name in names
    ]
    return counts.select(F.inline(F.array(*rows)))


def schema_differences(
    found: StructType, expected: StructType
) -> list[tuple[str, str | None, str | None]]:
    """(column, expected, actual) where two schemas differ, by name."""
    actual = {f.name: f.dataType.simpleString() for f in found}
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    return [
        (name, wanted.get(name), actual.get(name))
        for name in dict.fromkeys([*wanted, *actual])
        if wanted.get(name) != actual.get(name)
    ]


def schema_check(df: DataFrame, expected: StructType) -> DataFrame:
    """``schema_differences`` of a table as a DataFrame; reads no data."""
    return df.sparkSession.createDataFrame(
        schema_differences(df.schema, expected), "column string, expected string, actual string"
    )


def silver_invariants(
    silver: DataFrame, rules: Sequence[Rule] = SILVER_RULES, key: str | None = "transaction_id"
) -> DataFrame:
    """(invariant, violations): every rule judged again on clean rows, and keys seen again.

    All counts must be 0. The rules take one pass without a shuffle of rows; the key check moves
    keys only and is left out with ``key=None``.
    """
    counts = silver.agg(*[F.expr(f"count_if({r.broken})").alias(r.name) for r in rules])
    result = counts.unpivot([], [rule.name for rule in rules], "invariant", "violations")
    if key is None:
        return result
    repeated = (
        silver.groupBy(key)
        .agg((F.count(F.lit(1)) - 1).alias("again"))
        .agg(F.coalesce(F.sum("again"), F.lit(0)).alias("violations"))
    )
    return result.unionByName(repeated.select(F.lit(f"{key}_unique").alias("invariant"), "violations"))


def count_reconciliation(
    bronze: DataFrame,
    judged: DataFrame,
    silver: DataFrame,
    rules: Sequence[Rule] = SILVER_RULES,
) -> DataFrame:
    """(entry, n_rows): bronze rows against duplicates, rows dropped per rule and silver rows.

    ``judged`` is the deduplicated bronze after ``judge``. What leaves is negative, and the entry
    ``difference`` is the sum of all others: 0 where every row is accounted for.
    """
    rows = F.count(F.lit(1))
    drops = [rule.name for rule in rules if rule.kind == DROP]
    rejected = [F.count_if(F.col("rejected_by") == name).alias(name) for name in drops]

    def entries(one_row: DataFrame, **amounts: Column) -> DataFrame:
        pairs = [F.struct(F.lit(k).alias("entry"), v.alias("n")) for k, v in amounts.items()]
        return one_row.select(F.inline(F.array(*pairs)))

    n = F.col("n")
    parts = [
        # duplicates = deduped - bronze
        entries(bronze.agg(rows.alias("n")), bronze=n, duplicates=-n),
        entries(
            judged.agg(rows.alias("n"), *rejected),
            duplicates=n,
            **{f"drop:{name}": -F.col(name) for name in drops},
        ),
        entries(silver.agg(rows.alias("n")), silver=-n),
    ]
    ledger = reduce(DataFrame.unionByName, parts)
    return ledger.rollup("entry").agg(F.sum("n").alias("n_rows")).select(
        F.coalesce("entry", F.lit("difference")).alias("entry"), "n_rows"
    )


def mart_profile(amounts: DataFrame, marts: Mapping[str, DataFrame]) -> DataFrame:
    """(mart, n_rows, n_orders, source_rows, ok) per mart.

    A mart is ok if it has rows whenever there are delivered lines, and if its order counts add up
    to those lines. ``top_products`` holds no order count, so there ``n_orders`` is NULL.
    """

    def profile(name: str, mart: DataFrame) -> DataFrame:
        orders = F.lit(None).cast("bigint")
        if name in ORDER_COUNTS:
            orders = F.coalesce(F.sum(ORDER_COUNTS[name]), F.lit(0))
        return mart.agg(
            F.lit(name).alias("mart"),
            F.count(F.lit(1)).alias("n_rows"),
            orders.alias("n_orders"),
        )

    source_rows: Column = amounts.select(F.count(F.lit(1))).scalar()
    profiles = reduce(DataFrame.unionByName, [profile(n, m) for n, m in marts.items()])
    complete = F.coalesce(F.col("n_orders") == F.col("source_rows"), F.lit(True))
    return profiles.withColumn("source_rows", source_rows).withColumn(
        "ok", complete & ((F.col("n_rows") > 0) == (F.col("source_rows") > 0))
    )
