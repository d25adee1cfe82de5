"""What to look at after each job, as named DataFrames; the command line shows them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.checks import mart_profile, schema_report, silver_invariants
from shelfmark.operators.dedupe import duplicate_keys
from shelfmark.operators.marts import order_amounts
from shelfmark.operators.profile import (
    null_profile,
    preview,
    row_counts,
    table_profile,
    value_distribution,
)
from shelfmark.plans.medallion import (
    Layout,
    read_audit,
    read_bronze,
    read_facts,
    read_marts,
    read_silver,
    read_top_products,
)
from shelfmark.schemas import BRONZE, BRONZE_FILES, RAW, SILVER
from shelfmark.sources.generations import versions
from shelfmark.sources.raw import FIELDS
from shelfmark.storage import fresh_path, stage

_BRONZE_VALUES = ["order_status", "product_category", "gender"]


def bronze_report(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The bronze table. All counts come from one scan; repeated keys take one more, of the key alone."""
    files, bronze = read_bronze(spark, layout, BRONZE_FILES), read_bronze(spark, layout)
    counts = {f"null {c}": F.col(c).isNull() for c in BRONZE.names}
    counts |= {f"unreadable {c}": F.array_contains("unreadable", F.lit(c)) for c in [*RAW.names, FIELDS]}
    profile = table_profile(files, ["ingestion_date", *_BRONZE_VALUES], counts)
    profile = stage(profile.coalesce(1), fresh_path(spark, "bronze-profile"))

    def counted(prefix: str, n: str) -> DataFrame:
        found = profile.filter((F.col("fact") == "count") & F.col("subject").startswith(prefix))
        return found.select(F.substring("subject", len(prefix) + 1, 1000).alias("column"), F.col("n").alias(n))

    values = profile.filter("fact = 'value'")
    dates = values.filter("subject = 'ingestion_date'").select(F.col("value").cast("date").alias("ingestion_date"))
    return {
        "rows": profile.filter("fact = 'rows'").select(F.lit("bronze").alias("layer"), F.col("n").alias("n_rows")),
        "schema": schema_report(files, BRONZE_FILES),
        "unreadable values": counted("unreadable ", "n_values"),
        "unreadable lines": preview(files.filter("raw_record IS NOT NULL").select("source_file", "unreadable", "raw_record"), 5),
        "partitions": profile.filter("fact = 'partition'").select(F.col("value").cast("int").alias("partition"), "n"),
        "ingestion dates": dates.orderBy("ingestion_date"),
        "nulls": counted("null ", "nulls"),
        "sample": preview(bronze, 10),
        "values": values.filter(F.col("subject").isin(_BRONZE_VALUES)).select(F.col("subject").alias("column"), "value", "n"),
        "duplicate transactions": preview(duplicate_keys(bronze), 5),
    }


def silver_report(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The silver table, and what its job met: read from its facts, not from bronze again."""
    silver, facts = read_silver(spark, layout), read_facts(spark, layout)

    def fact(name: str, subject: str, n: str) -> DataFrame:
        found = facts.filter(F.col("fact") == name)
        return found.select(F.col("subject").alias(subject), F.col("n").alias(n))

    return {
        "rows met": fact("rows", "rows", "n"),
        "duplicate transactions": fact("repeated_key", "transaction_id", "n"),
        "violations met": facts.filter("fact = 'violation'").select(F.col("subject").alias("rule"), "record"),
        "gender met": fact("gender_met", "gender", "n"),
        "rules": fact("rule", "rule", "n_rows"),
        "rows": row_counts({"silver": silver}),
        "schema": schema_report(silver, SILVER),
        "values": value_distribution(silver, ["product_category", "payment_type", "gender"]),
        "nulls": null_profile(silver.select("payment_type", "gender", "unit_price")),
        "invariants": silver_invariants(silver),
    }


def gold_report(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    marts = read_marts(spark, layout)
    amounts = order_amounts(read_silver(spark, layout))
    return {
        "marts": mart_profile(amounts, marts),
        **{name: preview(mart, 10) for name, mart in marts.items()},
        "top_products": read_top_products(spark, layout, 10),
        "audit": read_audit(spark, layout),
    }


def version_report(spark: SparkSession, layout: Layout) -> DataFrame:
    """(layer, number, generation, published_at, n_folders, path), the newest version of each layer first."""
    rows = [
        (layer, v.number, v.generation, v.published_at, len(v.folders), home.folder(v.generation))
        for layer, home in layout.layers.items()
        for v in versions(spark, home)
    ]
    schema = "layer string, number long, generation string, published_at timestamp, n_folders int, path string"
    return spark.createDataFrame(rows, schema)
