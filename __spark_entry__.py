"""

All queries read the test tables of ``sf_dir`` whole, mapped to the retail input. Those named
``*_roundtrip`` and the layer checks write layers below the shared folder first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixture import retail_raw, unreadable_text
from checks.oracle import oracle_queries
from shelfmark.operators.audit import audit_metadata
from shelfmark.operators.checks import (
    count_reconciliation,
    mart_profile,
    schema_report,
    silver_invariants,
)
from shelfmark.operators.clean import clean, stamp
from shelfmark.operators.dedupe import dedupe, duplicate_keys, total_order
from shelfmark.operators.marts import (
    category_performance,
    city_revenue,
    daily_sales,
    mart_totals,
    monthly_sales,
    order_amounts,
    top_products,
)
from shelfmark.operators.profile import (
    null_profile,
    partition_profile,
    partition_values,
    row_counts,
    value_distribution,
)
from shelfmark.operators.rules import (
    PREVIEWED,
    accepted,
    apply_rules,
    judge,
    rule_report,
    rules_named,
    settle,
    violation_previews,
)
from shelfmark.plans.medallion import (
    Layout,
    ingest,
    ranked_products,
    read_bronze,
    read_facts,
    read_marts,
    read_silver,
    refine,
    run,
    write_marts,
)
from shelfmark.schemas import BRONZE, BRONZE_FILES, SILVER, SILVER_WITH_ORIGIN
from shelfmark.session import even_joins, unsorted_writes
from shelfmark.sources import (
    inferred_layer,
    read_layer,
    read_raw,
    unreadable_values,
    with_ingest_metadata,
    write_bronze,
    write_silver,
)
from shelfmark.storage import fresh_path, stage

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
# about 30 MB of raw text
RECORDS_PER_FILE = 250_000


def _edge(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles."""
    money = [f.name for f in df.schema if f.dataType.typeName() == "decimal"]
    return df.withColumns({name: F.col(name).cast("double") for name in money})


def _deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(retail_raw(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(retail_raw(spark, sf_dir))


def _amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_amounts(clean(retail_raw(spark, sf_dir), processed_at=False))


def _csv(df: DataFrame, *folders: str) -> str:
    """Rows as CSV files, padded text kept as it is; compressed files do not split, so they are bounded."""
    path = fresh_path(df.sparkSession, "raw-csv")
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    files = {"compression": "lz4", "maxRecordsPerFile": RECORDS_PER_FILE}
    with even_joins(df.sparkSession), unsorted_writes(df.sparkSession):
        df.write.options(header=True, **options, **files).partitionBy(*folders).csv(path)
    return path


def _raw_csv(spark: SparkSession, sf_dir: str) -> str:
    return _csv(retail_raw(spark, sf_dir))


def _written_bronze(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "bronze")
    write_bronze(retail_raw(spark, sf_dir), path)
    return path


def _written_silver(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "silver")
    write_silver(_silver(spark, sf_dir), path)
    return path


def _gold(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Delivered lines of a written silver layer, and the marts written from them."""
    amounts = order_amounts(read_layer(spark, _written_silver(spark, sf_dir), SILVER))
    return amounts, write_marts(amounts, fresh_path(spark, "gold"))


def _one_rule(name: str) -> Query:
    (rule,) = rules_named(name)

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        cleaned = apply_rules(_deduped(spark, sf_dir), [rule])
        return _edge(cleaned.select("transaction_id", rule.column))

    return query


def _stamps(df: DataFrame, time: str, *extra) -> DataFrame:
    """Counts that hold for volatile columns."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *extra,
        F.count(time).alias("stamped"),
        F.count_distinct(time).alias("run_times"),
    )


def bronze_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw(spark, _raw_csv(spark, sf_dir), check_header=True)


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_layer(spark, _written_bronze(spark, sf_dir), BRONZE)


def bronze_ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the whole path of a file that was read, and files that rows came from."""
    raw = read_raw(spark, _raw_csv(spark, sf_dir))
    files = raw.inputFiles()
    # the listing and the rows may spell a path's beginning differently
    paths = [f[f.index("/") :].lstrip("/") for f in files]
    path = F.ltrim(F.regexp_replace("source_file", "^[^/]*", ""), F.lit("/"))
    named = F.count_if(path.isin(paths)).alias("from_csv")
    rows = with_ingest_metadata(raw)
    holding = F.lit(len([f for f in files if not spark.read.options(header=True).csv(f).isEmpty()]))
    met = (F.count_distinct("source_file") == holding).alias("files_told_apart")
    return _stamps(rows, "ingested_at", named, met)


def ingestion_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition_values(bronze_roundtrip(spark, sf_dir), "ingestion_date")


def bronze_partition_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of the profile whatever the partitions are."""
    profile = partition_profile(bronze_roundtrip(spark, sf_dir))
    return profile.agg(F.sum("n").alias("n_rows"), (F.min("n") > 0).alias("all_filled"))


def bronze_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(retail_raw(spark, sf_dir))


def silver_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(_silver(spark, sf_dir).select("payment_type", "gender", "unit_price"))


def bronze_value_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["order_status", "product_category", "gender", "payment_type"]
    return value_distribution(retail_raw(spark, sf_dir), columns)


def silver_value_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_distribution(
        _silver(spark, sf_dir), ["product_category", "payment_type", "gender"]
    )


def repeated_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(retail_raw(spark, sf_dir))


def dedupe_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deduped(spark, sf_dir)


def silver_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rules_named("transaction_id_present", "customer_id_present")
    return apply_rules(_deduped(spark, sf_dir), rules).select("transaction_id", "customer_id")


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = read_layer(spark, _written_silver(spark, sf_dir), SILVER)
    return _edge(silver.drop("silver_processed_at"))


def silver_rules_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = retail_raw(spark, sf_dir)
    return _edge(clean(raw, dedupe_after_rules=True, processed_at=False))


def silver_processed_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamps(_silver(spark, sf_dir), "silver_processed_at")


def silver_rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_report(_deduped(spark, sf_dir))


def violation_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five violating rows of each previewed rule, the drops before it applied."""
    return violation_previews(_deduped(spark, sf_dir), total_order(), shown=PREVIEWED)


def deduped_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gender values that the silver rules meet."""
    return value_distribution(_deduped(spark, sf_dir), ["gender"])


def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_report(inferred_layer(spark, _written_silver(spark, sf_dir)), SILVER)


def silver_layer_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_invariants(read_layer(spark, _written_silver(spark, sf_dir), SILVER))


def row_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze and silver as written, and the staged verdicts between them."""
    bronze = bronze_roundtrip(spark, sf_dir)
    judged = stage(settle(judge(dedupe(bronze))), fresh_path(spark, "judged"))
    path = fresh_path(spark, "silver")
    write_silver(stamp(accepted(judged)), path)
    return count_reconciliation(bronze, judged, read_layer(spark, path, SILVER))


def delivered_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = _edge(_amounts(spark, sf_dir))
    return amounts.withColumn("total_amount", F.coalesce("total_amount", "huge_amount")).drop("huge_amount")


def gold_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _edge(mart_totals(_amounts(spark, sf_dir)))
    return totals.withColumn("amount", F.coalesce(F.col("amount") + F.col("huge"), "amount", "huge")).drop("huge")


def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and revenue of every row of every written mart."""
    _, marts = _gold(spark, sf_dir)
    keys = {
        "daily_sales_metrics": (F.col("order_date").cast("string"), "total_revenue"),
        "product_category_performance": (F.col("product_category"), "category_revenue"),
        "city_revenue_metrics": (F.concat_ws("/", "city", "state"), "city_revenue"),
        "monthly_sales_metrics": (F.col("year_month"), "monthly_revenue"),
        "top_products": (F.col("product_id"), "revenue"),
    }
    parts = [
        marts[name].select(
            F.lit(name).alias("mart"), key.alias("key"), F.col(revenue).alias("revenue")
        )
        for name, (key, revenue) in keys.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def gold_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_profile(*_gold(spark, sf_dir))


def gold_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_metadata(*_gold(spark, sf_dir)).drop("processed_time")


def retail_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = run(spark, _raw_csv(spark, sf_dir), fresh_path(spark, "retail"))
    return audit.drop("processed_time")


def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = Layout(fresh_path(spark, "retail"))
    run(spark, _raw_csv(spark, sf_dir), layout.root)
    layers = {"bronze": read_bronze(spark, layout), "silver": read_silver(spark, layout)}
    return row_counts({**layers, **read_marts(spark, layout)})


def bronze_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values per column that the parser could not read, from the ledger of a published bronze layer."""
    layout = Layout(fresh_path(spark, "retail"))
    ingest(spark, _csv(unreadable_text(retail_raw(spark, sf_dir))), layout)
    return unreadable_values(read_bronze(spark, layout, BRONZE_FILES))


def bronze_replaced_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by date after one date was ingested again, without its repeated transactions."""
    layout = Layout(fresh_path(spark, "retail"))
    ingest(spark, _raw_csv(spark, sf_dir), layout)
    day = _deduped(spark, sf_dir).filter("ingestion_date = DATE '2024-01-02'")
    ingest(spark, _csv(day), layout, dynamic=True, check_counts=True)
    return read_bronze(spark, layout).groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("n_rows"))


def silver_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder that each silver row's file lay in: the raw files are dealt into one per date."""
    layout = Layout(fresh_path(spark, "retail"))
    rows = retail_raw(spark, sf_dir).withColumn("day", F.date_format("ingestion_date", "dd"))
    ingest(spark, _csv(rows, "day") + "/day=*", layout)
    refine(spark, layout, origin=True)
    silver = read_silver(spark, layout, SILVER_WITH_ORIGIN)
    folder = F.regexp_extract("source_file", "(day=[0-9]+)/[^/]*$", 1)
    return silver.select("transaction_id", folder.alias("folder"))


def silver_job_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the silver job kept of what it met; of the rows shown, how many there are of each kind."""
    layout = Layout(fresh_path(spark, "retail"))
    ingest(spark, _raw_csv(spark, sf_dir), layout)
    refine(spark, layout)
    facts = read_facts(spark, layout)
    shown = F.col("fact").isin("violation", "repeated_key")
    counted = facts.filter(~shown).select("fact", "subject", "n")
    kinds = F.when(F.col("fact") == "violation", F.col("subject")).alias("subject")
    of_shown = facts.filter(shown).groupBy("fact", kinds).agg(F.count(F.lit(1)).alias("n"))
    return counted.unionByName(of_shown)


def top_products_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 best products, from the first files of the written mart."""
    folder = fresh_path(spark, "gold")
    write_marts(_amounts(spark, sf_dir), folder)
    return ranked_products(spark, folder, 25)


def _mart(mart: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: mart(_amounts(spark, sf_dir))


def _optional(name: str) -> object | None:
    """A module that may have been left out of this installation; its own errors are not hidden."""
    try:
        return import_module(name)
    except ModuleNotFoundError as error:
        if error.name and name.startswith(error.name):
            return None
        raise


_LLM = _optional("shelfmark.llm.queries")
# the pipeline is made of the subpackage's operators, and goes with it
_PIPELINE = _optional("corpus_pipeline") if _LLM else None


def _text_queries() -> dict[str, Query]:
    """Those of the text subpackage and its pipeline, where installed."""
    found = dict(_LLM.QUERIES) if _LLM else {}
    return found | ({"pipeline": _PIPELINE.run} if _PIPELINE else {})


def _text_oracles() -> dict[str, str]:
    found = dict(_LLM.ORACLES) if _LLM else {}
    if _PIPELINE and _PIPELINE.ORACLE_SQL:
        found["pipeline"] = _PIPELINE.ORACLE_SQL
    return found


def queries() -> dict[str, Query]:
    return _retail_queries() | _text_queries()


def _retail_queries() -> dict[str, Query]:
    return {
        "bronze_csv_roundtrip": bronze_csv_roundtrip,
        "bronze_roundtrip": bronze_roundtrip,
        "bronze_ingest_metadata": bronze_ingest_metadata,
        "ingestion_dates": ingestion_dates,
        "partition_profile": bronze_partition_profile,
        "null_profile": bronze_null_profile,
        "silver_null_profile": silver_null_profile,
        "value_distribution": bronze_value_distribution,
        "silver_value_distribution": silver_value_distribution,
        "duplicate_keys": repeated_transactions,
        "dedupe_transactions": dedupe_transactions,
        "silver_not_null": silver_not_null,
        "silver_category": _one_rule("active_category"),
        "silver_quantity": _one_rule("positive_quantity"),
        "clean_ship_date": _one_rule("ship_not_before_order"),
        "clean_order_status": _one_rule("known_status"),
        "clean_unit_price": _one_rule("positive_price"),
        "clean_discount": _one_rule("discount_range"),
        "clean_age": _one_rule("age_range"),
        "clean_gender": _one_rule("gender_code"),
        "clean_payment": _one_rule("payment_code"),
        "silver_roundtrip": silver_roundtrip,
        "silver_rules_first": silver_rules_first,
        "silver_processed_at": silver_processed_at,
        "rule_report": silver_rule_report,
        "violation_preview": violation_preview,
        "deduped_gender": deduped_gender,
        "schema_check": schema_check,
        "silver_invariants": silver_layer_invariants,
        "count_reconciliation": row_reconciliation,
        "order_amounts": delivered_amounts,
        "daily_sales_metrics": _mart(daily_sales),
        "product_category_performance": _mart(category_performance),
        "city_revenue_metrics": _mart(city_revenue),
        "monthly_sales_metrics": _mart(monthly_sales),
        "top_products": _mart(top_products),
        "top_products_k": _mart(lambda amounts: top_products(amounts, k=10)),
        "mart_totals": gold_totals,
        "gold_roundtrip": gold_roundtrip,
        "gold_profile": gold_profile,
        "audit_metadata": gold_audit,
        "layer_row_counts": layer_row_counts,
        "bronze_unreadable": bronze_unreadable,
        "bronze_replaced_dates": bronze_replaced_dates,
        "silver_origin": silver_origin,
        "silver_job_facts": silver_job_facts,
        "top_products_readback": top_products_readback,
        "retail_end_to_end": retail_end_to_end,
    }


def oracle_sql() -> dict[str, str]:
    return oracle_queries() | _text_oracles()


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: sales by product category, from the mapped raw rows through cleaning and pricing."""
    return queries()["product_category_performance"](spark, SMOKE_DIR)
