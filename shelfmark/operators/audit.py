"""The audit row of a gold run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.checks import mart_profile
from shelfmark.schemas import AUDIT

# Audit column of each mart.
COUNT_COLUMNS = {
    "daily_sales_metrics": "daily_sales_rows",
    "product_category_performance": "product_perf_rows",
    "city_revenue_metrics": "city_revenue_rows",
    "monthly_sales_metrics": "monthly_sales_rows",
    "top_products": "top_products_rows",
}
# The name of the source in the audit row.
SOURCE_TABLE = "retail_sales_clean"


def audit_metadata(source: DataFrame, marts: Mapping[str, DataFrame]) -> DataFrame:
    """One row: counts of the delivered lines and of each mart, and a status that follows from them.

    ``FAILED`` if ``mart_profile`` finds a mart wrong, else ``SUCCESS``, or ``EMPTY`` if nothing was
    delivered. Pass the tables as read back from disk: then it speaks of what was written.
    """
    row = mart_profile(source, marts).agg(
        F.max("source_rows").alias("source_rows"),
        F.bool_and("ok").alias("all_ok"),
        *[
            F.max(F.when(F.col("mart") == mart, F.col("n_rows"))).alias(column)
            for mart, column in COUNT_COLUMNS.items()
        ],
    )
    status = (
        F.when(~F.col("all_ok"), "FAILED")
        .when(F.col("source_rows") == 0, "EMPTY")
        .otherwise("SUCCESS")
    )
    return row.withColumns(
        {
            "source_table": F.lit(SOURCE_TABLE),
            "pipeline_status": status,
            "processed_time": F.current_timestamp().cast("string"),
        }
    ).select(*AUDIT.names)
