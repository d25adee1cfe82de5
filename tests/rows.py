"""Hand-written raw rows: one clean row, changed column by column."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from shelfmark.schemas import RAW

CLEAN = {
    "transaction_id": 1,
    "order_date": date(2024, 5, 10),
    "ship_date": date(2024, 5, 12),
    "customer_id": "CUST1",
    "customer_age": 30,
    "gender": "M",
    "product_id": "PROD1",
    "product_category": "Sports",
    "quantity": 2,
    "unit_price": 10.0,
    "discount_pct": 10.0,
    "city": "Dallas",
    "state": "TX",
    "payment_type": "UPI",
    "order_status": "Delivered",
    "ingestion_date": date(2024, 6, 1),
}


def raw_frame(spark: SparkSession, *changes: dict) -> DataFrame:
    """One row per change; ids count up unless given."""
    rows = [{**CLEAN, "transaction_id": n, **change} for n, change in enumerate(changes, 1)]
    return spark.createDataFrame([tuple(row[c] for c in RAW.names) for row in rows], RAW)
