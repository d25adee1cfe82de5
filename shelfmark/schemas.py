"""Declared schemas of every table that is read or written."""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, TEXT = T.IntegerType(), T.LongType(), T.StringType()
DOUBLE, DATE, TIMESTAMP = T.DoubleType(), T.DateType(), T.TimestampType()
TEXTS = T.ArrayType(T.StringType())

# What a line amount is computed from: silver itself keeps prices and discounts as they came.
# A value that does not fit exactly is counted by a rule of its own.
PRICE = T.DecimalType(22, 8)
# doubles from 1e14 on have 3 decimals at most; from HUGE_PRICE on amounts are doubles
LARGE_PRICE = T.DecimalType(21, 3)
HUGE_PRICE = 1e18
PERCENT = T.DecimalType(11, 8)


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# Column names and types of the exchanged tables.
RAW = table(
    transaction_id=INT,
    order_date=DATE,
    ship_date=DATE,
    customer_id=TEXT,
    customer_age=INT,
    gender=TEXT,
    product_id=TEXT,
    product_category=TEXT,
    quantity=INT,
    unit_price=DOUBLE,
    discount_pct=DOUBLE,
    city=TEXT,
    state=TEXT,
    payment_type=TEXT,
    order_status=TEXT,
    ingestion_date=DATE,
)
BRONZE = RAW
# where a row came from, and what of it could not be read
ORIGIN = table(source_file=TEXT, ingested_at=TIMESTAMP)
LEDGER = table(unreadable=TEXTS, raw_record=TEXT)
BRONZE_WITH_ORIGIN = T.StructType([*RAW, *ORIGIN])
# all that bronze files hold
BRONZE_FILES = T.StructType([*RAW, *ORIGIN, *LEDGER])
SILVER = table(
    **{f.name: f.dataType for f in RAW},
    silver_processed_at=TIMESTAMP,
)
SILVER_WITH_ORIGIN = T.StructType([*SILVER, *ORIGIN])
# what the silver job met: counts, and previews as JSON
FACTS = table(fact=TEXT, subject=TEXT, n=LONG, record=TEXT)
# first and last row of each file of a sorted mart, by their place in the order
RANGES = table(file=TEXT, first_rank=LONG, n_rows=LONG, highest=DOUBLE, lowest=DOUBLE)
# publications of a layer
LOG = table(number=LONG, generation=TEXT, folders=TEXTS, published_at=TIMESTAMP)
MARTS = {
    "daily_sales_metrics": table(
        order_date=DATE, total_revenue=DOUBLE, total_orders=LONG, avg_order_value=DOUBLE
    ),
    "product_category_performance": table(
        product_category=TEXT,
        category_revenue=DOUBLE,
        total_units_sold=LONG,
        order_count=LONG,
        avg_order_value=DOUBLE,
    ),
    "city_revenue_metrics": table(
        city=TEXT, state=TEXT, city_revenue=DOUBLE, order_count=LONG, avg_order_value=DOUBLE
    ),
    "monthly_sales_metrics": table(year_month=TEXT, monthly_revenue=DOUBLE, monthly_orders=LONG),
    "top_products": table(product_id=TEXT, revenue=DOUBLE, units_sold=LONG),
}
# The audit row.
AUDIT = table(
    source_table=TEXT,
    source_rows=LONG,
    daily_sales_rows=LONG,
    product_perf_rows=LONG,
    city_revenue_rows=LONG,
    monthly_sales_rows=LONG,
    top_products_rows=LONG,
    pipeline_status=TEXT,
    processed_time=TEXT,
)
