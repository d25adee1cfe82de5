"""The 16-column retail input, mapped from the star-schema test tables (FIXTURES.md section 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.schemas import RAW


def retail_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw retail rows under the declared raw schema, one per ``lineitem`` row.

    The joins carry no hints: Spark broadcasts a side whose size is below its threshold and splits
    skewed sort-merge partitions otherwise. Orders are widened before they meet ``lineitem``, so the
    large table is shuffled for orders and for parts only.
    """

    def table(name: str) -> DataFrame:
        return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")

    nation, region, customer = table("nation"), table("region"), table("customer")
    order, part, lines = table("orders"), table("part"), table("lineitem")
    # a date per order, not per line
    order = order.withColumn("o_orderdate", order.o_orderdate.cast("date"))
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customers = customer.join(places, customer.c_nationkey == places.n_nationkey)
    orders = order.join(customers, order.o_custkey == customers.c_custkey)
    joined = lines.join(part, lines.l_partkey == part.p_partkey).join(
        orders, lines.l_orderkey == orders.o_orderkey
    )
    types = {f.name: f.dataType.simpleString() for f in RAW}
    return joined.selectExpr(
        *[f"CAST({expr} AS {types[name]}) AS {name}" for name, expr in _MAPPING.items()]
    )


def unreadable_text(raw: DataFrame) -> DataFrame:
    """The raw rows as text in which some values cannot be read under the declared schema."""
    return raw.selectExpr(
        *[f"{_UNREADABLE.get(name, f'CAST({name} AS STRING)')} AS {name}" for name in RAW.names]
    )


# Which values are written so that they cannot be read.
_UNREADABLE = {
    "quantity": "CASE WHEN quantity % 10 = 3 THEN concat(quantity, ',5') ELSE CAST(quantity AS STRING) END",
    "ship_date": "CASE WHEN state = 'ASIA' THEN date_format(ship_date, 'dd/MM/yyyy') ELSE CAST(ship_date AS STRING) END",
    "unit_price": "CASE WHEN quantity = 17 THEN concat('$', unit_price) ELSE CAST(unit_price AS STRING) END",
    "ingestion_date": "CASE WHEN quantity = 20 THEN 'soon' ELSE CAST(ingestion_date AS STRING) END",
}

# The columns read from each test table (FIXTURES.md section 2).
_COLUMNS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "part": "p_partkey BIGINT, p_type STRING, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_shipdate TIMESTAMP_NTZ",
}

# The mapping agreed for the test tables.
_MAPPING = {
    "transaction_id": "CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_orderkey END",
    "order_date": "o_orderdate",
    "ship_date": "l_shipdate",
    "customer_id": "CASE WHEN o_custkey % 53 = 0 THEN NULL ELSE concat('CUST', o_custkey) END",
    "customer_age": "CASE l_suppkey % 4 WHEN 0 THEN 14 + o_custkey % 88"
    " WHEN 1 THEN o_custkey % 21 - 10 WHEN 2 THEN 120 + o_custkey % 81 END",
    "gender": "CASE o_custkey % 7 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'Male'"
    " WHEN 3 THEN 'Female' WHEN 4 THEN ' m ' WHEN 5 THEN 'X' END",
    "product_id": "concat('PROD', l_partkey)",
    "product_category": "CASE p_type WHEN 'STANDARD' THEN 'Electronics' WHEN 'PROMO' THEN 'Fashion'"
    " WHEN 'ECONOMY' THEN 'Grocery' WHEN 'SMALL' THEN 'Sports' WHEN 'LARGE' THEN 'Furniture' END",
    "quantity": "CASE l_linenumber WHEN 7 THEN 0 WHEN 6 THEN -l_quantity ELSE l_quantity END",
    "unit_price": "CAST(CASE WHEN l_suppkey % 11 = 0 THEN NULL"
    " WHEN l_suppkey % 13 = 0 THEN -p_retailprice ELSE p_retailprice END AS DECIMAL(12,2))",
    "discount_pct": "CAST(CASE WHEN l_suppkey % 17 = 0 THEN NULL"
    " WHEN l_tax > 0.075D THEN 100.01D + l_discount WHEN l_tax < 0.005D THEN -1.5D"
    " WHEN l_tax < 0.015D THEN 100D WHEN l_tax < 0.025D THEN 0D"
    " ELSE l_discount * 500 + 0.25D END AS DECIMAL(7,2))",
    "city": "n_name",
    "state": "r_name",
    "payment_type": "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Card' WHEN '2' THEN 'UPI'"
    " WHEN '3' THEN ' cod ' WHEN '4' THEN 'Crypto' END",
    "order_status": "CASE WHEN l_partkey % 89 = 0 THEN 'Lost' WHEN o_orderstatus = 'F' THEN 'Delivered'"
    " WHEN o_orderstatus = 'O' THEN 'Cancelled' ELSE 'Returned' END",
    "ingestion_date": "DATE '2024-01-01' + l_linenumber % 3",
}
