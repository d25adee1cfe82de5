"""Reference SQL for DuckDB: the same results stated independently of the package."""

from __future__ import annotations

_RAW = """
SELECT
  CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE CAST(l_orderkey AS INT) END AS transaction_id,
  CAST(o_orderdate AS DATE) AS order_date,
  CAST(l_shipdate AS DATE) AS ship_date,
  CASE WHEN o_custkey % 53 = 0 THEN NULL ELSE concat('CUST', CAST(o_custkey AS VARCHAR(20))) END AS customer_id,
  CAST(CASE l_suppkey % 4 WHEN 0 THEN 14 + o_custkey % 88 WHEN 1 THEN o_custkey % 21 - 10 WHEN 2 THEN 120 + o_custkey % 81 ELSE NULL END AS INT) AS customer_age,
  CASE o_custkey % 7 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'Male' WHEN 3 THEN 'Female' WHEN 4 THEN ' m ' WHEN 5 THEN 'X' ELSE NULL END AS gender,
  concat('PROD', CAST(l_partkey AS VARCHAR(20))) AS product_id,
  CASE p_type WHEN 'STANDARD' THEN 'Electronics' WHEN 'PROMO' THEN 'Fashion' WHEN 'ECONOMY' THEN 'Grocery' WHEN 'SMALL' THEN 'Sports' WHEN 'LARGE' THEN 'Furniture' ELSE NULL END AS product_category,
  CAST(CASE l_linenumber WHEN 7 THEN 0 WHEN 6 THEN -l_quantity ELSE l_quantity END AS INT) AS quantity,
  CAST(CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 13 = 0 THEN -p_retailprice ELSE p_retailprice END AS DECIMAL(12,2)) AS unit_price,
  CAST(CASE WHEN l_suppkey % 17 = 0 THEN NULL WHEN l_tax > 0.075 THEN 100.01 + l_discount WHEN l_tax < 0.005 THEN -1.5 WHEN l_tax < 0.015 THEN 100 WHEN l_tax < 0.025 THEN 0 ELSE l_discount * 500 + 0.25 END AS DECIMAL(7,2)) AS discount_pct,
  n_name AS city, r_name AS state,
  CASE substr(o_orderpriority,1,1) WHEN '1' THEN 'Card' WHEN '2' THEN 'UPI' WHEN '3' THEN ' cod ' WHEN '4' THEN 'Crypto' ELSE NULL END AS payment_type,
  CASE WHEN l_partkey % 89 = 0 THEN 'Lost' WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'Cancelled' ELSE 'Returned' END AS order_status,
  DATE '2024-01-01' + l_linenumber % 3 AS ingestion_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
"""

_COLUMNS = (
    "transaction_id order_date ship_date customer_id customer_age gender product_id "
    "product_category quantity unit_price discount_pct city state payment_type order_status "
    "ingestion_date"
).split()

_OTHERS = [c for c in _COLUMNS if c not in ("transaction_id", "ingestion_date")]
_FIRST = (
    "row_number() OVER (PARTITION BY transaction_id ORDER BY ingestion_date DESC NULLS LAST, "
    + ", ".join(f"{c} ASC NULLS LAST" for c in _OTHERS)
    + ") = 1"
)

# the drop rules in order, and what a value rule leaves in its column
_KEEP = {
    "transaction_id_present": "transaction_id IS NOT NULL",
    "customer_id_present": "customer_id IS NOT NULL",
    "active_category": "coalesce(product_category IN ('Electronics','Fashion','Grocery','Sports'), FALSE)",
    "positive_quantity": "coalesce(quantity > 0, FALSE)",
}
_VALUE = {
    "ship_date": "CASE WHEN ship_date < order_date THEN NULL ELSE ship_date END",
    "order_status": "CASE WHEN order_status IN ('Delivered','Cancelled','Returned') THEN order_status END",
    "unit_price": "CASE WHEN unit_price <= 0 THEN NULL ELSE unit_price END",
    "discount_pct": "CASE WHEN discount_pct BETWEEN 0 AND 100 THEN discount_pct END",
    "customer_age": "CASE WHEN customer_age BETWEEN 15 AND 100 THEN customer_age END",
    "gender": "CASE upper(trim(gender)) WHEN 'MALE' THEN 'M' WHEN 'FEMALE' THEN 'F'"
    " WHEN 'M' THEN 'M' WHEN 'F' THEN 'F' END",
    "payment_type": "CASE WHEN upper(trim(payment_type)) IN ('CARD','UPI','COD')"
    " THEN upper(trim(payment_type)) END",
}
_ALL_KEPT = " AND ".join(_KEEP.values())


def _edge(column: str) -> str:
    return f"CAST({column} AS DOUBLE) AS {column}" if column in ("unit_price", "discount_pct") else column


_EDGE = ", ".join(_edge(c) for c in _COLUMNS)
_CLEANED = ", ".join(f"{_VALUE[c]} AS {c}" if c in _VALUE else c for c in _COLUMNS)
_AMOUNT = (
    "CAST(round(CAST(quantity AS DECIMAL(10,0)) * unit_price * (CAST(100 AS DECIMAL(5,2)) - discount_pct)"
    " * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2))"
)

_CTES = {
    "retail_raw": _RAW,
    "deduped": f"SELECT * FROM retail_raw QUALIFY {_FIRST}",
    "silver": f"SELECT {_CLEANED} FROM deduped WHERE {_ALL_KEPT}",
    "amounts": "SELECT transaction_id, order_date, product_id, product_category, quantity, city, state, "
    f"{_AMOUNT} AS total_amount FROM silver WHERE lower(order_status) = 'delivered'",
}


def _with(query: str) -> str:
    ctes = ", ".join(f"{name} AS ({body})" for name, body in _CTES.items())
    return f"WITH {ctes} {query}"


_SUM = "CAST(sum(total_amount) AS DOUBLE)"
_MEAN = (
    "CAST((2 * CAST(sum(total_amount) * 100 AS BIGINT) + count(total_amount))"
    " // (2 * nullif(count(total_amount), 0)) AS DOUBLE) / 100.0"
)
_UNITS = "CAST(sum(quantity) AS BIGINT)"
_MARTS = {
    "daily_sales_metrics": f"SELECT order_date, {_SUM} AS total_revenue, count(transaction_id) AS"
    f" total_orders, {_MEAN} AS avg_order_value FROM amounts GROUP BY order_date",
    "product_category_performance": f"SELECT product_category, {_SUM} AS category_revenue, {_UNITS} AS"
    f" total_units_sold, count(transaction_id) AS order_count, {_MEAN} AS avg_order_value"
    " FROM amounts GROUP BY product_category",
    "city_revenue_metrics": f"SELECT city, state, {_SUM} AS city_revenue, count(transaction_id) AS"
    f" order_count, {_MEAN} AS avg_order_value FROM amounts GROUP BY city, state",
    "monthly_sales_metrics": f"SELECT strftime(order_date, '%Y-%m') AS year_month, {_SUM} AS"
    " monthly_revenue, count(transaction_id) AS monthly_orders FROM amounts GROUP BY 1",
    "top_products": f"SELECT product_id, {_SUM} AS revenue, {_UNITS} AS units_sold FROM amounts"
    " GROUP BY product_id",
}
_AUDIT_COUNTS = {
    "daily_sales_rows": "daily_sales_metrics",
    "product_perf_rows": "product_category_performance",
    "city_revenue_rows": "city_revenue_metrics",
    "monthly_sales_rows": "monthly_sales_metrics",
    "top_products_rows": "top_products",
}
_AUDIT = (
    "SELECT 'retail_sales_clean' AS source_table, (SELECT count(*) FROM amounts) AS source_rows, "
    + ", ".join(f"(SELECT count(*) FROM ({_MARTS[m]})) AS {c}" for c, m in _AUDIT_COUNTS.items())
    + ", CASE WHEN (SELECT count(*) FROM amounts) > 0 THEN 'SUCCESS' ELSE 'EMPTY' END AS pipeline_status"
)


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


# rule name -> (kind, column, rows that violate it), in the order the rules run
_RULES = {
    "transaction_id_present": ("drop", "transaction_id", None),
    "customer_id_present": ("drop", "customer_id", None),
    "active_category": ("drop", "product_category", None),
    "ship_not_before_order": ("nullify", "ship_date", "ship_date < order_date"),
    "known_status": (
        "nullify",
        "order_status",
        "order_status NOT IN ('Delivered','Cancelled','Returned')",
    ),
    "positive_quantity": ("drop", "quantity", None),
    "positive_price": ("nullify", "unit_price", "unit_price <= 0"),
    "discount_range": ("nullify", "discount_pct", "discount_pct < 0 OR discount_pct > 100"),
    "price_exact": (
        "note",
        "unit_price",
        "CAST(CAST(unit_price AS DECIMAL(22,8)) AS DOUBLE) <> unit_price",
    ),
    "discount_exact": (
        "note",
        "discount_pct",
        "CAST(CAST(discount_pct AS DECIMAL(11,8)) AS DOUBLE) <> discount_pct",
    ),
    "age_range": ("nullify", "customer_age", "customer_age < 15 OR customer_age > 100"),
    "gender_code": (
        "normalise",
        "gender",
        f"gender IS DISTINCT FROM ({_VALUE['gender']})",
    ),
    "payment_code": (
        "normalise",
        "payment_type",
        f"payment_type IS DISTINCT FROM ({_VALUE['payment_type']})",
    ),
}


def _acts() -> dict[str, str]:
    left, acts = ["TRUE"], {}
    for name, (kind, _, bad) in _RULES.items():
        hit = f"NOT ({_KEEP[name]})" if kind == "drop" else f"({bad})"
        acts[name] = " AND ".join([*left, hit])
        if kind == "drop":
            left.append(f"({_KEEP[name]})")
    return acts


_ACTS = _acts()
_PREVIEWED = (
    "ship_not_before_order",
    "positive_quantity",
    "positive_price",
    "discount_range",
    "age_range",
    "payment_code",
)
_TOTAL_ORDER = "ingestion_date DESC NULLS LAST, transaction_id, " + ", ".join(
    f"{c} ASC NULLS LAST" for c in _OTHERS
)
_CLEAN_QUERIES = {
    "clean_ship_date": "ship_date",
    "clean_order_status": "order_status",
    "clean_unit_price": "unit_price",
    "clean_discount": "discount_pct",
    "clean_age": "customer_age",
    "clean_gender": "gender",
    "clean_payment": "payment_type",
}
_SILVER_TYPES = {
    "transaction_id": "int",
    "order_date": "date",
    "ship_date": "date",
    "customer_id": "string",
    "customer_age": "int",
    "gender": "string",
    "product_id": "string",
    "product_category": "string",
    "quantity": "int",
    "unit_price": "double",
    "discount_pct": "double",
    "city": "string",
    "state": "string",
    "payment_type": "string",
    "order_status": "string",
    "ingestion_date": "date",
    "silver_processed_at": "timestamp",
}


def _distribution(table: str, columns: tuple[str, ...]) -> str:
    return _union(
        [
            f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM {table} GROUP BY {c}"
            for c in columns
        ]
    )


def _mart_profile() -> str:
    orders = {
        "daily_sales_metrics": "total_orders",
        "product_category_performance": "order_count",
        "city_revenue_metrics": "order_count",
        "monthly_sales_metrics": "monthly_orders",
    }
    parts = []
    for name, sql in _MARTS.items():
        n_orders = f"CAST(sum({orders[name]}) AS BIGINT)" if name in orders else "CAST(NULL AS BIGINT)"
        parts.append(f"SELECT '{name}' AS mart, count(*) AS n_rows, {n_orders} AS n_orders FROM ({sql})")
    source = "(SELECT count(*) FROM amounts)"
    return (
        f"SELECT mart, n_rows, n_orders, {source} AS source_rows,"
        f" coalesce(n_orders = {source}, TRUE) AND n_rows > 0 AS ok FROM ({_union(parts)})"
    )


def _gold_rows() -> str:
    keys = {
        "daily_sales_metrics": ("CAST(order_date AS VARCHAR)", "total_revenue"),
        "product_category_performance": ("product_category", "category_revenue"),
        "city_revenue_metrics": ("concat(city, '/', state)", "city_revenue"),
        "monthly_sales_metrics": ("year_month", "monthly_revenue"),
        "top_products": ("product_id", "revenue"),
    }
    return _union(
        [
            f"SELECT '{m}' AS mart, {k} AS key, {r} AS revenue FROM ({_MARTS[m]})"
            for m, (k, r) in keys.items()
        ]
    )


def _ledger() -> str:
    dropped = {n: f"(SELECT count(*) FROM deduped WHERE {_ACTS[n]})" for n in _KEEP}
    entries = {
        "bronze": "(SELECT count(*) FROM retail_raw)",
        "duplicates": "(SELECT count(*) FROM deduped) - (SELECT count(*) FROM retail_raw)",
        **{f"drop:{n}": f"-{sql}" for n, sql in dropped.items()},
        "silver": "-(SELECT count(*) FROM silver)",
    }
    rows = _union([f"SELECT '{k}' AS entry, CAST({v} AS BIGINT) AS n_rows" for k, v in entries.items()])
    return (
        f"SELECT entry, n_rows FROM ({rows}) UNION ALL"
        f" SELECT 'difference', CAST(sum(n_rows) AS BIGINT) FROM ({rows})"
    )


def _job_facts() -> str:
    counts = {
        "read": "(SELECT count(*) FROM retail_raw)",
        "deduplicated": "(SELECT count(*) FROM deduped)",
        "repeated_keys": "(SELECT count(*) FROM (SELECT 1 FROM retail_raw GROUP BY transaction_id HAVING count(*) > 1))",
    }
    violating = "SELECT '{n}' AS rule FROM deduped WHERE {a} AND {c} IS NOT NULL"
    violations = _union([violating.format(n=n, a=_ACTS[n], c=_RULES[n][1]) for n in _PREVIEWED])
    return _union(
        [
            *[f"SELECT 'rows' AS fact, '{k}' AS subject, {v} AS n" for k, v in counts.items()],
            "SELECT 'gender_met', gender, count(*) FROM deduped GROUP BY gender",
            *[f"SELECT 'rule', '{n}', count(*) FROM deduped WHERE {_ACTS[n]}" for n in _RULES],
            f"SELECT 'violation', rule, least(5, count(*)) FROM ({violations}) GROUP BY rule",
            f"SELECT 'repeated_key', NULL, least(5, {counts['repeated_keys']})",
        ]
    )


def _unreadable() -> str:
    unread = {
        "quantity": "quantity % 10 = 3",
        "ship_date": "state = 'ASIA' AND ship_date IS NOT NULL",
        "unit_price": "quantity = 17 AND unit_price IS NOT NULL",
        "ingestion_date": "quantity = 20",
    }
    return _union(
        [
            f"SELECT '{c}' AS \"column\", count(*) AS n_values FROM retail_raw WHERE {unread.get(c, 'FALSE')}"
            for c in [*_COLUMNS, "(fields)"]
        ]
    )


def _counts(tables: dict[str, str]) -> str:
    return _union([f"SELECT '{k}' AS layer, count(*) AS n_rows FROM {v}" for k, v in tables.items()])


def oracle_queries() -> dict[str, str]:
    queries = {
        "bronze_csv_roundtrip": f"SELECT {_EDGE} FROM retail_raw",
        "bronze_roundtrip": f"SELECT {_EDGE} FROM retail_raw",
        "bronze_ingest_metadata": "SELECT count(*) AS n_rows, count(*) AS from_csv,"
        " TRUE AS files_told_apart, count(*) AS stamped, CAST(1 AS BIGINT) AS run_times FROM retail_raw",
        "partition_profile": "SELECT count(*) AS n_rows, TRUE AS all_filled FROM retail_raw",
        "deduped_gender": _distribution("deduped", ("gender",)),
        "ingestion_dates": "SELECT DISTINCT ingestion_date FROM retail_raw",
        "null_profile": _union(
            [
                f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM retail_raw"
                for c in _COLUMNS
            ]
        ),
        "silver_null_profile": _union(
            [
                f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM silver"
                for c in ("payment_type", "gender", "unit_price")
            ]
        ),
        "value_distribution": _distribution(
            "retail_raw", ("order_status", "product_category", "gender", "payment_type")
        ),
        "silver_value_distribution": _distribution(
            "silver", ("product_category", "payment_type", "gender")
        ),
        "duplicate_keys": "SELECT transaction_id, count(*) AS n FROM retail_raw"
        " GROUP BY transaction_id HAVING count(*) > 1",
        "dedupe_transactions": f"SELECT {_EDGE} FROM deduped",
        "silver_not_null": "SELECT transaction_id, customer_id FROM deduped"
        " WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL",
        "silver_category": "SELECT transaction_id, product_category FROM deduped"
        f" WHERE {_KEEP['active_category']}",
        "silver_quantity": f"SELECT transaction_id, quantity FROM deduped WHERE {_KEEP['positive_quantity']}",
        "silver_roundtrip": f"SELECT {_EDGE} FROM silver",
        "silver_rules_first": f"SELECT {_EDGE} FROM (SELECT {_CLEANED} FROM (SELECT * FROM retail_raw"
        f" WHERE {_ALL_KEPT} QUALIFY {_FIRST}))",
        "silver_processed_at": "SELECT count(*) AS n_rows, count(*) AS stamped,"
        " CAST(1 AS BIGINT) AS run_times FROM silver",
        "rule_report": _union(
            [
                f"SELECT '{n}' AS rule, '{kind}' AS kind, '{c}' AS \"column\", count(*) AS n_rows"
                f" FROM deduped WHERE {_ACTS[n]}"
                for n, (kind, c, _) in _RULES.items()
            ]
        ),
        "violation_preview": _union(
            [
                f"SELECT '{n}' AS rule, * FROM (SELECT {_EDGE} FROM deduped WHERE {_ACTS[n]}"
                f" AND {_RULES[n][1]} IS NOT NULL ORDER BY {_TOTAL_ORDER} LIMIT 5)"
                for n in _PREVIEWED
            ]
        ),
        "silver_invariants": _union(
            [
                f"SELECT '{n}' AS invariant, count(*) AS violations FROM silver WHERE {_ACTS[n]}"
                for n in _RULES
            ]
            + [
                "SELECT 'transaction_id_unique', count(*) - count(DISTINCT transaction_id) FROM silver",
            ]
        ),
        "schema_check": _union(
            [
                f"SELECT '{c}' AS \"column\", '{t}' AS expected, '{t}' AS actual,"
                f" count({'*' if c == 'silver_processed_at' else c}) AS n_values, TRUE AS ok FROM silver"
                for c, t in _SILVER_TYPES.items()
            ]
        ),
        "count_reconciliation": _ledger(),
        "order_amounts": "SELECT transaction_id, order_date, product_id, product_category, quantity,"
        " city, state, CAST(total_amount AS DOUBLE) AS total_amount FROM amounts",
        **_MARTS,
        "top_products_k": f"SELECT * FROM ({_MARTS['top_products']})"
        " ORDER BY revenue DESC NULLS LAST, product_id LIMIT 10",
        "mart_totals": "SELECT order_date, product_category, city, state, product_id,"
        f" CAST(grouping_id(order_date, product_category, city, state, product_id) AS BIGINT) AS key_set,"
        f" {_SUM} AS amount, count(total_amount) AS priced, count(transaction_id) AS orders,"
        f" {_UNITS} AS units FROM amounts GROUP BY GROUPING SETS"
        " ((order_date), (product_category), (city, state), (product_id))",
        "gold_roundtrip": _gold_rows(),
        "bronze_unreadable": _unreadable(),
        "bronze_replaced_dates": "SELECT ingestion_date, count(*) AS n_rows FROM retail_raw"
        " WHERE ingestion_date <> DATE '2024-01-02' GROUP BY ingestion_date UNION ALL"
        " SELECT ingestion_date, count(*) FROM deduped WHERE ingestion_date = DATE '2024-01-02'"
        " GROUP BY ingestion_date",
        "silver_origin": "SELECT transaction_id, 'day=' || strftime(ingestion_date, '%d') AS folder FROM silver",
        "silver_job_facts": _job_facts(),
        "top_products_readback": f"SELECT * FROM ({_MARTS['top_products']})"
        " ORDER BY revenue DESC NULLS LAST, product_id LIMIT 25",
        "gold_profile": _mart_profile(),
        "audit_metadata": _AUDIT,
        "retail_end_to_end": _AUDIT,
        "layer_row_counts": _counts(
            {"bronze": "retail_raw", "silver": "silver"}
            | {name: f"({sql})" for name, sql in _MARTS.items()}
        ),
    }
    for key, column in _CLEAN_QUERIES.items():
        queries[key] = (
            f"SELECT transaction_id, {_edge(column)} FROM"
            f" (SELECT transaction_id, {_VALUE[column]} AS {column} FROM deduped)"
        )
    return {key: _with(sql) for key, sql in queries.items()}
