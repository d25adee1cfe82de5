"""Delivered lines and the five sales marts.

All marts are views of the same totals (sum of amounts, priced lines, orders, units) by different
keys. One mart alone is a plain group-by; all five together come from one scan (``mart_totals``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import as_money, huge_amount, line_amount, mean_money

AMOUNT_COLUMNS = (
    "transaction_id",
    "order_date",
    "product_id",
    "product_category",
    "quantity",
    "city",
    "state",
)


def order_amounts(silver: DataFrame) -> DataFrame:
    """Delivered lines with ``total_amount``, only the columns the marts read.

    A line whose price is beyond exact cents has a ``huge_amount`` instead. On the silver layer the
    status filter prunes folders.
    """
    delivered = silver.filter(F.lower("order_status") == "delivered")
    line = (F.col("quantity"), F.col("unit_price"), F.col("discount_pct"))
    return delivered.select(
        *AMOUNT_COLUMNS, line_amount(*line).alias("total_amount"), huge_amount(*line).alias("huge_amount")
    )


def _sums() -> list[Column]:
    return [
        F.sum("total_amount").alias("amount"),
        F.sum("huge_amount").alias("huge"),
        (F.count("total_amount") + F.count("huge_amount")).alias("priced"),
        F.count("transaction_id").alias("orders"),
        F.sum("quantity").alias("units"),
    ]


def _money() -> Column:
    return as_money(F.col("amount"), F.col("huge"))


def _mean() -> Column:
    return mean_money(F.col("amount"), F.col("priced"), F.col("huge"))


def _daily(totals: DataFrame) -> DataFrame:
    return totals.select(
        "order_date",
        _money().alias("total_revenue"),
        F.col("orders").alias("total_orders"),
        _mean().alias("avg_order_value"),
    )


def _category(totals: DataFrame) -> DataFrame:
    return totals.select(
        "product_category",
        _money().alias("category_revenue"),
        F.col("units").alias("total_units_sold"),
        F.col("orders").alias("order_count"),
        _mean().alias("avg_order_value"),
    )


def _city(totals: DataFrame) -> DataFrame:
    return totals.select(
        "city",
        "state",
        _money().alias("city_revenue"),
        F.col("orders").alias("order_count"),
        _mean().alias("avg_order_value"),
    )


def _monthly(daily_totals: DataFrame) -> DataFrame:
    """Months from days: exact sums add up, and month text is formatted once per month, not per line."""
    months = daily_totals.groupBy(F.trunc("order_date", "MM").alias("month")).agg(
        F.sum("amount").alias("amount"), F.sum("huge").alias("huge"), F.sum("orders").alias("orders")
    )
    return months.select(
        F.date_format("month", "yyyy-MM").alias("year_month"),
        _money().alias("monthly_revenue"),
        F.col("orders").alias("monthly_orders"),
    )


def best_first(products: DataFrame) -> DataFrame:
    return products.orderBy(F.col("revenue").desc_nulls_last(), F.col("product_id").asc_nulls_last())


def _products(totals: DataFrame, k: int | None) -> DataFrame:
    ranked = best_first(
        totals.select("product_id", _money().alias("revenue"), F.col("units").alias("units_sold"))
    )
    return ranked if k is None else ranked.limit(k)


def daily_sales(amounts: DataFrame) -> DataFrame:
    return _daily(amounts.groupBy("order_date").agg(*_sums()))


def category_performance(amounts: DataFrame) -> DataFrame:
    return _category(amounts.groupBy("product_category").agg(*_sums()))


def city_revenue(amounts: DataFrame) -> DataFrame:
    return _city(amounts.groupBy("city", "state").agg(*_sums()))


def monthly_sales(amounts: DataFrame) -> DataFrame:
    return _monthly(
        amounts.groupBy(F.trunc("order_date", "MM").alias("order_date")).agg(*_sums())
    )


def top_products(amounts: DataFrame, k: int | None = None) -> DataFrame:
    """All products by revenue, or the ``k`` best, which needs no full sort."""
    return _products(amounts.groupBy("product_id").agg(*_sums()), k)


# grouping_id of each key set: a bit is 0 where the key is grouped by, order_date first
_KEYS = ("order_date", "product_category", "city", "state", "product_id")
_BY_DATE, _BY_CATEGORY, _BY_CITY, _BY_PRODUCT = 0b01111, 0b10111, 0b11001, 0b11110


def mart_totals(amounts: DataFrame) -> DataFrame:
    """The totals behind all marts from one scan and one shuffle.

    Each line updates one partial total per key set inside its task, so the shuffle carries at most
    one row per task and key, and a hot product, day or city is summed before it moves.
    """
    key_sets = [["order_date"], ["product_category"], ["city", "state"], ["product_id"]]
    return amounts.groupingSets(key_sets, *_KEYS).agg(
        F.grouping_id(*_KEYS).alias("key_set"), *_sums()
    )


def marts_from_totals(totals: DataFrame) -> dict[str, DataFrame]:
    """The five marts by name; persist ``totals`` first to share it between them."""

    def of(key_set: int) -> DataFrame:
        return totals.filter(F.col("key_set") == key_set)

    return {
        "daily_sales_metrics": _daily(of(_BY_DATE)),
        "product_category_performance": _category(of(_BY_CATEGORY)),
        "city_revenue_metrics": _city(of(_BY_CITY)),
        "monthly_sales_metrics": _monthly(of(_BY_DATE)),
        "top_products": _products(of(_BY_PRODUCT), None),
    }
