import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import functions as F

from shelfmark.functions import line_amount, mean_money
from shelfmark.operators.checks import silver_invariants
from shelfmark.operators.marts import category_performance, mart_totals, marts_from_totals, order_amounts
from shelfmark.operators.rules import rule_report
from tests.rows import raw_frame

CENT = Decimal("0.01")


def _amounts(spark, rows):
    df = spark.createDataFrame(rows, "q int, p decimal(22,8), d decimal(11,8)")
    return [
        row[0] for row in df.select(line_amount(F.col("q"), F.col("p"), F.col("d"))).collect()
    ]


def test_amount_matches_exact_arithmetic(spark):
    draw = random.Random(7)
    rows = [
        (
            draw.choice([1, 2, 3, 7, 10, 999, 2**31 - 1]),
            Decimal(draw.randrange(1, 10**draw.randint(3, 22))).scaleb(-8),
            Decimal(draw.choice([0, 50 * 10**8, 10**10, draw.randrange(0, 10**10 + 1)])).scaleb(-8),
        )
        for _ in range(2000)
    ]
    exact = [(q * p * (100 - d) / 100).quantize(CENT, ROUND_HALF_UP) for q, p, d in rows]
    assert _amounts(spark, rows) == exact


def test_amount_edges(spark):
    price = Decimal("1.0050")
    rows = [
        (1, price, Decimal(0)),  # 1.005 rounds up, which binary floating point misses
        (3, price, Decimal(100)),
        (None, price, Decimal(0)),
        (1, None, Decimal(0)),
        (1, price, None),
    ]
    assert _amounts(spark, rows) == [Decimal("1.01"), Decimal("0.00"), None, None, None]


def test_mean_is_exact_for_large_groups(spark):
    # 0.50 cents short of a cent by less than a millionth: a six-digit quotient rounds it up
    cases = [
        (Decimal("4999999.99"), 10**9),
        (Decimal("0.05"), 10),
        (Decimal("0.04"), 10),
        (Decimal("1.8e21"), 1),
        (Decimal("1.8e21"), 7),
        (Decimal("99999999999999999999999999999999.99"), 3 * 10**9),
        (Decimal(5), 0),
    ]
    df = spark.createDataFrame(cases, "s decimal(38,2), n bigint")
    means = [row[0] for row in df.select(mean_money(F.col("s"), F.col("n"))).collect()]
    with localcontext(prec=60):
        exact = [float((s / n).quantize(CENT, ROUND_HALF_UP)) if n else None for s, n in cases]
    assert means == exact and means[:4] == [0.0, 0.01, 0.0, 1.8e21]


def test_amounts_of_doubles(spark):
    prices = [1e12, 1e13, 0.00004, 12.34567, 1e14, float("nan"), 100.0]
    rows = [{"unit_price": p, "discount_pct": 0.0, "quantity": 100} for p in prices]
    rows[-1]["discount_pct"] = 33.333333
    found = order_amounts(raw_frame(spark, *rows)).orderBy("transaction_id").collect()
    assert [r.total_amount for r in found] == [
        Decimal("1e14"), Decimal("1e15"), 0, Decimal("1234.57"), Decimal("1e16"), None, Decimal("6666.67"),
    ]
    assert all(r.huge_amount is None for r in found)


def test_large_prices_are_exact(spark):
    draw = random.Random(11)
    edges = [1e14, 1e14 + 0.25, 99999999999999.98, 1e15, 2.0**53, 1e18 - 128, 123456789012345.67]
    prices = edges + [draw.uniform(1, 10) * 10 ** draw.randint(12, 17) for _ in range(400)]
    rows = [(draw.choice([1, 7, 2**31 - 1]), p, draw.choice([0.0, 33.333333, 99.99999999, 100.0])) for p in prices]
    df = spark.createDataFrame(rows, "q int, p double, d double")
    # the digits by which Spark writes a double, which are not always the fewest
    shown = F.col("p").cast("decimal(38,10)")
    found = df.select("q", shown, "d", line_amount(F.col("q"), F.col("p"), F.col("d"))).collect()
    assert all(float(p) == price for (_, p, _, _), (_, price, _) in zip(found, rows, strict=True))
    with localcontext(prec=80):
        for q, p, d, amount in found:
            assert amount == (q * p * (100 - Decimal(repr(d))) / 100).quantize(CENT, ROUND_HALF_UP), (q, p, d)


def test_no_finite_price_leaves_revenue(spark):
    prices = [1e14, 1e15, 9e17, 1e18, 1e30, 1e300, 10.0]
    rows = [{"unit_price": p, "discount_pct": 0.0, "quantity": 2, "product_id": f"P{n}"} for n, p in enumerate(prices)]
    none = [{"unit_price": p, "product_id": f"none{n}"} for n, p in enumerate([float("inf"), float("nan"), None])]
    silver = raw_frame(spark, *rows, *none)
    amounts = order_amounts(silver)
    marts = marts_from_totals(mart_totals(amounts))
    top = {r.product_id: r.revenue for r in marts["top_products"].collect()}
    assert top == {f"P{n}": 2 * p for n, p in enumerate(prices)} | {f"none{n}": None for n in range(3)}
    total = sum(2 * Decimal(repr(p)) for p in prices)
    for name, revenue in {"daily_sales_metrics": "total_revenue", "city_revenue_metrics": "city_revenue", "product_category_performance": "category_revenue"}.items():
        (row,) = marts[name].collect()
        assert row[revenue] == float(total) and row.avg_order_value == float(total) / len(prices)
    assert marts["monthly_sales_metrics"].first().monthly_revenue == float(total)
    assert silver_invariants(silver.filter("unit_price > 0 AND unit_price < 1e18")).filter("violations > 0").count() == 0
    noted = {r.rule: r.n_rows for r in rule_report(silver).collect()}
    assert noted["price_exact"] == 5


def test_group_without_amounts_has_rows_but_no_revenue(spark):
    silver = raw_frame(spark, {"unit_price": None}, {"discount_pct": None, "quantity": 5})
    (row,) = category_performance(order_amounts(silver)).collect()
    assert (row.category_revenue, row.avg_order_value) == (None, None)
    assert (row.order_count, row.total_units_sold) == (2, 7)


def test_mean_divides_by_priced_lines_only(spark):
    silver = raw_frame(spark, {"discount_pct": 0.0}, {"unit_price": None})
    (row,) = category_performance(order_amounts(silver)).collect()
    assert (row.category_revenue, row.order_count, row.avg_order_value) == (20.0, 2, 20.0)
