from datetime import date

import pytest

from shelfmark.operators.clean import clean
from shelfmark.operators.rules import (
    SILVER_RULES,
    Rule,
    accepted,
    apply_rules,
    change_values,
    judge,
    rule_report,
    rules_named,
    settle,
    tally,
    violation_preview,
    violation_previews,
)
from tests.rows import raw_frame

DAY = date(2024, 5, 10)
BEFORE = date(2024, 5, 9)


@pytest.mark.parametrize(
    ("column", "raw", "expected"),
    [
        ("ship_date", DAY, DAY),
        ("ship_date", BEFORE, None),
        ("ship_date", None, None),
        ("unit_price", 0.0, None),
        ("unit_price", -1.0, None),
        ("unit_price", None, None),
        ("unit_price", 1.005, 1.005),
        ("unit_price", 0.00001, 0.00001),
        ("unit_price", 12.34567, 12.34567),
        ("unit_price", float("inf"), float("inf")),
        ("unit_price", 1e15, 1e15),
        ("discount_pct", 0.0, 0.0),
        ("discount_pct", 33.333333, 33.333333),
        ("discount_pct", 100.0, 100.0),
        ("discount_pct", -0.001, None),
        ("discount_pct", 100.004, None),
        ("discount_pct", 100.00001, None),
        ("discount_pct", None, None),
        ("discount_pct", float("nan"), None),
        ("customer_age", 14, None),
        ("customer_age", 15, 15),
        ("customer_age", 100, 100),
        ("customer_age", 101, None),
        ("customer_age", None, None),
        ("gender", " male ", "M"),
        ("gender", "FEMALE", "F"),
        ("gender", "f", "F"),
        ("gender", "X", None),
        ("gender", "\tM", None),
        ("gender", None, None),
        ("payment_type", " cod ", "COD"),
        ("payment_type", "Card", "CARD"),
        ("payment_type", "Crypto", None),
        ("payment_type", None, None),
        ("order_status", "Returned", "Returned"),
        ("order_status", "delivered", None),
        ("order_status", " Delivered", None),
        ("order_status", "Lost", None),
        ("order_status", None, None),
    ],
)
def test_value_rules_keep_the_row(spark, column, raw, expected):
    rows = clean(raw_frame(spark, {column: raw})).collect()
    assert [row[column] for row in rows] == [expected]


def test_ship_date_stays_without_an_order_date(spark):
    (row,) = clean(raw_frame(spark, {"order_date": None, "ship_date": BEFORE})).collect()
    assert row.ship_date == BEFORE


@pytest.mark.parametrize(
    ("column", "raw"),
    [
        ("transaction_id", None),
        ("customer_id", None),
        ("product_category", "Furniture"),
        ("product_category", "grocery"),
        ("product_category", None),
        ("quantity", 0),
        ("quantity", -1),
        ("quantity", None),
    ],
)
def test_drop_rules_remove_the_row(spark, column, raw):
    assert clean(raw_frame(spark, {column: raw})).count() == 0


def test_null_keys_all_go(spark):
    rows = raw_frame(spark, {"transaction_id": None}, {"transaction_id": None}, {})
    assert [row.transaction_id for row in clean(rows).collect()] == [3]


def test_bad_survivor_displaces_good_row_unless_rules_run_first(spark):
    newer = {"transaction_id": 7, "ingestion_date": date(2024, 6, 2), "quantity": 0}
    rows = raw_frame(spark, {"transaction_id": 7}, newer)
    assert clean(rows).count() == 0
    assert [row.quantity for row in clean(rows, dedupe_after_rules=True).collect()] == [2]


def _dirty(spark):
    return raw_frame(
        spark,
        {},
        {"transaction_id": None},
        {"customer_id": None, "quantity": 0},
        {"product_category": "Furniture", "ship_date": BEFORE},
        {"ship_date": BEFORE, "quantity": 0, "unit_price": -1.0},
        {"ship_date": BEFORE, "unit_price": -1.0, "payment_type": "Card"},
        {"gender": None, "payment_type": None, "customer_age": 101},
    )


def test_report_books_each_row_to_the_first_drop_rule(spark):
    counts = {row.rule: row.n_rows for row in rule_report(_dirty(spark)).collect()}
    assert counts == {
        "transaction_id_present": 1,
        "customer_id_present": 1,
        "active_category": 1,
        "ship_not_before_order": 2,
        "known_status": 0,
        "positive_quantity": 1,
        "positive_price": 1,
        "price_exact": 0,
        "discount_range": 0,
        "discount_exact": 0,
        "age_range": 1,
        "gender_code": 0,
        "payment_code": 1,
    }


@pytest.mark.parametrize(
    ("column", "raw", "rule"),
    [
        ("unit_price", 1e12, None),
        ("unit_price", 1e13, None),
        ("unit_price", 0.00004, None),
        ("unit_price", 12.34567, None),
        ("discount_pct", 33.333333, None),
        ("unit_price", 1e14, None),
        ("unit_price", 1e18, "price_exact"),
        ("unit_price", 1 / 3, "price_exact"),
        ("unit_price", float("nan"), "price_exact"),
        ("discount_pct", 100 / 3, "discount_exact"),
    ],
)
def test_what_amounts_cannot_hold_is_counted(spark, column, raw, rule):
    rows = raw_frame(spark, {column: raw})
    assert [r.rule for r in rule_report(rows).filter("n_rows > 0").collect()] == [rule] * bool(rule)
    kept = clean(rows).first()[column]
    assert kept == raw or raw != raw


def test_a_hundred_rules(spark):
    rules = [Rule(f"it's `{n}`", "note", "quantity", f"quantity > {n}") for n in range(100)]
    report = rule_report(raw_frame(spark, {"quantity": 70}, {"quantity": 90}), rules).collect()
    assert [r.n_rows for r in report] == [2] * 70 + [1] * 20 + [0] * 10
    assert [r.rule for r in report] == [rule.name for rule in rules]


def test_columns_may_need_quotes(spark):
    odd = raw_frame(spark, {}, {"gender": "X"}).withColumnRenamed("gender", "the `odd` one")
    rules = [
        Rule("odd", "normalise", "the `odd` one", "CASE WHEN `the ``odd`` one` = 'M' THEN 'M' END"),
        Rule("day", "nullify", "ship_date", "ship_date IS NOT NULL"),
    ]
    settled = settle(judge(odd, rules), rules)
    assert [r.n_rows for r in tally(settled, rules).collect()] == [1, 2]
    assert sorted(map(str, (r[5] for r in accepted(settled).collect()))) == ["M", "None"]


def test_settled_rows_are_the_applied_rules(spark):
    dirty = _dirty(spark)
    settled = settle(judge(dirty))
    assert sorted(accepted(settled).collect(), key=str) == sorted(
        apply_rules(dirty).collect(), key=str
    )
    assert tally(settled).collect() == rule_report(dirty).collect()
    blank = settled.filter("rejected_by IS NOT NULL").drop("fired", "rejected_by").collect()
    assert len(blank) == 4 and all(value is None for row in blank for value in row)


def test_previews_show_values_not_nulls(spark):
    dirty = raw_frame(spark, *[{"quantity": q} for q in (0, None, -3, 4, 0)])
    (rule,) = rules_named("positive_quantity")
    shown = violation_preview(dirty, rule, n=2)
    assert shown.count() == 2
    assert all(row.quantity <= 0 for row in shown.collect())
    assert [r.quantity for r in violation_preview(dirty, rule, 5, ["quantity"]).collect()] == [
        -3,
        0,
        0,
    ]


def test_previews_respect_earlier_drops(spark):
    previews = violation_previews(_dirty(spark), ["transaction_id"])
    shown = {}
    for row in previews.collect():
        shown.setdefault(row.rule, []).append(row.transaction_id)
    assert shown == {
        "active_category": [4],
        "ship_not_before_order": [5, 6],
        "positive_quantity": [5],
        "positive_price": [6],
        "age_range": [7],
        "payment_code": [6],
    }
    some = violation_previews(_dirty(spark), ["transaction_id"], n=1, shown=["ship_not_before_order"])
    assert [(r.rule, r.transaction_id) for r in some.collect()] == [("ship_not_before_order", 5)]


def test_two_value_rules_on_a_column_are_refused(spark):
    again = Rule("again", "nullify", "gender", "gender = 'M'")
    with pytest.raises(ValueError, match="one value rule"):
        change_values(raw_frame(spark, {}), [*SILVER_RULES, again])
