"""What runs over every row must not leave generated code, as functions with lambdas do."""

from shelfmark.operators.dedupe import total_order
from shelfmark.operators.rules import SILVER_RULES, judge, violation_previews
from tests.rows import raw_frame


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_previews_stay_in_generated_code(spark):
    previews = violation_previews(raw_frame(spark, {}), total_order())
    assert "lambda" not in _plan(previews)


def test_previews_show_a_row_for_each_rule_it_breaks(spark):
    df = raw_frame(spark, {"customer_age": 1, "discount_pct": 200.0}, {"customer_age": None}, {"quantity": 0})
    found = sorted((r.rule, r.transaction_id) for r in violation_previews(df, total_order()).collect())
    assert found == [("age_range", 1), ("discount_range", 1), ("positive_quantity", 3)]
    assert violation_previews(df, total_order(), (), 5).count() == 0
    assert violation_previews(df, total_order(), shown=()).count() == 0
    assert violation_previews(df, ["transaction_id"], n=5, nth="nth").columns == ["rule", *df.columns, "nth"]


def test_judging_stays_in_generated_code(spark):
    judged = judge(raw_frame(spark, {"customer_age": 1, "discount_pct": 200.0}, {}, {"customer_id": None, "quantity": 0}))
    assert "lambda" not in _plan(judged)
    fired = {r.transaction_id: [SILVER_RULES[n].name for n in r.fired] for r in judged.collect()}
    assert fired == {1: ["discount_range", "age_range"], 2: [], 3: ["customer_id_present"]}
