"""Cleaning rules as data, and the operators that run a table of them in one pass.

Each rule judges the raw value of its column, so all value changes fit one projection and all drops
one filter; the order of the table only decides which rule a dropped row is booked to.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from shelfmark.schemas import LARGE_PRICE, PERCENT, PRICE

DROP, NULLIFY, NORMALISE, NOTE = "drop", "nullify", "normalise", "note"


def quoted(name: str) -> str:
    """A column name as SQL."""
    return "`" + name.replace("`", "``") + "`"


def _inexact(column: str, *kinds: DecimalType) -> str:
    """SQL that is TRUE where a value changes, or is lost, in all of the decimal types that amounts use."""
    same = [f"CAST(try_cast({column} AS {kind.simpleString()}) AS DOUBLE) <=> {column}" for kind in kinds]
    return f"{column} IS NOT NULL AND NOT ({' OR '.join(same)})"


@dataclass(frozen=True)
class Rule:
    """``expr`` is SQL: what to keep (drop), what is bad (nullify), the new value (normalise), or what
    is only counted (note).
    """

    name: str
    kind: str
    column: str
    expr: str

    @property
    def violated(self) -> str:
        """SQL that is TRUE where the rule acts on a row, else FALSE, never NULL."""
        if self.kind == DROP:
            return f"NOT coalesce({self.expr}, FALSE)"
        if self.kind == NORMALISE:
            return f"NOT ({quoted(self.column)} <=> ({self.expr}))"
        return f"coalesce({self.expr}, FALSE)"

    @property
    def broken(self) -> str:
        """SQL that is TRUE where a cleaned row does not hold what the rule promises."""
        return "FALSE" if self.kind == NOTE else self.violated

    @property
    def cleaned(self) -> str:
        """SQL of the column after the rule."""
        if self.kind == NORMALISE:
            return self.expr
        if self.kind == NULLIFY:
            return f"CASE WHEN NOT {self.violated} THEN {quoted(self.column)} END"
        return quoted(self.column)


# The accepted categories, statuses, payment types and bounds.
SILVER_RULES: tuple[Rule, ...] = (
    Rule("transaction_id_present", DROP, "transaction_id", "transaction_id IS NOT NULL"),
    Rule("customer_id_present", DROP, "customer_id", "customer_id IS NOT NULL"),
    # Furniture is a known category that is no longer sold
    Rule(
        "active_category",
        DROP,
        "product_category",
        "product_category IN ('Electronics', 'Fashion', 'Grocery', 'Sports')",
    ),
    Rule("ship_not_before_order", NULLIFY, "ship_date", "ship_date < order_date"),
    Rule(
        "known_status",
        NULLIFY,
        "order_status",
        "order_status NOT IN ('Delivered', 'Cancelled', 'Returned')",
    ),
    Rule("positive_quantity", DROP, "quantity", "quantity > 0"),
    Rule(
        "positive_price",
        NULLIFY,
        "unit_price",
        "unit_price <= 0",
    ),
    Rule("price_exact", NOTE, "unit_price", _inexact("unit_price", PRICE, LARGE_PRICE)),
    Rule(
        "discount_range",
        NULLIFY,
        "discount_pct",
        "discount_pct < 0 OR discount_pct > 100",
    ),
    Rule("discount_exact", NOTE, "discount_pct", _inexact("discount_pct", PERCENT)),
    Rule("age_range", NULLIFY, "customer_age", "customer_age < 15 OR customer_age > 100"),
    Rule(
        "gender_code",
        NORMALISE,
        "gender",
        "CASE WHEN upper(trim(gender)) IN ('M', 'MALE') THEN 'M'"
        " WHEN upper(trim(gender)) IN ('F', 'FEMALE') THEN 'F' END",
    ),
    Rule(
        "payment_code",
        NORMALISE,
        "payment_type",
        "CASE WHEN upper(trim(payment_type)) IN ('CARD', 'UPI', 'COD')"
        " THEN upper(trim(payment_type)) END",
    ),
)


# the rules whose violations are worth a look: a value is there, and it is wrong
PREVIEWED = (
    "ship_not_before_order",
    "positive_quantity",
    "positive_price",
    "discount_range",
    "age_range",
    "payment_code",
)


def rules_named(*names: str, rules: Sequence[Rule] = SILVER_RULES) -> tuple[Rule, ...]:
    by_name = {rule.name: rule for rule in rules}
    return tuple(by_name[name] for name in names)


def drop_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Apply the drop rules: one filter."""
    for rule in rules:
        if rule.kind == DROP:
            df = df.filter(rule.expr)
    return df


def change_values(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Apply the nullify and normalise rules: one projection."""
    changes = [rule for rule in rules if rule.kind in (NULLIFY, NORMALISE)]
    columns = [rule.column for rule in changes]
    if len(set(columns)) < len(columns):
        raise ValueError("one value rule per column: rules judge raw values")
    return df.withColumns({rule.column: F.expr(rule.cleaned) for rule in changes})


def apply_rules(df: DataFrame, rules: Sequence[Rule] = SILVER_RULES) -> DataFrame:
    return change_values(drop_rows(df, rules), rules)


def _acting(rules: Sequence[Rule]) -> list[str]:
    """For each rule, SQL of the rows it acts on: those that earlier drop rules left."""
    left, acting = [], []
    for rule in rules:
        acting.append(" AND ".join([*left, rule.violated]))
        if rule.kind == DROP:
            left.append(f"coalesce({rule.expr}, FALSE)")
    return acting


def judge(df: DataFrame, rules: Sequence[Rule] = SILVER_RULES) -> DataFrame:
    """Keep every row and add what the rules find: ``fired`` and ``rejected_by``.

    ``fired`` holds the numbers of the rules that act on the row, up to its rejection;
    ``rejected_by`` is the drop rule that ends it, NULL for a row that stays.
    """
    numbers = [f"CASE WHEN {on} THEN {n} END" for n, on in enumerate(_acting(rules))]
    # array_compact would take every row out of generated code
    without_null = "array(CAST(NULL AS INT))"
    fired = f"array_except(array({', '.join(numbers)}), {without_null})" if numbers else "CAST(array() AS ARRAY<INT>)"
    drops = [f"WHEN {r.violated} THEN {_text(r.name)}" for r in rules if r.kind == DROP]
    rejected_by = f"CASE {' '.join(drops)} END" if drops else "CAST(NULL AS STRING)"
    return df.withColumns(
        {"fired": F.expr(fired), "rejected_by": F.expr(rejected_by)}
    )


def settle(judged: DataFrame, rules: Sequence[Rule] = SILVER_RULES) -> DataFrame:
    """Clean the judged rows and blank the rejected ones, which then cost next to nothing to store."""
    cleaned = change_values(judged, rules)
    verdict = ["fired", "rejected_by"]
    kept = [name for name in cleaned.columns if name not in verdict]
    return cleaned.selectExpr(
        *[f"CASE WHEN rejected_by IS NULL THEN {c} END AS {c}" for c in map(quoted, kept)], *verdict
    )


def accepted(settled: DataFrame) -> DataFrame:
    return settled.filter("rejected_by IS NULL").drop("fired", "rejected_by")


def tally(judged: DataFrame, rules: Sequence[Rule] = SILVER_RULES) -> DataFrame:
    """(rule, kind, column, n_rows): rows each rule acted on, from one aggregate over the table."""
    counts = judged.agg(
        *[F.count_if(F.array_contains("fired", n)).alias(f"n{n}") for n in range(len(rules))]
    )
    rows = ", ".join(
        f"{_text(r.name)}, {_text(r.kind)}, {_text(r.column)}, n{n}" for n, r in enumerate(rules)
    )
    return counts.selectExpr(f"stack({len(rules)}, {rows}) AS (rule, kind, column, n_rows)")


def _text(value: str) -> str:
    """A string as SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rule_report(df: DataFrame, rules: Sequence[Rule] = SILVER_RULES) -> DataFrame:
    """What each rule removes (drop) or changes (nullify, normalise) in ``df``.

    A rule counts the rows that earlier drop rules left, so the drops add up to the rows removed.
    """
    return tally(judge(df, rules), rules)


def violation_preview(
    df: DataFrame, rule: Rule, n: int = 5, order: Sequence[Column] | None = None
) -> DataFrame:
    """``n`` rows whose value breaks the rule; a NULL value is not shown.

    Any ``n`` rows, and the scan stops once it has them; or with ``order`` the first ``n``, for
    which each task keeps only its own first ``n``.
    """
    violating = df.filter(f"{rule.violated} AND {quoted(rule.column)} IS NOT NULL")
    return (violating.orderBy(*order) if order else violating).limit(n)


def violation_previews(
    df: DataFrame,
    order: Sequence[Column],
    rules: Sequence[Rule] = SILVER_RULES,
    n: int = 5,
    shown: Sequence[str] | None = None,
    nth: str | None = None,
) -> DataFrame:
    """``rule`` and the rows of its ``violation_preview``, for every rule or those ``shown``.

    ``nth`` names a column that numbers the rows of a rule.

    A rule looks at the rows that the drop rules before it left. One pass: a row goes to each rule
    that it breaks, and ``n`` rows per rule are kept in the task before any are moved.
    """
    named = [
        f"CASE WHEN {on} AND {quoted(rule.column)} IS NOT NULL THEN {_text(rule.name)} END"
        for rule, on in zip(rules, _acting(rules), strict=True)
        if shown is None or rule.name in shown
    ]
    # generated code walks the array and copies a row only for the rules that it breaks
    broken = df.select(F.expr(f"explode(array({', '.join(named)}))").alias("rule"), "*").filter("rule IS NOT NULL")
    first = Window.partitionBy("rule").orderBy(*order)
    ranked = broken.withColumn("_nth", F.row_number().over(first))
    some = ranked.filter(F.col("_nth") <= n)
    return some.withColumnRenamed("_nth", nth) if nth else some.drop("_nth")
