"""What the silver job met, as one small table that is kept beside the layer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.dedupe import total_order
from shelfmark.operators.profile import value_distribution
from shelfmark.operators.rules import PREVIEWED, SILVER_RULES, Rule, violation_previews
from shelfmark.schemas import FACTS, RAW

# repeated keys and violations that are shown each
SHOWN = 5


def _facts(df: DataFrame, fact: str, subject: Column, n: Column, record: Column | None = None) -> DataFrame:
    record = F.lit(None).cast("string") if record is None else record
    row = (F.lit(fact), subject.cast("string"), n.cast("long"), record)
    return df.select(*[value.alias(name) for value, name in zip(row, FACTS.names, strict=True)])


def _counts(judged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Facts ``rows`` and ``rule`` from one aggregate."""
    entries = {
        ("rows", "read"): F.coalesce(F.sum("copies"), F.lit(0)),
        ("rows", "deduplicated"): F.count(F.lit(1)),
        ("rows", "repeated_keys"): F.count_if(F.col("copies") > 1),
    }
    entries |= {("rule", r.name): F.count_if(F.array_contains("fired", n)) for n, r in enumerate(rules)}
    one = judged.agg(*[column.alias(f"n{k}") for k, column in enumerate(entries.values())])
    facts = [
        F.struct(F.lit(fact).alias("fact"), F.lit(subject).alias("subject"), F.col(f"n{k}").alias("n"))
        for k, (fact, subject) in enumerate(entries)
    ]
    return one.select(F.inline(F.array(*facts))).withColumn("record", F.lit(None).cast("string"))


def silver_facts(
    judged: DataFrame, rules: Sequence[Rule] = SILVER_RULES, key: str = "transaction_id", shown: int = SHOWN
) -> DataFrame:
    """Repeated keys, violations and genders before the rules, and what each rule did, as ``FACTS``.

    ``judged`` holds the deduplicated rows with ``copies``, judged but not changed. Facts:
    ``rows`` (read, kept by the deduplication, keys seen more than once), ``repeated_key`` (those
    with the most copies), ``violation`` (the n-th row of a rule, as JSON), ``gender_met`` and
    ``rule``. A few rows each: every part keeps its best in the task before any row moves.
    """
    most = judged.filter("copies > 1").orderBy(F.desc("copies"), F.asc_nulls_last(key)).limit(shown)
    met = judged.select(*RAW.names)
    nth = violation_previews(met, total_order(), rules, shown, [r.name for r in rules if r.name in PREVIEWED], nth="nth")
    parts = [
        _counts(judged, rules),
        _facts(most, "repeated_key", F.col(key), F.col("copies")),
        _facts(nth, "violation", F.col("rule"), F.col("nth"), F.to_json(F.struct(*RAW.names))),
        _facts(value_distribution(met, ["gender"]), "gender_met", F.col("value"), F.col("n")),
    ]
    return reduce(DataFrame.unionByName, parts)


def rule_facts(facts: DataFrame, rules: Sequence[Rule] = SILVER_RULES) -> DataFrame:
    """The rule report (rule, kind, column, n_rows) that the facts hold; a row per rule."""
    held = {row.subject: row.n for row in facts.filter("fact = 'rule'").collect()}
    rows = [(r.name, r.kind, r.column, held[r.name]) for r in rules]
    return facts.sparkSession.createDataFrame(rows, "rule string, kind string, column string, n_rows long")
