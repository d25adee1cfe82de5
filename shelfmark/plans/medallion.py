"""The jobs: raw -> bronze -> silver -> gold, each handing over through its written layer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.operators.audit import audit_metadata
from shelfmark.operators.checks import (
    count_reconciliation,
    mart_profile,
    schema_differences,
    silver_invariants,
)
from shelfmark.operators.clean import stamp
from shelfmark.operators.dedupe import dedupe_counted
from shelfmark.operators.facts import rule_facts, silver_facts
from shelfmark.operators.marts import best_first, mart_totals, marts_from_totals, order_amounts
from shelfmark.operators.rules import SILVER_RULES, Rule, accepted, judge, settle
from shelfmark.schemas import (
    AUDIT,
    BRONZE,
    BRONZE_FILES,
    BRONZE_WITH_ORIGIN,
    FACTS,
    MARTS,
    RANGES,
    SILVER,
    SILVER_WITH_ORIGIN,
)
from shelfmark.session import even_scans, sized_shuffles, small_dictionaries, unsorted_writes
from shelfmark.sources import (
    file_ranges,
    file_schema,
    inferred_layer,
    read_layer,
    read_ranked,
    read_raw,
    read_version,
    with_ingest_metadata,
    write_bronze,
    write_mart,
    write_silver,
)
from shelfmark.sources.generations import (
    Draft,
    Home,
    Version,
    current,
    drafting,
    publish_draft,
    published,
    vacuum,
)
from shelfmark.storage import remove, scratch, stage

# daily rows are bounded by the calendar, so one file is enough
SINGLE_FILE = {"daily_sales_metrics"}
# marts whose files hold one range of the order each, and the column they are ordered by
RANKED = {"top_products": "revenue"}
# failed rows that a message spells out; it counts the others
SHOWN_FAILURES = 20


class CheckFailed(RuntimeError):
    """A layer does not hold what its checks demand; the message lists the failed rows."""


@dataclass(frozen=True)
class Layout:
    """Where the layers of one pipeline live. ``keep`` versions of each stay readable."""

    root: str
    keep: int = 2

    # Folder names of the layers.

    @property
    def bronze(self) -> Home:
        return Home(f"{self.root}/bronze/retail_sales_bronze.parquet", f"{self.root}/bronze/published")

    @property
    def silver(self) -> Home:
        return Home(f"{self.root}/silver/retail_sales_clean.parquet", f"{self.root}/silver/published")

    @property
    def gold(self) -> Home:
        return Home(f"{self.root}/gold", f"{self.root}/gold/published")

    @property
    def silver_facts(self) -> Home:
        return Home(f"{self.root}/silver/retail_sales_facts.parquet", self.silver.log)

    @property
    def layers(self) -> dict[str, Home]:
        return {"bronze": self.bronze, "silver": self.silver, "gold": self.gold}


def require_empty(problems: DataFrame, what: str) -> None:
    rows = problems.limit(SHOWN_FAILURES).collect()
    if rows:
        more = problems.count() - len(rows)
        also = f" and {more} more" if more else ""
        raise CheckFailed(f"{what}: {[row.asDict() for row in rows]}{also}")


def require_schema(found: StructType, expected: StructType, what: str) -> None:
    differences = schema_differences(found, expected)
    if differences:
        raise CheckFailed(f"schema of {what}: {differences}")


def require_files(spark: SparkSession, path: str, expected: StructType, partition: str | None, what: str) -> None:
    """The footers of all files say what is declared; ``partition`` is in folder names instead."""
    found = file_schema(spark, path)
    if len(found):
        data = [f for f in expected if f.name != partition]
        require_schema(StructType([f for f in found if f.name != partition]), StructType(data), what)


def _publish(spark: SparkSession, home: Home, draft: Draft, folders: Sequence[str], before: Version | None, keep: int) -> list[str]:
    return vacuum(spark, home, keep, listed=publish_draft(spark, home, draft, folders, before))


def _date_folder(date) -> str:
    return f"ingestion_date={'__HIVE_DEFAULT_PARTITION__' if date is None else date}"


def read_bronze(spark: SparkSession, layout: Layout, expected: StructType = BRONZE) -> DataFrame:
    """The published bronze rows; ``BRONZE_FILES`` also gives their origin and what could not be read."""
    return read_version(spark, layout.bronze, published(spark, layout.bronze), expected)


def ingest(
    spark: SparkSession,
    raw: str | list[str],
    layout: Layout,
    dynamic: bool = False,
    rebalance: bool = False,
    check_header: bool = False,
    check_counts: bool = False,
) -> DataFrame:
    """CSV to bronze in one pass, published once its rows are all there.

    Every row carries its source file, the ingestion time and the names of columns that could not be
    read. The rows that the scan hands to the writer are counted on the way; the draft must hold as
    many. If it does not, or with ``check_counts``, the CSV is read once more and compared by date,
    and a difference fails the job with bronze as it was. ``dynamic`` replaces only the dates that
    are in ``raw``: the folders of the others stay listed as they are.
    """
    home = layout.bronze
    before = current(spark, home)
    rows = read_raw(spark, raw, check_header=check_header, ledger=True)
    scanned = Observation()
    counted = with_ingest_metadata(rows).select(*BRONZE_FILES.names).observe(scanned, F.count(F.lit(1)).alias("n"))
    with even_scans(spark), unsorted_writes(spark), small_dictionaries(spark), drafting(spark, home) as draft:
        write_bronze(counted, draft.path, rebalance=rebalance)
        by_date = F.count(F.lit(1)).alias("bronze_rows")
        held = read_layer(spark, draft.path, BRONZE_FILES).groupBy("ingestion_date").agg(by_date)
        # a row per date
        dates = held.collect()
        if check_counts or scanned.get["n"] != sum(row.bronze_rows for row in dates):
            _require_same_dates(read_raw(spark, raw, check_header=check_header), held)
        require_files(spark, draft.path, BRONZE_FILES, "ingestion_date", "bronze")
        fresh = [_date_folder(row.ingestion_date) for row in dates]
        kept = [f for f in before.folders if f.split("/")[1] not in fresh] if dynamic and before else []
        folders = [*kept, *[f"{draft.folder}/{date}" for date in sorted(fresh)]]
        _publish(spark, home, draft, folders, before, layout.keep)
    return read_bronze(spark, layout)


def _require_same_dates(rows: DataFrame, held: DataFrame) -> None:
    by_date = rows.groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("raw_rows"))
    both = by_date.join(held, by_date.ingestion_date.eqNullSafe(held.ingestion_date), "full")
    differing = ~F.col("raw_rows").eqNullSafe(F.col("bronze_rows"))
    require_empty(both.filter(differing).select("raw_rows", "bronze_rows"), "raw and bronze rows")


def read_silver(spark: SparkSession, layout: Layout, expected: StructType = SILVER) -> DataFrame:
    (path,) = published(spark, layout.silver).paths(layout.silver)
    return read_layer(spark, path, expected)


def read_facts(spark: SparkSession, layout: Layout) -> DataFrame:
    """What the job met that wrote the published silver layer."""
    generation = published(spark, layout.silver).generation
    return read_layer(spark, layout.silver_facts.folder(generation), FACTS)


def refine(
    spark: SparkSession,
    layout: Layout,
    rules: Sequence[Rule] = SILVER_RULES,
    rebalance: bool = False,
    check: bool = True,
    origin: bool = False,
) -> DataFrame:
    """Bronze to silver; returns the rule report.

    The one expensive step, the deduplication shuffle, runs once: its judged rows are staged in the
    shared folder, and report, facts, checks and silver table all start from there. The draft is
    checked as it lies in its files, and published with its facts in one step; what is staged is
    removed at the end. ``origin`` carries source file and ingestion time of each survivor along.
    """
    home, before = layout.silver, current(spark, layout.silver)
    bronze = read_bronze(spark, layout, BRONZE_WITH_ORIGIN if origin else BRONZE)
    expected = SILVER_WITH_ORIGIN if origin else SILVER
    sized, unsorted, small = sized_shuffles(spark, bronze), unsorted_writes(spark), small_dictionaries(spark)
    with sized, unsorted, small, scratch(spark, "judged") as path, drafting(spark, home) as draft:
        judged = stage(judge(dedupe_counted(bronze), rules), path)
        write_silver(stamp(accepted(settle(judged.drop("copies"), rules))), draft.path, rebalance=rebalance)
        if check:
            require_files(spark, draft.path, expected, "order_status", "silver")
            silver = read_layer(spark, draft.path, expected)
            require_empty(
                silver_invariants(silver, rules).filter("violations > 0"), "silver invariants"
            )
            require_empty(
                count_reconciliation(bronze, judged, silver, rules).filter(
                    "entry = 'difference' AND n_rows <> 0"
                ),
                "row counts",
            )
        facts = layout.silver_facts.folder(draft.generation)
        write_mart(silver_facts(judged, rules), facts, single_file=True)
        for folder in _publish(spark, home, draft, [draft.folder], before, layout.keep):
            remove(spark, f"{layout.silver_facts.data}/{folder}")
        return rule_facts(read_layer(spark, facts, FACTS), rules)


def mart_path(folder: str, name: str) -> str:
    return f"{folder}/{name}.parquet"


def marts_in(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_layer(spark, mart_path(folder, name), MARTS[name]) for name in MARTS}


def _gold_folder(spark: SparkSession, layout: Layout) -> str:
    (folder,) = published(spark, layout.gold).paths(layout.gold)
    return folder


def read_marts(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The published marts, all of one run."""
    return marts_in(spark, _gold_folder(spark, layout))


def read_audit(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_layer(spark, mart_path(_gold_folder(spark, layout), "audit_metadata"), AUDIT)


def read_top_products(spark: SparkSession, layout: Layout, k: int | None = None) -> DataFrame:
    """The published products, best first, without a sort; the ``k`` best from the first files only."""
    return ranked_products(spark, _gold_folder(spark, layout), k)


def ranked_products(spark: SparkSession, folder: str, k: int | None = None) -> DataFrame:
    name = "top_products"
    ranges = read_layer(spark, mart_path(folder, f"{name}_ranges"), RANGES)
    rows = read_ranked(spark, mart_path(folder, name), MARTS[name], ranges, k)
    # the last of the files may hold more than is asked for
    return rows if k is None else best_first(rows).limit(k)


def write_marts(amounts: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Write the five marts into ``folder``, check the footers of their files, and return them as read back.

    Only the totals are kept between the marts, not the lines: they are as small as the marts, and
    the silver layer is scanned once for all five. Lost blocks are recomputed from that scan. Beside
    a sorted mart lies a table of what range each of its files holds.
    """
    spark = amounts.sparkSession
    totals = mart_totals(amounts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, mart in marts_from_totals(totals).items():
            write_mart(mart, mart_path(folder, name), single_file=name in SINGLE_FILE)
            require_files(spark, mart_path(folder, name), MARTS[name], None, name)
    finally:
        totals.unpersist()
    for name, column in RANKED.items():
        ranges = file_ranges(inferred_layer(spark, mart_path(folder, name)), column)
        write_mart(ranges, mart_path(folder, f"{name}_ranges"), single_file=True)
    return marts_in(spark, folder)


def publish(spark: SparkSession, layout: Layout, check: bool = True) -> DataFrame:
    """Silver to the five marts and the audit row, which is returned.

    All six tables are written once, into one generation, checked there as they lie in their files,
    and published together: readers never see marts of two runs.
    """
    home, before = layout.gold, current(spark, layout.gold)
    amounts = order_amounts(read_silver(spark, layout))
    with sized_shuffles(spark, amounts), small_dictionaries(spark), drafting(spark, home) as draft:
        marts = write_marts(amounts, draft.path)
        audit = mart_path(draft.path, "audit_metadata")
        write_mart(audit_metadata(amounts, marts), audit, single_file=True)
        failed = read_layer(spark, audit, AUDIT).filter("pipeline_status = 'FAILED'")
        if check and not failed.isEmpty():
            require_empty(mart_profile(amounts, marts).filter("NOT ok"), "marts")
        _publish(spark, home, draft, [draft.folder], before, layout.keep)
    return read_audit(spark, layout)


def run(
    spark: SparkSession, raw: str | list[str], root: str, origin: bool = False, **ingest_options: bool
) -> DataFrame:
    """All three layers; raises ``CheckFailed`` on a bad run, else returns the audit row."""
    layout = Layout(root)
    ingest(spark, raw, layout, **ingest_options)
    refine(spark, layout, origin=origin)
    return publish(spark, layout)
