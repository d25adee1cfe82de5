"""Layers change all at once: whatever dies in between, readers see the last whole version."""

import os
import shutil
import signal
import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import profile
from shelfmark.operators.dedupe import dedupe, dedupe_counted
from shelfmark.plans import medallion, reports
from shelfmark.plans.medallion import (
    CheckFailed,
    Layout,
    ingest,
    publish,
    ranked_products,
    read_audit,
    read_bronze,
    read_facts,
    read_marts,
    read_silver,
    read_top_products,
    refine,
    run,
)
from shelfmark.schemas import BRONZE_FILES, BRONZE_WITH_ORIGIN, MARTS, RAW, SILVER_WITH_ORIGIN
from shelfmark.sources import generations, unreadable_values
from shelfmark.sources.generations import PublishConflict, current, drafting, publish_draft, vacuum, versions
from shelfmark.storage import remove
from tests.rows import raw_frame

REPO = Path(__file__).resolve().parent.parent


def _csv(df, path):
    df.write.options(header=True).csv(str(path))
    return str(path)


def _shown(spark, layout):
    """All that readers see of the three layers."""
    tables = {"bronze": read_bronze(spark, layout), "silver": read_silver(spark, layout), "audit": read_audit(spark, layout)}
    return {name: sorted(map(str, t.collect())) for name, t in (tables | read_marts(spark, layout)).items()}


class Killed(BaseException):
    """Stands for a job that ends here and cleans nothing up."""


@pytest.fixture(scope="module")
def first_run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("first")
    first = _csv(raw_frame(spark, {}, {"city": "Reno", "product_id": "PROD2"}), folder / "a")
    _csv(raw_frame(spark, {"quantity": 9}, {}, {"city": "Reno"}, {"quantity": 0}), folder / "b")
    run(spark, first, str(folder / "out"))
    return folder


@pytest.fixture
def two_inputs(first_run, tmp_path):
    shutil.copytree(first_run / "out", tmp_path / "out")
    return Layout(str(tmp_path / "out")), str(first_run / "b")


# the writes of a whole run: bronze, silver, its facts, five marts, ranges, audit, and a switch per layer
DEATHS = [("write_bronze", 1), ("publish_draft", 1), ("write_silver", 1), ("write_mart", 1), ("write_mart", 4), ("write_mart", 8), ("publish_draft", 3)]


@pytest.mark.parametrize(("name", "nth"), DEATHS)
def test_death_between_any_two_writes(spark, two_inputs, monkeypatch, name, nth):
    layout, second = two_inputs
    before, calls, real = _shown(spark, layout), [], getattr(medallion, name)

    def dies(*arguments, **options):
        calls.append(name)
        if len(calls) == nth:
            raise Killed
        return real(*arguments, **options)

    monkeypatch.setattr(medallion, name, dies)
    monkeypatch.setattr(generations, "remove", lambda *a: None)
    with pytest.raises(Killed):
        run(spark, second, layout.root)
    monkeypatch.undo()
    after = _shown(spark, layout)
    assert all(after[m] == before[m] for m in [*MARTS, "audit"])
    place = DEATHS.index((name, nth))
    assert (after["bronze"] == before["bronze"]) == (place < 2)
    assert (after["silver"] == before["silver"]) == (place < 4)


def test_what_a_dead_job_left_can_go(spark, two_inputs, monkeypatch):
    layout, second = two_inputs
    monkeypatch.setattr(generations, "remove", lambda *a: None)
    with pytest.raises(ZeroDivisionError), drafting(spark, layout.gold) as dead:
        raw_frame(spark, {}).write.parquet(dead.path)
        raise ZeroDivisionError
    monkeypatch.undo()
    before = _shown(spark, layout)
    assert vacuum(spark, layout.gold) == [] and vacuum(spark, layout.gold, drafts=True) == [dead.folder]
    assert not Path(dead.path).exists() and _shown(spark, layout) == before
    assert run(spark, second, layout.root).first().source_rows == 3


KILLED = """
import os, signal, sys
sys.path.insert(0, {repo!r})
from shelfmark.plans import medallion
from shelfmark.session import build_session
spark = build_session("dies", {{"spark.master": "local[2]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": 2}})
write, n = medallion.write_mart, []
def dies(*a, **k):
    write(*a, **k)
    n.append(1)
    if len(n) == 3:
        os.killpg(0, signal.SIGKILL)
medallion.write_mart = dies
medallion.publish(spark, medallion.Layout({root!r}))
"""


def test_killed_process(spark, two_inputs):
    layout, second = two_inputs
    ingest(spark, second, layout)
    refine(spark, layout)
    before = _shown(spark, layout)
    code = KILLED.format(repo=str(REPO), root=layout.root)
    ended = subprocess.run([sys.executable, "-c", code], start_new_session=True, capture_output=True, timeout=200, env=dict(os.environ))
    assert ended.returncode == -signal.SIGKILL
    assert _shown(spark, layout) == before
    drafts = vacuum(spark, layout.gold, drafts=True)
    assert len(drafts) == 1 and _shown(spark, layout) == before
    assert publish(spark, layout).first().source_rows == 3


def test_a_reader_keeps_its_version(spark, two_inputs):
    layout, second = two_inputs
    held = read_silver(spark, layout)
    rows = sorted(map(str, held.collect()))
    run(spark, second, layout.root)
    assert sorted(map(str, held.collect())) == rows
    assert read_silver(spark, layout).count() == 3


def test_old_versions_go(spark, two_inputs):
    layout, second = two_inputs
    for _ in range(2):
        run(spark, second, layout.root)
    for home in layout.layers.values():
        listed = versions(spark, home)
        assert [v.number for v in listed] == [3, 2]
        kept = {f.split("/")[0] for v in listed for f in v.folders}
        assert {p.name for p in Path(home.data).glob("generation=*")} == kept
    facts = Path(layout.silver_facts.data)
    assert {p.name for p in facts.iterdir()} == {p.name for p in Path(layout.silver.data).iterdir()}
    assert read_facts(spark, layout).count() > 0


def test_dates_that_are_not_replaced_keep_their_files(spark, tmp_path):
    layout, days = Layout(str(tmp_path / "out"), keep=1), [date(2024, 6, n) for n in (1, 2)]
    ingest(spark, _csv(raw_frame(spark, *[{"ingestion_date": d} for d in (*days, None)]), tmp_path / "a"), layout)
    again = raw_frame(spark, {"ingestion_date": days[1], "city": "Reno"}, {"ingestion_date": days[1], "city": "Waco"})
    for n in range(3):
        ingest(spark, _csv(again, tmp_path / f"b{n}"), layout, dynamic=True, check_counts=True)
    assert {(r.ingestion_date, r.city) for r in read_bronze(spark, layout).collect()} == {
        (days[0], "Dallas"), (days[1], "Reno"), (days[1], "Waco"), (None, "Dallas"),
    }
    folders = current(spark, layout.bronze).folders
    assert len(folders) == 3 and len({f.split("/")[0] for f in folders}) == 2
    below = sorted(str(p.relative_to(layout.bronze.data)) for p in Path(layout.bronze.data).glob("*/ingestion_date=*"))
    assert below == sorted(folders)
    ingest(spark, _csv(again.limit(0), tmp_path / "none"), layout)
    assert read_bronze(spark, layout).count() == 0 and read_bronze(spark, layout, BRONZE_FILES).schema == BRONZE_FILES


def test_overlapping_writers_do_not_undo_each_other(spark, two_inputs):
    layout, _ = two_inputs
    before = current(spark, layout.gold)
    with pytest.raises(PublishConflict), drafting(spark, layout.gold) as slow:
        with drafting(spark, layout.gold) as fast:
            publish_draft(spark, layout.gold, fast, [fast.folder], before)
        publish_draft(spark, layout.gold, slow, [slow.folder], before)
    assert current(spark, layout.gold).generation == fast.generation


def test_nothing_published(spark, tmp_path):
    layout = Layout(str(tmp_path))
    assert versions(spark, layout.gold) == []
    with pytest.raises(FileNotFoundError):
        read_silver(spark, layout)


def test_a_writer_that_loses_a_row_fails_the_run(spark, two_inputs, monkeypatch):
    layout, second = two_inputs
    ingest(spark, second, layout)
    before, write = _shown(spark, layout), medallion.write_silver
    monkeypatch.setattr(medallion, "write_silver", lambda df, *a, **k: write(df.filter("transaction_id > 1"), *a, **k))
    with pytest.raises(CheckFailed, match="difference"):
        refine(spark, layout)
    monkeypatch.setattr(medallion, "write_silver", lambda df, *a, **k: write(df.withColumn("gender", F.lit("x")), *a, **k))
    with pytest.raises(CheckFailed, match="gender_code"):
        refine(spark, layout)
    monkeypatch.setattr(medallion, "write_silver", lambda df, *a, **k: write(df.withColumn("quantity", F.col("quantity").cast("long")), *a, **k))
    with pytest.raises(CheckFailed, match="schema of silver.*quantity"):
        refine(spark, layout)
    assert _shown(spark, layout) == before


def test_marts_are_written_once(spark, two_inputs, monkeypatch):
    layout, _ = two_inputs
    paths, write = [], medallion.write_mart
    monkeypatch.setattr(medallion, "write_mart", lambda df, path, **k: (paths.append(path), write(df, path, **k)))
    publish(spark, layout)
    assert len(paths) == len(set(paths)) == len(MARTS) + 2


def test_counted_dedupe_is_dedupe(spark):
    changes = [{"transaction_id": n % 7 or None, "quantity": n % 3, "city": None if n % 2 else "Reno", "unit_price": n % 5 * 0.5,
                "ingestion_date": None if n % 4 == 0 else date(2024, 1, 1 + n % 2)} for n in range(200)]
    rows = raw_frame(spark, *changes)
    counted = dedupe_counted(rows)
    text = counted._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange ") == 1 and "partial_min" in text
    found = counted.collect()
    assert sorted(str(r[:-1]) for r in found) == sorted(str(r[:]) for r in dedupe(rows).collect())
    assert sum(r.copies for r in found) == 200


def test_origin_does_not_choose_survivors(spark, tmp_path):
    layout = Layout(str(tmp_path / "out"))
    same = {"transaction_id": 1, "quantity": 5}
    for name, rows in {"a": [same, {"transaction_id": 2}], "b": [same, {"transaction_id": 1, "quantity": 4}], "c": [{}]}.items():
        _csv(raw_frame(spark, *rows).coalesce(1), tmp_path / "raw" / name)
    ingest(spark, [str(tmp_path / "raw" / n) for n in "cba"], layout)
    refine(spark, layout)
    without = sorted(str(r[:-1]) for r in read_silver(spark, layout).collect())
    refine(spark, layout, origin=True)
    assert sorted(str(r[:-1]) for r in read_silver(spark, layout).collect()) == without
    silver = read_silver(spark, layout, SILVER_WITH_ORIGIN)
    files = {r.transaction_id: r.source_file.split("/")[-2] for r in silver.collect()}
    assert files == {1: "c", 2: "a"} and silver.filter("ingested_at IS NULL").count() == 0
    twice = raw_frame(spark, same, same).withColumns({"source_file": F.col("transaction_id").cast("string"), "ingested_at": F.current_timestamp()})
    assert dedupe_counted(twice.select(*BRONZE_WITH_ORIGIN.names)).drop("copies", "source_file", "ingested_at").collect() == dedupe(raw_frame(spark, same, same)).collect()
    publish(spark, layout)


def test_unreadable_values_are_kept_with_their_line(spark, tmp_path):
    lines = [
        ",".join(RAW.names),
        "1,2024-05-10,2024-05-12,CUST1,30,M,PROD1,Sports,2,10.5,5,Dallas,TX,UPI,Delivered,2024-06-01",
        '2,2024-05-10,soon,CUST1,x,M,PROD1,Sports,"2,50",10.5,5,Dallas,TX,UPI,Delivered,2024-06-01',
        "3,2024-05-10,,CUST1,,M,PROD1,Sports,2,10.5,5,Dallas,TX,UPI,Delivered,2024-06-01,more",
        "4,2024-05-10",
    ]
    (tmp_path / "raw.csv").write_text("\n".join(lines) + "\n")
    layout = Layout(str(tmp_path / "out"))
    ingest(spark, str(tmp_path / "raw.csv"), layout, check_header=True)
    kept = {r.transaction_id: (r.unreadable, r.raw_record) for r in read_bronze(spark, layout, BRONZE_FILES).collect()}
    assert kept == {
        1: (None, None), 2: (["ship_date", "customer_age", "quantity"], lines[2]), 3: (["(fields)"], lines[3]), 4: (["(fields)"], lines[4]),
    }
    report = reports.bronze_report(spark, layout)
    assert {r.column: r.n_values for r in report["unreadable values"].filter("n_values > 0").collect()} == {
        "ship_date": 1, "customer_age": 1, "quantity": 1, "(fields)": 2,
    }
    assert report["schema"].filter("NOT ok").count() == 0


def test_bronze_report_counts_in_one_pass(spark, two_inputs):
    layout, second = two_inputs
    run(spark, second, layout.root)
    files, bronze = read_bronze(spark, layout, BRONZE_FILES), read_bronze(spark, layout)
    report = reports.bronze_report(spark, layout)
    columns = ["order_status", "product_category", "gender"]
    expected = {
        "rows": profile.row_counts({"bronze": bronze}),
        "unreadable values": unreadable_values(files),
        "partitions": profile.partition_profile(files),
        "ingestion dates": profile.partition_values(bronze, "ingestion_date"),
        "nulls": profile.null_profile(bronze),
        "values": profile.value_distribution(bronze, columns),
    }
    rows = lambda df: sorted(map(repr, df.collect()))
    for name, df in expected.items():
        assert report[name].schema.simpleString() == df.schema.simpleString(), name
        assert rows(report[name]) == rows(df) != [], name
        plan = report[name]._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" in plan and "transaction_id" not in plan, name
    one = profile.table_profile(bronze, columns, {})
    assert one._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    empty = profile.table_profile(bronze.limit(0), columns, {"x": F.col("city").isNull()})
    assert {(r.fact, r.subject, r.n) for r in empty.collect()} == {("rows", None, 0), ("count", "x", 0)}


def test_bronze_takes_one_scan_of_the_csv(spark, tmp_path, monkeypatch):
    layout, raw, scans = Layout(str(tmp_path / "out")), _csv(raw_frame(spark, {}, {}), tmp_path / "raw"), []
    monkeypatch.setattr(medallion, "read_raw", lambda *a, f=medallion.read_raw, **k: (scans.append(1), f(*a, **k))[1])
    ingest(spark, raw, layout)
    assert len(scans) == 1
    ingest(spark, raw, layout, check_counts=True)
    assert len(scans) == 3


def test_silver_report_reads_no_bronze(spark, two_inputs):
    layout, second = two_inputs
    run(spark, second, layout.root)
    report = reports.silver_report(spark, layout)
    for name, df in report.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "bronze" not in plan, name
    assert {r.rows: r.n for r in report["rows met"].collect()} == {"read": 4, "deduplicated": 4, "repeated_keys": 0}
    assert [r.rule for r in report["violations met"].collect()] == ["positive_quantity"]
    assert {r.gender: r.n for r in report["gender met"].collect()} == {"M": 4}


@pytest.fixture
def many_files(spark, tmp_path):
    lines = [{"product_id": f"PROD{n:03}", "quantity": n % 40 + 1} for n in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        medallion.write_marts(medallion.order_amounts(raw_frame(spark, *lines)), str(tmp_path / "gold"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return str(tmp_path / "gold")


def test_ranked_mart_comes_back_in_order_without_a_sort(spark, many_files):
    whole = ranked_products(spark, many_files)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    rows = whole.collect()
    assert len(rows) == 300 and rows == sorted(rows, key=lambda r: (-r.revenue, r.product_id))
    n_files = len(whole.inputFiles())
    assert n_files > 2
    for k in (1, 7, 299, 300, 1000):
        best = ranked_products(spark, many_files, k)
        assert best.collect() == rows[:k]
    assert len(ranked_products(spark, many_files, 7).inputFiles()) < n_files
    assert ranked_products(spark, many_files, 0).count() == 0


def test_ranks_of_the_published_mart(spark, two_inputs):
    layout, _ = two_inputs
    assert [r.product_id for r in read_top_products(spark, layout, 1).collect()] == ["PROD1"]
    remove(spark, layout.gold.log)
    with pytest.raises(FileNotFoundError):
        read_top_products(spark, layout)
