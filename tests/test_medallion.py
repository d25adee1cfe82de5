from contextlib import contextmanager
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.fixture import retail_raw
from shelfmark.__main__ import execute, parse
from shelfmark.operators.audit import audit_metadata
from shelfmark.operators.checks import count_reconciliation, mart_profile, silver_invariants
from shelfmark.operators.clean import clean
from shelfmark.operators.dedupe import dedupe
from shelfmark.operators.marts import mart_totals, marts_from_totals, order_amounts
from shelfmark.operators.rules import judge
from shelfmark.plans import medallion
from shelfmark.plans.medallion import (
    CheckFailed,
    Layout,
    ingest,
    publish,
    read_bronze,
    read_marts,
    read_silver,
    refine,
    run,
    write_marts,
)
from shelfmark.schemas import MARTS, SILVER
from shelfmark.session import SHUFFLE_PARTITIONS, planned_bytes, shuffle_partitions, sized_shuffles
from shelfmark.sources import read_layer, write_silver
from shelfmark.storage import fresh_path, release, shared_dir, stage
from tests.conftest import SF_DIR
from tests.rows import raw_frame


def _rows(df):
    return sorted(map(str, df.collect()))


def _csv(df, path):
    df.write.options(header=True).csv(str(path))
    return str(path)


def _files(root):
    """Everything below a folder that readers may see."""
    return {path: path.read_bytes() for path in sorted(root.rglob("*")) if path.is_file()}


def _hot(spark):
    """3,000 lines of which a third share one transaction and all share day, city and product."""
    changes = [
        {
            "transaction_id": 1 if n % 3 == 0 else n,
            "quantity": n % 50,
            "ingestion_date": date(2024, 1, 1) + timedelta(n % 5),
        }
        for n in range(3000)
    ]
    return raw_frame(spark, *changes), changes


def test_hot_key_keeps_the_same_survivor(spark):
    df, changes = _hot(spark)
    hot = [c for c in changes if c["transaction_id"] == 1]
    newest = max(c["ingestion_date"] for c in hot)
    expected = min(c["quantity"] for c in hot if c["ingestion_date"] == newest)
    survivors = dedupe(df.repartition(16)).filter("transaction_id = 1").collect()
    assert [(r.quantity, r.ingestion_date) for r in survivors] == [(expected, newest)]


def test_result_does_not_depend_on_partitioning(spark):
    raw = retail_raw(spark, "/root/testdata/sf0.001")
    other = raw.repartition(7).sortWithinPartitions(F.desc("unit_price"))
    ours, theirs = (clean(df, processed_at=False) for df in (raw, other))
    assert _rows(ours) == _rows(theirs)


def test_marts_from_totals_equal_single_marts(spark):
    amounts = order_amounts(clean(retail_raw(spark, "/root/testdata/sf0.001"))).cache()
    single = {
        "daily_sales_metrics": entry.daily_sales,
        "product_category_performance": entry.category_performance,
        "city_revenue_metrics": entry.city_revenue,
        "monthly_sales_metrics": entry.monthly_sales,
        "top_products": entry.top_products,
    }
    for name, mart in marts_from_totals(mart_totals(amounts)).items():
        assert _rows(mart) == _rows(single[name](amounts)), name
        assert mart.schema.simpleString() == MARTS[name].simpleString()
    amounts.unpersist()


def test_null_keys_form_their_own_mart_rows(spark):
    silver = raw_frame(spark, {"order_date": None, "product_id": None, "city": None}, {})
    marts = marts_from_totals(mart_totals(order_amounts(silver)))
    assert {r.order_date for r in marts["daily_sales_metrics"].collect()} == {
        None,
        date(2024, 5, 10),
    }
    assert {r.year_month for r in marts["monthly_sales_metrics"].collect()} == {None, "2024-05"}
    assert {r.city for r in marts["city_revenue_metrics"].collect()} == {None, "Dallas"}
    assert {r.product_id for r in marts["top_products"].collect()} == {None, "PROD1"}


def test_run_on_csv(spark, tmp_path):
    df, _ = _hot(spark)
    (audit,) = run(spark, _csv(df, tmp_path / "raw"), str(tmp_path / "out")).collect()
    layout = Layout(str(tmp_path / "out"))
    silver = read_silver(spark, layout)
    assert audit.pipeline_status == "SUCCESS"
    assert audit.source_rows == silver.count()
    assert (audit.daily_sales_rows, audit.monthly_sales_rows, audit.top_products_rows) == (1, 1, 1)
    top = read_marts(spark, layout)["top_products"].first()
    assert top.units_sold == silver.agg(F.sum("quantity")).first()[0]


def test_top_products_files_are_globally_sorted(spark, tmp_path):
    lines = [{"product_id": f"PROD{n:03}", "quantity": n % 40 + 1} for n in range(200)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_marts(order_amounts(raw_frame(spark, *lines)), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "top_products.parquet").glob("*.parquet"))
    rows = [row for f in files for row in spark.read.parquet(str(f)).collect()]
    assert len(files) > 1 and len(rows) == 200
    assert rows == sorted(rows, key=lambda r: (-r.revenue, r.product_id))


def test_totals_do_not_stay_cached(spark, tmp_path):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    write_marts(order_amounts(raw_frame(spark, {})), str(tmp_path))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_rerun_replaces_all_layers(spark, tmp_path):
    root, layout = str(tmp_path / "out"), Layout(str(tmp_path / "out"))
    run(spark, _csv(raw_frame(spark, {}, {}), tmp_path / "a"), root)
    run(spark, _csv(raw_frame(spark, {}), tmp_path / "b"), root, origin=True, check_header=True)
    assert read_silver(spark, layout).count() == 1


def _shared(spark):
    return set(Path(shared_dir(spark)).iterdir())


def test_nothing_stays_in_the_shared_folder(spark, tmp_path, monkeypatch):
    before = _shared(spark)
    raw = _csv(raw_frame(spark, {}, {"quantity": 0}), tmp_path / "raw")
    for root in (str(tmp_path / "out"), str(tmp_path / "out") + "/"):
        run(spark, raw, root, check_counts=True)
    assert refine(spark, Layout(str(tmp_path / "out"))).count() > 0
    assert _shared(spark) == before
    monkeypatch.setattr(medallion, "write_silver", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refine(spark, Layout(str(tmp_path / "out")))
    assert _shared(spark) == before
    path = fresh_path(spark, "kept")
    raw_frame(spark, {}).write.parquet(path)
    release(spark)
    assert not Path(path).exists()


def test_lost_raw_rows_fail_the_bronze_job(spark, tmp_path, monkeypatch):
    raw = _csv(raw_frame(spark, {}, {}, {}), tmp_path / "raw")
    layout, write = Layout(str(tmp_path / "out")), medallion.write_bronze
    for dynamic in (False, True):
        for check_counts in (False, True):
            ingest(spark, raw, layout, check_counts=check_counts, dynamic=dynamic)
            good = _files(tmp_path / "out")
            lost = lambda df, *a, **k: write(df.filter("transaction_id <> 2"), *a, **k)
            monkeypatch.setattr(medallion, "write_bronze", lost)
            with pytest.raises(CheckFailed, match="raw and bronze"):
                ingest(spark, raw, layout, check_counts=check_counts, dynamic=dynamic)
            monkeypatch.setattr(medallion, "write_bronze", write)
            assert _files(tmp_path / "out") == good and read_bronze(spark, layout).count() == 3


def test_long_lists_of_failures_are_counted(spark):
    with pytest.raises(CheckFailed, match="and 15 more"):
        medallion.require_empty(spark.range(35), "numbers")


def test_nothing_delivered_is_not_a_success(spark, tmp_path):
    raw = _csv(raw_frame(spark, {"order_status": "Returned"}), tmp_path / "raw")
    (audit,) = run(spark, raw, str(tmp_path / "out")).collect()
    assert audit.pipeline_status == "EMPTY"
    assert (audit.source_rows, audit.daily_sales_rows, audit.top_products_rows) == (0, 0, 0)


def test_empty_silver_gives_empty_marts(spark, tmp_path):
    raw = _csv(raw_frame(spark, {"quantity": 0}), tmp_path / "raw")
    (audit,) = run(spark, raw, str(tmp_path / "out")).collect()
    assert (audit.pipeline_status, audit.source_rows) == ("EMPTY", 0)


def test_missing_mart_rows_fail(spark):
    amounts = order_amounts(raw_frame(spark, {}, {"city": "Reno"}))
    marts = marts_from_totals(mart_totals(amounts))
    assert mart_profile(amounts, marts).filter("NOT ok").count() == 0
    broken = {**marts, "city_revenue_metrics": marts["city_revenue_metrics"].limit(1)}
    bad = mart_profile(amounts, broken).filter("NOT ok").collect()
    assert [row.mart for row in bad] == ["city_revenue_metrics"]
    empty = {**marts, "top_products": marts["top_products"].limit(0)}
    assert [r.mart for r in mart_profile(amounts, empty).filter("NOT ok").collect()] == [
        "top_products"
    ]
    assert audit_metadata(amounts, empty).first().pipeline_status == "FAILED"


def test_incomplete_mart_fails_the_gold_job(spark, tmp_path, monkeypatch):
    layout = Layout(str(tmp_path / "out"))
    ingest(spark, _csv(raw_frame(spark, {}, {"city": "Reno"}), tmp_path / "raw"), layout)
    refine(spark, layout)
    publish(spark, layout)
    good = _files(tmp_path / "out")
    whole = medallion.marts_from_totals

    def broken(totals):
        marts = whole(totals)
        return {**marts, "city_revenue_metrics": marts["city_revenue_metrics"].limit(1)}

    monkeypatch.setattr(medallion, "marts_from_totals", broken)
    with pytest.raises(CheckFailed, match="city_revenue_metrics"):
        publish(spark, layout)
    assert _files(tmp_path / "out") == good
    assert publish(spark, layout, check=False).first().pipeline_status == "FAILED"


def test_invariants_see_dirty_rows_and_repeated_keys(spark):
    dirty = raw_frame(spark, {"transaction_id": 1}, {"transaction_id": 1, "gender": "male"})
    found = {r.invariant: r.violations for r in silver_invariants(dirty).collect()}
    assert found["gender_code"] == 1 and found["transaction_id_unique"] == 1
    assert sum(found.values()) == 2


def test_small_values_are_clean(spark):
    rows = raw_frame(spark, {"unit_price": 0.00001}, {"discount_pct": 99.99999}, {"unit_price": 1e11})
    silver = clean(rows)
    assert silver_invariants(silver).filter("violations > 0").count() == 0
    amounts = {r.transaction_id: r.total_amount for r in order_amounts(silver).collect()}
    assert amounts == {1: 0, 2: 0, 3: 18 * 10**10}
    negative = raw_frame(spark, {"unit_price": -0.5})
    found = silver_invariants(negative).filter("violations > 0").collect()
    assert [r.invariant for r in found] == ["positive_price"]


def test_reconciliation_sees_a_lost_row(spark):
    bronze = raw_frame(spark, {}, {"transaction_id": 1}, {"quantity": 0}, {"customer_id": None})
    judged, silver = judge(dedupe(bronze)), clean(bronze)
    entries = {r.entry: r.n_rows for r in count_reconciliation(bronze, judged, silver).collect()}
    assert entries == {
        "bronze": 4,
        "duplicates": -1,
        "drop:transaction_id_present": 0,
        "drop:customer_id_present": -1,
        "drop:active_category": 0,
        "drop:positive_quantity": -1,
        "silver": -1,
        "difference": 0,
    }
    lost = count_reconciliation(bronze, judged, silver.limit(0)).filter("entry = 'difference'")
    assert lost.first().n_rows == 1


def test_failed_check_stops_the_run(spark, tmp_path, monkeypatch):
    layout = Layout(str(tmp_path / "out"))
    ingest(spark, _csv(raw_frame(spark, {}, {}), tmp_path / "raw"), layout)
    refine(spark, layout)
    good = _files(tmp_path / "out")
    monkeypatch.setattr(medallion, "accepted", lambda settled: settled.limit(1).drop("fired"))
    with pytest.raises(CheckFailed, match="difference"):
        refine(spark, layout)
    assert _files(tmp_path / "out") == good
    assert read_silver(spark, layout).count() == 2


def test_jobs_by_command_line(spark, tmp_path, capsys):
    raw = _csv(raw_frame(spark, {}, {"quantity": 0}), tmp_path / "raw")
    root = str(tmp_path / "out")
    for argv in (
        ["bronze", "--raw", raw, "--root", root],
        ["silver", "--root", root, "--origin"],
        ["gold", "--root", root],
        ["versions", "--root", root],
        ["vacuum", "--root", root, "--drafts"],
        *[["inspect", "--root", root, "--layer", x] for x in ("bronze", "silver", "gold")],
    ):
        execute(spark, parse(argv))
    shown = capsys.readouterr().out
    assert "positive_quantity" in shown and "SUCCESS" in shown and "-- audit" in shown
    assert publish(spark, Layout(root)).first().source_rows == 1


def test_command_line_refuses_incomplete_jobs():
    for argv in (["run", "--root", "x"], ["inspect", "--root", "x"], ["bronze", "--root", "x"]):
        with pytest.raises(SystemExit):
            parse(argv)


def test_shuffles_follow_the_input_size(spark, tmp_path):
    nation = spark.read.parquet(f"{SF_DIR}/nation.parquet")
    assert planned_bytes(nation) == Path(f"{SF_DIR}/nation.parquet").stat().st_size
    assert shuffle_partitions(0) == 1 and shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(10 * 2**40) == 51_200
    assert shuffle_partitions(100 * 2**40) == 512_000


def test_a_chosen_number_of_partitions_stays(spark, monkeypatch):
    table = spark.range(10)
    with sized_shuffles(spark, table):
        assert spark.conf.get(SHUFFLE_PARTITIONS) == "8"
    spark.conf.unset(SHUFFLE_PARTITIONS)
    try:
        if SHUFFLE_PARTITIONS not in spark.conf.getAll:
            monkeypatch.setattr(medallion, "write_silver", lambda *a, **k: None)
            with sized_shuffles(spark, table):
                assert spark.conf.get(SHUFFLE_PARTITIONS) == str(spark.sparkContext.defaultParallelism)
            assert SHUFFLE_PARTITIONS not in spark.conf.getAll
        spark.conf.set(SHUFFLE_PARTITIONS, 200)
        with sized_shuffles(spark, table):
            assert spark.conf.get(SHUFFLE_PARTITIONS) == "200"
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, 8)


def test_jobs_size_their_shuffles(spark, tmp_path, monkeypatch):
    seen = []

    @contextmanager
    def spy(_, df):
        seen.append(planned_bytes(df))
        yield

    monkeypatch.setattr(medallion, "sized_shuffles", spy)
    run(spark, _csv(raw_frame(spark, {}), tmp_path / "raw"), str(tmp_path / "out"))
    assert len(seen) == 2 and min(seen) > 0


def test_silver_is_written_without_a_shuffle(spark, tmp_path):
    staged = stage(clean(raw_frame(spark, {}, {})), str(tmp_path / "staged"))
    seen = []

    class Frame:
        def __init__(self, df):
            self.df = df

        def hint(self, *a):
            seen.append(a)
            return Frame(self.df.hint(*a))

        @property
        def write(self):
            return self.df.write

    write_silver(Frame(staged), str(tmp_path / "plain"))
    assert not seen and "Exchange" not in staged._jdf.queryExecution().executedPlan().toString()
    write_silver(Frame(staged), str(tmp_path / "even"), rebalance=True)
    assert seen == [("rebalance", "order_status")]
    plain, even = (read_layer(spark, str(tmp_path / x), SILVER) for x in ("plain", "even"))
    assert _rows(plain) == _rows(even)
