"""How jobs are sized, so that no task sorts more than it holds in memory."""

from contextlib import contextmanager
from pathlib import Path

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from checks.fixture import retail_raw
from shelfmark.plans import medallion
from shelfmark.plans.medallion import Layout, ingest, refine
from shelfmark.schemas import RAW
from shelfmark.session import (
    ADVISORY_BYTES,
    DICTIONARY_BYTES,
    JOINED_BYTES,
    LEAST_SCANS,
    OPEN_WRITERS,
    PARQUET_DICTIONARY,
    ROUNDS,
    SCAN_PARTITIONS,
    SCANNED_BYTES,
    SHUFFLED_PER_BYTE,
    SORTED_BYTES,
    even_joins,
    even_scans,
    job_partitions,
    sized_shuffles,
    small_dictionaries,
    unsorted_writes,
)
from shelfmark.sources import read_raw
from tests.rows import raw_frame

SMOKE = "/root/testdata/sf0.001"
GIB = 1 << 30


@pytest.mark.parametrize("read", [0, 100 << 20, 5 * GIB, 100 * GIB])
def test_a_task_sorts_what_fits_in_memory(read):
    assert SHUFFLED_PER_BYTE * read / job_partitions(read, 12) <= SORTED_BYTES


def test_very_large_jobs_have_larger_partitions():
    assert job_partitions(1 << 40) == 10_000
    assert job_partitions(10 << 40) == 51_200


def test_scans_are_sized_too(spark):
    with sized_shuffles(spark, spark.range(10)):
        assert spark.conf.get(SCAN_PARTITIONS) == str(SCANNED_BYTES)
    assert SCAN_PARTITIONS not in spark.conf.getAll
    spark.conf.set(SCAN_PARTITIONS, "1m")
    try:
        with sized_shuffles(spark, spark.range(10)):
            assert spark.conf.get(SCAN_PARTITIONS) == "1m"
    finally:
        spark.conf.unset(SCAN_PARTITIONS)


def test_layers_are_written_without_sorting_by_folder(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw_frame(spark, {}, {"order_status": "Returned"}).write.options(header=True).csv(str(raw))
    seen = []
    for name in ("write_bronze", "write_silver"):
        written = getattr(medallion, name)

        def spy(df, *a, written=written, **k):
            seen.append(spark.conf.get(OPEN_WRITERS))
            return written(df, *a, **k)

        monkeypatch.setattr(medallion, name, spy)
    layout = Layout(str(tmp_path / "out"))
    ingest(spark, str(raw), layout)
    refine(spark, layout)
    assert seen == ["16", "16"] and OPEN_WRITERS not in spark.conf.getAll


@pytest.mark.parametrize("folders", [1, 2, 16])
def test_more_folders_than_open_writers(spark, tmp_path, folders):
    rows = spark.range(1000).selectExpr("id", "id % 7 AS folder")
    with unsorted_writes(spark, folders):
        rows.coalesce(1).write.partitionBy("folder").parquet(str(tmp_path / "out"))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(found.collect()) == sorted(rows.collect())


def test_raw_files_are_bounded_and_read_back(spark, monkeypatch):
    monkeypatch.setattr(entry, "RECORDS_PER_FILE", 500)
    raw = retail_raw(spark, SMOKE)
    folder = Path(entry._csv(raw).removeprefix("file:"))
    files = list(folder.glob("*.csv.lz4"))
    assert len(files) >= raw.count() / 500
    found = read_raw(spark, str(folder), check_header=True).select(*RAW.names)
    assert sorted(map(str, found.collect())) == sorted(map(str, raw.collect()))


def test_all_jobs_of_a_run_are_sized(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw_frame(spark, {}, {"order_status": "Returned"}).write.options(header=True).csv(str(raw))
    seen = {}
    for name in ("write_silver", "write_marts"):
        written = getattr(medallion, name)

        def spy(*a, name=name, written=written, **k):
            seen[name] = spark.conf.get(SCAN_PARTITIONS)
            return written(*a, **k)

        monkeypatch.setattr(medallion, name, spy)
    audit = medallion.run(spark, str(raw), str(tmp_path / "out")).first()
    assert (audit.pipeline_status, audit.source_rows) == ("SUCCESS", 1)
    assert seen == dict.fromkeys(["write_silver", "write_marts"], str(SCANNED_BYTES))
    assert SCAN_PARTITIONS not in spark.conf.getAll and OPEN_WRITERS not in spark.conf.getAll


def _small_files(spark, path):
    """Five raw files per core, which Spark reads in one task a core."""
    n = 5 * spark.sparkContext.defaultParallelism
    raw = raw_frame(spark, *[{"transaction_id": k} for k in range(n)])
    raw.repartitionByRange(n, "transaction_id").write.options(header=True).csv(path)
    return n


def test_scans_take_several_rounds(spark, tmp_path, monkeypatch):
    raw, tasks = str(tmp_path / "raw"), []
    n, cores = _small_files(spark, raw), spark.sparkContext.defaultParallelism
    assert read_raw(spark, raw).rdd.getNumPartitions() <= cores
    for name in ("write_bronze", "write_silver"):
        written = getattr(medallion, name)

        def spy(df, *a, written=written, **k):
            tasks.append(spark.conf.get(LEAST_SCANS, None))
            if written.__name__ == "write_bronze":
                # an empty file weighs as much as opening it, so two share a task
                assert df.rdd.getNumPartitions() == n / 2 > 2 * cores
            return written(df, *a, **k)

        monkeypatch.setattr(medallion, name, spy)
    audit = medallion.run(spark, raw, str(tmp_path / "out")).first()
    assert (audit.pipeline_status, audit.source_rows) == ("SUCCESS", n)
    assert tasks == [str(ROUNDS * cores)] * 2
    assert LEAST_SCANS not in spark.conf.getAll


def test_a_chosen_number_of_scans_stays(spark):
    spark.conf.set(LEAST_SCANS, "3")
    try:
        with even_scans(spark):
            assert spark.conf.get(LEAST_SCANS) == "3"
    finally:
        spark.conf.unset(LEAST_SCANS)


def test_raw_text_is_written_in_even_tasks(spark, monkeypatch):
    seen = []

    @contextmanager
    def spy(session):
        seen.append((session.conf.get(ADVISORY_BYTES), session.conf.get(SCAN_PARTITIONS)))
        yield

    with even_joins(spark):
        expected = (spark.conf.get(ADVISORY_BYTES), spark.conf.get(SCAN_PARTITIONS))
    assert expected == (str(JOINED_BYTES), str(SCANNED_BYTES))
    monkeypatch.setattr(entry, "unsorted_writes", spy)
    entry._csv(retail_raw(spark, SMOKE))
    assert seen == [expected] and ADVISORY_BYTES not in spark.conf.getAll


def _dictionary_sizes(root, column):
    """Bytes of the dictionary of a column's chunk in each Parquet file below a folder, 0 where it has none."""
    sizes = []
    for path in root.rglob("*.parquet"):
        if path.is_file():
            group = pq.ParquetFile(path).metadata.row_group(0)
            (chunk,) = (group.column(n) for n in range(group.num_columns) if group.column(n).path_in_schema == column)
            start = chunk.dictionary_page_offset
            sizes.append(chunk.data_page_offset - start if start else 0)
    return sizes


def test_columns_of_many_values_give_up_their_dictionary(spark, tmp_path):
    raw = str(tmp_path / "raw")
    n = 60_000
    # every key twice: a dictionary of them all is smaller than the values, and Parquet would keep it
    rows = raw_frame(spark, {}).drop("transaction_id", "customer_id").crossJoin(spark.range(0, n, 1, 1))
    rows = rows.selectExpr("CAST(id DIV 2 AS INT) AS transaction_id", "concat('CUST', id DIV 2) AS customer_id", "*")
    rows.select(*RAW.names).write.options(header=True).csv(raw)
    audit = medallion.run(spark, raw, str(tmp_path / "out")).first()
    assert (audit.pipeline_status, audit.source_rows) == ("SUCCESS", n / 2)
    sizes = _dictionary_sizes(tmp_path / "out" / "bronze", "customer_id")
    # a page header comes on top
    assert sizes and max(sizes) <= DICTIONARY_BYTES + 1024
    assert PARQUET_DICTIONARY not in spark.conf.getAll


def test_a_chosen_dictionary_size_stays(spark):
    spark.conf.set(PARQUET_DICTIONARY, "4096")
    try:
        with small_dictionaries(spark):
            assert spark.conf.get(PARQUET_DICTIONARY) == "4096"
    finally:
        spark.conf.unset(PARQUET_DICTIONARY)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set(PARQUET_DICTIONARY, "4096")
    try:
        with small_dictionaries(spark):
            assert PARQUET_DICTIONARY not in spark.conf.getAll
    finally:
        hadoop.unset(PARQUET_DICTIONARY)
