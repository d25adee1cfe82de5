from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.checks import schema_check, schema_report
from shelfmark.operators.clean import clean
from shelfmark.operators.profile import partition_values
from shelfmark.schemas import BRONZE, RAW, SILVER
from shelfmark.sources import (
    inferred_layer,
    read_layer,
    read_raw,
    with_ingest_metadata,
    write_bronze,
    write_mart,
    write_silver,
)
from tests.rows import CLEAN, raw_frame

HEADER = ",".join(RAW.names)
GOOD = "1,2024-05-10,2024-05-12,CUST1,30,M,PROD1,Sports,2,10.5,5,Dallas,TX,UPI,Delivered,2024-06-01"


def _csv(tmp_path, *lines, header=HEADER):
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_csv_keeps_bad_rows_with_nulls(spark, tmp_path):
    path = _csv(
        tmp_path,
        GOOD,
        GOOD.replace("1,", "x,", 1),
        GOOD.replace("2024-05-10", "10/05/2024"),
        "4,2024-05-10",
        GOOD + ",extra",
        GOOD.replace(",M,", ",,"),
        GOOD.replace(",M,", ", m ,"),
    )
    rows = read_raw(spark, path).collect()
    assert len(rows) == 7
    good = rows[0]
    assert good.unit_price == 10.5 and good.ingestion_date == date(2024, 6, 1)
    assert rows[1].transaction_id is None and rows[1].customer_id == "CUST1"
    assert rows[2].order_date is None
    assert rows[3].transaction_id == 4 and rows[3].ingestion_date is None
    assert rows[4] == good
    assert rows[5].gender is None and rows[6].gender == " m "


def test_csv_binds_by_position_unless_the_header_is_checked(spark, tmp_path):
    names = list(RAW.names)
    names[11], names[12] = names[12], names[11]
    path = _csv(tmp_path, GOOD, header=",".join(names))
    assert read_raw(spark, path).first().city == "Dallas"
    with pytest.raises(Exception, match="header"):
        read_raw(spark, path, check_header=True).collect()


def test_ingest_metadata_names_the_file(spark, tmp_path):
    row = with_ingest_metadata(read_raw(spark, _csv(tmp_path, GOOD))).first()
    assert row.source_file.endswith("/raw.csv") and row.ingested_at is not None


def test_equal_file_names_are_told_apart(spark, tmp_path):
    paths = []
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        paths.append(_csv(tmp_path / name, GOOD))
    rows = with_ingest_metadata(read_raw(spark, paths))
    assert rows.select("source_file").distinct().count() == 2


def test_bronze_dates_replaced_whole_or_one_by_one(spark, tmp_path):
    path, first, second = str(tmp_path / "bronze"), date(2024, 6, 1), date(2024, 6, 2)
    write_bronze(raw_frame(spark, {"ingestion_date": first}, {"ingestion_date": second}), path)
    changed = raw_frame(spark, {"ingestion_date": second, "city": "Reno"})
    write_bronze(changed, path, dynamic=True)
    bronze = read_layer(spark, path, BRONZE)
    assert bronze.schema == BRONZE
    assert {(r.ingestion_date, r.city) for r in bronze.collect()} == {
        (first, "Dallas"),
        (second, "Reno"),
    }
    write_bronze(changed, path, rebalance=True)
    dates = partition_values(read_layer(spark, path, BRONZE), "ingestion_date").collect()
    assert [r[0] for r in dates] == [second]


def test_null_partitions_come_back_typed(spark, tmp_path):
    path = str(tmp_path / "bronze")
    write_bronze(raw_frame(spark, {"ingestion_date": None}), path)
    layer = read_layer(spark, path, BRONZE)
    assert layer.schema == BRONZE
    assert layer.first().ingestion_date is None


def test_silver_null_status_survives(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(clean(raw_frame(spark, {"order_status": "Lost"}, {})), path)
    layer = read_layer(spark, path, SILVER)
    assert layer.schema == SILVER
    assert {r.order_status for r in layer.collect()} == {None, "Delivered"}


def test_empty_layer_is_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(clean(raw_frame(spark, {"quantity": 0})), path)
    layer = read_layer(spark, path, SILVER)
    assert layer.schema == SILVER and layer.count() == 0


def test_missing_column_raises(spark, tmp_path):
    path = str(tmp_path / "bronze")
    raw_frame(spark, {}).drop("city").write.parquet(path)
    with pytest.raises(ValueError, match="city"):
        read_layer(spark, path, BRONZE)


def test_other_type_fails_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    raw_frame(spark, {}).withColumn("quantity", F.lit("two")).write.parquet(path)
    with pytest.raises(Exception, match="quantity"):
        read_layer(spark, path, BRONZE).collect()


def test_schema_differences(spark, tmp_path):
    drifted = raw_frame(spark, {}).drop("city").withColumn("quantity", F.lit("2")).withColumn(
        "extra", F.lit(1)
    )
    found = {tuple(row) for row in schema_check(drifted, RAW).collect()}
    assert found == {("city", "string", None), ("quantity", "int", "string"), ("extra", None, "int")}
    report = schema_report(drifted, RAW).filter("NOT ok").select("column", "n_values").collect()
    assert {tuple(row) for row in report} == {("city", 0), ("quantity", 1), ("extra", 1)}
    assert schema_check(raw_frame(spark, CLEAN), RAW).count() == 0


def test_single_file_mart(spark, tmp_path):
    path = tmp_path / "mart"
    write_mart(raw_frame(spark, {}, {}, {}).repartition(3), str(path), single_file=True)
    assert len(list(path.glob("*.parquet"))) == 1
    assert len(inferred_layer(spark, str(path)).inputFiles()) == 1


def test_rebalance_splits_a_large_status(spark, tmp_path):
    path = tmp_path / "silver"
    text = F.sha2(F.col("id").cast("string"), 512)
    made = {"transaction_id": F.col("id").cast("int"), "city": text}
    many = spark.range(0, 40_000, 1, 8).select(
        *[made.get(f.name, F.lit(CLEAN[f.name])).cast(f.dataType).alias(f.name) for f in RAW]
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "256k")
    try:
        write_silver(clean(many), str(path))
    finally:
        spark.conf.unset(key)
    files = list((path / "order_status=Delivered").glob("*.parquet"))
    assert 1 < len(files) < 40
    assert read_layer(spark, str(path), SILVER).count() == 40_000
