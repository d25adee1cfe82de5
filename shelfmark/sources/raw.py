"""The raw CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.schemas import RAW, TEXT

# stands in the ledger for a line with too few or too many fields
FIELDS = "(fields)"


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = RAW,
    check_header: bool = False,
    ledger: bool = False,
) -> DataFrame:
    """Scan CSV under a declared schema; no inference pass over the data.

    Columns bind by position and unreadable values become NULL. ``check_header=True`` fails on a
    file whose header names or orders the columns differently, instead of reading it wrongly.
    Lines are records (no multi-line fields), so large files split across tasks.

    ``ledger`` adds ``unreadable``, the names of the columns whose text could not be read, and
    ``raw_record``, the line as it came; both are NULL in rows that were read whole. They come from
    the same pass: the parser hands on the lines it could not read, and only these are split again.
    """
    options = {"header": True, "enforceSchema": not check_header}
    if not ledger:
        return spark.read.schema(schema).options(**options).csv(path)
    wider = StructType([*schema]).add("raw_record", TEXT)
    rows = spark.read.schema(wider).options(**options, columnNameOfCorruptRecord="raw_record").csv(path)
    return rows.withColumn("unreadable", _unreadable(schema.names)).select(*schema.names, "unreadable", "raw_record")


def _unreadable(names: list[str]) -> Column:
    as_text = StructType([]).add("_line", TEXT)
    for n, _ in enumerate(names):
        as_text = as_text.add(f"_{n}", TEXT)
    texts = F.from_csv("raw_record", as_text.simpleString()[7:-1].replace(":", " "), {"columnNameOfCorruptRecord": "_line"})

    def lost(text: Column) -> Column:
        columns = [F.when(text[f"_{n}"].isNotNull() & F.col(name).isNull(), F.lit(name)) for n, name in enumerate(names)]
        # as text every field can be read, so what fails now is the number of fields
        return F.array_compact(F.array(*columns, F.when(text["_line"].isNotNull(), F.lit(FIELDS))))

    # one parse per line, however many columns look at it
    return F.when(F.col("raw_record").isNotNull(), F.transform(F.array(texts), lost)[0])


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """Add the whole path of the file each row came from and the time of the run. ``df`` must be a file scan."""
    return df.withColumns(
        {"source_file": F.col("_metadata.file_path"), "ingested_at": F.current_timestamp()}
    )


def unreadable_values(bronze: DataFrame, schema: StructType = RAW) -> DataFrame:
    """(column, n_values) of what the parser could not read, 0 included, from one pass over the ledger.

    The entry ``(fields)`` counts lines with too few or too many fields.
    """
    names = [*schema.names, FIELDS]
    counts = bronze.agg(*[F.count_if(F.array_contains("unreadable", F.lit(c))).alias(c) for c in names])
    return counts.unpivot([], [F.col(f"`{c}`") for c in names], "column", "n_values")
