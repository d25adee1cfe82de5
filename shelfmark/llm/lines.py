"""Line deduplication over overlapping windows of consecutive lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.storage import fresh_path, stage

WINDOW_LINES = 3

# The white space that may differ between equal lines, at their ends.
_SPACES = " \t\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _windows(rows: DataFrame, size: int) -> DataFrame:
    """``(id, hash, at, w1, w2)``: 128 bits for each window of ``size`` lines, by its first line.

    Windows without a word in them are left out.
    """
    trimmed = F.transform(_lines(F.col("text")), lambda line: F.trim(line, F.lit(_SPACES)))
    starts = F.sequence(F.lit(0), F.size("lines") - size)

    def window(at: Column) -> Column:
        part = [F.get("lines", at + k) for k in range(size)]
        return F.struct(
            at.alias("at"),
            F.xxhash64(*part).alias("w1"),
            F.xxhash64(F.lit(size), *part[::-1]).alias("w2"),
            F.concat(*part).alias("all"),
        )

    found = rows.select("id", "hash", trimmed.alias("lines")).filter(F.size("lines") >= size)
    found = found.select("id", "hash", F.explode(F.transform(starts, window)).alias("w"))
    return found.filter("w.all <> ''").select("id", "hash", "w.at", "w.w1", "w.w2")


def repeated_runs(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """``(id, hash, runs)``: for each document that loses lines, ``(first, beyond)`` of every run.

    A window is judged by all documents: its first occurrence stays, by ``doc_id``, hash of the text
    and line. Positions of later ones are merged into maximal runs of lines.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), F.col("text").alias("text")
    )
    windows = stage(_windows(rows, size), fresh_path(spark, "line-windows"))
    place = F.struct("id", "hash", "at")
    firsts = windows.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    firsts = stage(firsts.filter("first < last").drop("last"), fresh_path(spark, "repeated-windows"))
    later = windows.join(firsts, ["w1", "w2"]).filter(place > F.col("first")).select("id", "hash", "at").distinct()
    by_line = Window.partitionBy("id", "hash").orderBy("at")
    opens = F.coalesce(F.col("at") > F.lag("at").over(by_line) + size, F.lit(True))
    numbered = later.withColumn("opens", opens).withColumn("run", F.count_if("opens").over(by_line))
    runs = numbered.groupBy("id", "hash", "run").agg(F.min("at").alias("first"), (F.max("at") + size).alias("beyond"))
    merged = runs.groupBy("id", "hash").agg(F.array_sort(F.collect_list(F.struct("first", "beyond"))).alias("runs"))
    return stage(merged, fresh_path(spark, "runs"))


def _without(lines: Column, runs: Column) -> Column:
    """The lines outside ``runs``, taken slice by slice."""
    begin = F.concat(F.array(F.lit(0)), runs["beyond"])
    end = F.concat(runs["first"], F.array(F.size(lines)))
    return F.flatten(F.zip_with(begin, end, lambda a, b: F.slice(lines, a + 1, b - a)))


def _marked(docs: DataFrame, size: int) -> DataFrame:
    """``(row, runs)`` per row of ``docs``."""
    runs = repeated_runs(docs, size)
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.withColumns({"row_id": F.col("row.doc_id").cast("long"), "row_hash": F.xxhash64("row.text")})
    same = F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_hash") == F.col("hash"))
    # the same plan at every size: the list of runs grows with the documents
    return rows.join(runs.hint("merge"), same, "left").select("row", "runs")


def dedupe_lines(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """``docs`` without the lines of repeated windows; all columns, ``n_chars`` counted anew.

    Lines are cut at line feeds and compared without white space at their ends. Where ``size``
    consecutive lines stand a second time, in any document, they go. Documents of fewer lines, null
    and empty texts stay as they are; a document may end up empty, none is dropped. A null id comes
    before all others. Rows that repeat an id and a text are one document and get the same result.
    Windows are grouped by hash with a partial minimum per task, so a line that a third of all rows
    hold is one row per task there; the text itself is shuffled once at most.
    """
    columns = docs.columns
    text = F.col("row.text")
    left = F.when(F.col("runs").isNull(), text).otherwise(F.array_join(_without(_lines(text), F.col("runs")), "\n"))
    out = _marked(docs, size).withColumn("left", left)
    changed = {"text": F.col("left")}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("runs").isNull(), F.col("row.n_chars")).otherwise(F.length("left").cast(kind))
    return out.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its lines, how many go and in how many runs, and the text left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    runs = F.coalesce(F.col("runs"), F.array().cast("array<struct<first:int,beyond:int>>"))
    removed = F.aggregate(runs, F.lit(0), lambda n, run: n + run["beyond"] - run["first"])
    lines = _lines(F.col("row.text"))
    left = F.when(F.size(runs) == 0, F.coalesce("row.text", F.lit(""))).otherwise(F.array_join(_without(lines, runs), "\n"))
    return _marked(docs, WINDOW_LINES).select(
        "row.doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed"),
        F.size(runs).cast("long").alias("n_runs"),
        left.alias("text"),
    )


OP3_SQL = rf"""
WITH lines AS (
  SELECT doc_id, raw, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line, pos FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), windows AS (
  SELECT doc_id, pos, count(*) OVER w AS n, [line, lead(line, 1) OVER d, lead(line, 2) OVER d] AS win
  FROM lines
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {WINDOW_LINES - 1} FOLLOWING),
         d AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
  SELECT doc_id, pos FROM windows
  WHERE n = {WINDOW_LINES} AND array_to_string(win, '') <> ''
  QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) > 1
), gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM later, range(0, {WINDOW_LINES}) AS r(k)
), marked AS (
  SELECT l.doc_id, l.pos, raw, g.pos IS NOT NULL AS gone FROM lines l LEFT JOIN gone g USING (doc_id, pos)
), opened AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM marked
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_runs,
  coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
FROM opened GROUP BY doc_id
"""
