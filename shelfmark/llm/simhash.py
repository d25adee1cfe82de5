"""SimHash near duplicates: a grid over segment bit counts finds candidates, exact bits decide."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.graph import connected_components
from shelfmark.storage import fresh_path, stage

SHINGLE_WORDS = 3
MAX_BITS = 2
# more blocks make cells more selective and rows in cells more numerous: C(blocks, max_bits) each
EXTRA_BLOCKS = 4
# cells with more fingerprints than this are linked through midpoints instead of pairs
PAIRED_CELL = 64
SEED = 42

SEGMENTS = 32
_LOW = 0x5555555555555555


def simhash(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of the whole text, A-Z lowered; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle_words + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    first, last = (ends - lengths)[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[i:j], SEED) for i, j in zip(first, last, strict=True)])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(n, 8), axis=1)
    votes = bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``(doc_id, text_hash, fp)`` per row of ``docs``; ``fp`` holds the 64 bits as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            prints = [simhash(text.as_py(), shingle_words) for text in texts]
            signed = pa.array(np.array(prints, np.uint64).view(np.int64))
            columns = [batch.column(0), batch.column(1), signed]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    )
    return rows.mapInArrow(hashed, "doc_id long, text_hash long, fp long")


def segment_counts(fp: Column) -> Column:
    """The embedding: bits set in each of 32 two-bit segments, two bits a count."""
    upper = F.shiftrightunsigned(fp, 1)
    both = F.shiftleft(fp.bitwiseAND(upper).bitwiseAND(F.lit(_LOW)), 1)
    return both.bitwiseOR(fp.bitwiseXOR(upper).bitwiseAND(F.lit(_LOW)))


def manhattan(a: Column, b: Column) -> Column:
    """Distance of two embeddings. It never exceeds the number of differing bits."""
    differing = a.bitwiseXOR(b)
    low = differing.bitwiseAND(F.lit(_LOW))
    high = F.shiftrightunsigned(differing, 1).bitwiseAND(F.lit(_LOW))
    return F.bit_count(low) + 2 * F.bit_count(high.bitwiseAND(F.bitwise_not(low)))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def grid_masks(max_bits: int, blocks: int) -> list[int]:
    """Masks over the embedding, one for each choice of ``blocks - max_bits`` blocks of segments.

    Embeddings within Manhattan distance ``max_bits`` differ in at most that many blocks, so they
    agree in all others: they share a cell under at least one mask.
    """
    bounds = np.linspace(0, SEGMENTS, blocks + 1).round().astype(int)
    masks = [
        sum(3 << 2 * s for s in range(i, j)) for i, j in zip(bounds, bounds[1:], strict=False)
    ]
    return [_signed(sum(kept)) for kept in combinations(masks, blocks - max_bits)]


def links(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the distinct ``fp`` within ``max_bits`` bits of a chain.

    Cells with up to ``PAIRED_CELL`` fingerprints are paired, bounded by Manhattan distance and
    verified bit by bit. Larger cells go through midpoints: fingerprints meet at every value about
    half ``max_bits`` away and are linked to the nearest one there, which stays linear in their
    number and loses no connection.
    """
    blocks = blocks or max_bits + EXTRA_BLOCKS
    spark = prints.sparkSession
    embedded = prints.select("fp", segment_counts(F.col("fp")).alias("e"))
    cells = embedded.select(
        "fp",
        F.posexplode(
            F.array(*[F.col("e").bitwiseAND(F.lit(m)) for m in grid_masks(max_bits, blocks)])
        ).alias("mask", "cell"),
    )
    shared = cells.groupBy("mask", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
    )
    shared = stage(shared.filter("n > 1"), fresh_path(spark, "cells"))
    larger = stage(
        cells.join(shared.filter("n > 2").select("mask", "cell", "n"), ["mask", "cell"]),
        fresh_path(spark, "larger-cells"),
    )
    members = (
        larger.filter(F.col("n") <= PAIRED_CELL)
        .groupBy("mask", "cell")
        .agg(F.collect_list("fp").alias("members"))
        .select(F.explode("members").alias("a"), "members")
        .select("a", F.explode("members").alias("b"))
        .filter("a < b")
    )
    pairs = shared.filter("n = 2").select("a", "b").unionByName(members).distinct()
    a, b = F.col("a"), F.col("b")
    near = manhattan(segment_counts(a), segment_counts(b)) <= max_bits
    verified = pairs.filter(near).filter(F.bit_count(a.bitwiseXOR(b)) <= max_bits)
    crowded = larger.filter(F.col("n") > PAIRED_CELL).select("fp").distinct()
    return verified.unionByName(_midpoint_links(crowded, max_bits))


def _midpoint_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Of two values up to ``max_bits`` apart, some midpoint lies half as far from either.

    At each midpoint all link to its nearest value, if both distances together stay within
    ``max_bits``; that is never more than the midpoint's own neighbourhood.
    """
    radius = -(-max_bits // 2)
    flips = [
        (_signed(sum(1 << i for i in bits)), size)
        for size in range(radius + 1)
        for bits in combinations(range(64), size)
    ]
    steps = [F.struct(F.lit(flip).alias("flip"), F.lit(size).alias("away")) for flip, size in flips]
    met = prints.select("fp", F.explode(F.array(*steps)).alias("x"))
    met = met.select(
        F.col("fp").bitwiseXOR(F.col("x.flip")).alias("mid"),
        F.struct(F.col("x.away").alias("away"), F.col("fp").alias("fp")).alias("at"),
    )
    around = met.groupBy("mid").agg(F.min("at").alias("hub"), F.collect_list("at").alias("all"))
    return (
        around.filter(F.size("all") > 1)
        .select("hub", F.explode("all").alias("at"))
        .filter((F.col("at.fp") != F.col("hub.fp")) & (F.col("at.away") + F.col("hub.away") <= max_bits))
        .selectExpr("hub.fp AS a", "at.fp AS b")
        .distinct()
    )


def _components(
    docs: DataFrame, id_col: str, text_col: str, shingle_words: int, max_bits: int
) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of the rows, and ``(fp, root)`` of all distinct fingerprints."""
    spark = docs.sparkSession
    prints = stage(fingerprints(docs, id_col, text_col, shingle_words), fresh_path(spark, "prints"))
    distinct = stage(prints.select("fp").distinct(), fresh_path(spark, "distinct-prints"))
    linked = connected_components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    roots = distinct.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return prints, stage(roots, fresh_path(spark, "roots"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``(doc_id, fp, fingerprint, component_id)`` per row of ``docs``.

    Rows are linked if their fingerprints differ in at most ``max_bits`` bits; ``component_id`` is
    the smallest ``doc_id`` reachable. Equal fingerprints are one node from the start, so a hot
    group of copies is a partial minimum per task.

    A null or empty text has the fingerprint zero and is linked like any other. Rows without an id
    link others and take part; a component of such rows only has a null id. Repeated rows come out
    as often as they went in. Other columns are not read. An empty table gives no rows.
    """
    prints, roots = _components(docs, id_col, text_col, shingle_words, max_bits)
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")).join(roots, "fp")
    least = firsts.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = roots.join(least, "root").select("fp", "component_id")
    ids = stage(ids, fresh_path(docs.sparkSession, "component-ids"))
    return prints.join(ids, "fp").select(
        "doc_id",
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, with all columns of ``docs``.

    The row with the component's smallest ``doc_id`` stays; rows without an id come last, ties go to
    the smallest hash of the text, and of equal rows one stays. Only ids, hashes and fingerprints
    are grouped; texts are joined once with the ids that stay.
    """
    prints, roots = _components(docs, "doc_id", "text", shingle_words, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    best = prints.join(roots, "fp").groupBy("root").agg(F.min(order).alias("best"))
    best = stage(best.select("best.*"), fresh_path(docs.sparkSession, "kept-ids"))
    # keys without nulls: the join and what follows share one partitioning
    named = {"unnamed": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", F.lit(0).cast("long"))}
    key = ["unnamed", "doc_id", "text_hash"]
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.withColumns({"doc_id": F.col("row.doc_id").cast("long"), "text_hash": F.xxhash64("row.text")})
    held = rows.withColumns(named).join(best.withColumns(named).hint("merge"), key)
    return held.dropDuplicates(key).select("row.*")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "fingerprint", "component_id")
