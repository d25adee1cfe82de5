"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of what they meet."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.storage import fresh_path, stage

SEED_WORDS = 3
# a seed is rare if words drawn by their frequency in the corpus form it with at most this probability
RARE = 1e-7
# share of the best possible alignment score from which a passage is a copy
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
# tasks count only the items' words if there are at most so many, else all words
HELD_WORDS = 500_000
# size of the bitmap of seeds, 32 MiB
SLOT_BITS = 28
# items whose word places a task keeps ready
MASKS_HELD = 2_000

_WORD = re.compile(r"[^\W_]+")


# of the first 256 characters, those of words stay and the others part them
_PARTED = bytes(c if _WORD.fullmatch(chr(c)) else 0x20 for c in range(256))


def words(text: str | None) -> list[str]:
    """Words without case and punctuation, as alignment compares them."""
    lowered = (text or "").lower()
    try:
        # the same by table, for texts that have one
        return lowered.encode("latin-1").translate(_PARTED).decode("latin-1").split()
    except UnicodeEncodeError:
        return _WORD.findall(lowered)


class _Codes(dict):
    """64-bit numbers of words, kept for words met before."""

    HELD = 500_000

    def __missing__(self, word: str) -> int:
        code = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) - (1 << 63)
        return code

    def of(self, own: list[str]) -> np.ndarray:
        if len(self) > self.HELD:
            self.clear()
        return np.fromiter(map(self.__getitem__, own), np.int64, len(own))


def gram_keys(codes: np.ndarray, n: int) -> np.ndarray:
    """One number for each run of ``n`` words; collisions only bring candidates that alignment refuses."""
    count = max(0, len(codes) - n + 1)
    key = np.zeros(count, np.uint64)
    for j in range(n):
        key = (key * np.uint64(0x9E3779B97F4A7C15)) ^ codes[j : j + count].view(np.uint64)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def seed_places(counts: np.ndarray, total: int, rare: float, size: int) -> np.ndarray:
    """Where the rare n-grams of an item begin, or all of its n-grams if fewer than half are rare.

    ``counts`` says how often each of the item's words stands in the corpus; one that it lacks counts
    as one that occurs once.
    """
    n = min(size, len(counts))
    if not n:
        return np.zeros(0, np.int64)
    share = np.log(np.maximum(counts, 1) / max(total, 1))
    chances = np.lib.stride_tricks.sliding_window_view(share, n).sum(axis=1)
    seeds = np.flatnonzero(chances <= np.log(rare))
    # too few do not outlast edits; alignment refuses what all of them bring too much
    return seeds if 2 * len(seeds) >= len(chances) else np.arange(len(chances))


def word_masks(codes: np.ndarray) -> dict[int, int]:
    """The places of each word of an item, as bits."""
    places: dict[int, int] = {}
    for at, word in enumerate(codes.tolist()):
        places[word] = places.get(word, 0) | 1 << at
    return places


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment by words: its score, and first and last word of the passage in it.

    Smith-Waterman with linear gaps, row by row; the gap along a row is a running maximum.
    """
    n = len(passage)
    steps = np.arange(n + 1) * -GAP
    row = np.zeros(n + 1, np.int64)
    origin = np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = row[:-1] + np.where(passage == word, MATCH, MISMATCH)
        upper = row[1:] + GAP
        new, new_origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
        new[1:] = np.maximum(0, np.maximum(diagonal, upper))
        came = np.where(diagonal >= upper, origin[:-1], origin[1:])
        new_origin[1:] = np.where(new[1:] > 0, came, np.arange(1, n + 1))
        lifted = new + steps
        running = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == running, np.arange(n + 1), 0))
        row = running - steps
        origin = new_origin[source]
        top = int(row.argmax())
        if row[top] > best[0]:
            best = (int(row[top]), int(origin[top]), top - 1)
    return best


def _in_order(masks: dict[int, int], length: int, passage: list[int]) -> int:
    """Most words that an item and a passage share in the same order; a bit per word of the item."""
    open_bits = full = (1 << length) - 1
    for word in passage:
        mask = masks.get(word)
        if mask:
            taken = open_bits & mask
            open_bits = ((open_bits + taken) | (open_bits - taken)) & full
    return length - open_bits.bit_count()


def best_match(
    item: np.ndarray, masks: dict[int, int], codes: np.ndarray, starts: np.ndarray, min_score: float
) -> tuple[float, int, int] | None:
    """``(score, first, last)`` of the best alignment of an item around the places its seeds give.

    Every foreign word inside a copy costs a point, and all of an item's words give two each, so a
    copy that reaches the score lies within ``slack`` words around where its seed would put it.
    Passages that share too few words in order are not aligned: they cannot reach the score.
    """
    slack = int(MATCH * len(item) * (1 - min_score) / -GAP) + 1
    best = (0.0, 0, 0)
    # passages that overlap are aligned as one
    for group in np.split(starts, np.flatnonzero(np.diff(starts) > len(item) + 2 * slack) + 1):
        low = max(0, int(group[0]) - slack)
        passage = codes[low : int(group[-1]) + len(item) + slack]
        if _in_order(masks, len(item), passage.tolist()) < min_score * len(item):
            continue
        score, first, last = align(item, passage)
        share = score / (MATCH * len(item))
        if share > best[0]:
            best = (share, low + first, low + last)
    return best if best[0] >= min_score else None


def _batch(schema: str, kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    names = [part.split()[0] for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _items(benchmark: DataFrame) -> DataFrame:
    """``(item, words, codes)`` per different text of the benchmark that has words."""
    schema = "item long, words array<string>, codes array<long>"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for batch in batches:
            rows = []
            for item, text in zip(*batch.columns, strict=True):
                if own := words(text.as_py()):
                    rows.append((item.as_py(), own, codes.of(own)))
            yield _batch(schema, [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())], rows)

    texts = benchmark.select(F.xxhash64("text").alias("item"), "text").dropDuplicates(["item"])
    return stage(texts.mapInArrow(split, schema), fresh_path(benchmark.sparkSession, "items"))


def _corpus_counts(docs: DataFrame, items: DataFrame, held_words: int) -> tuple[DataFrame, int]:
    """``(code, n)``: how often words stand in all documents, those of the items at least; and all words' number.

    A task looks for the items' words if they are at most ``held_words``, else it counts all it meets.
    """
    vocabulary = items.select(F.explode("words").alias("word")).distinct()
    some = [row.word for row in vocabulary.limit(held_words + 1).collect()]
    wanted = frozenset(some) if len(some) <= held_words else None

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, found, total = _Codes(), Counter(), 0

        def out() -> pa.RecordBatch:
            numbers = pa.array([*map(codes.__getitem__, found), None], pa.int64())
            return pa.RecordBatch.from_arrays([numbers, pa.array([*found.values(), total], pa.int64())], ["code", "n"])

        for batch in batches:
            for text in batch.column(0):
                own = words(text.as_py())
                total += len(own)
                found.update(own if wanted is None else filter(wanted.__contains__, own))
                if len(found) > max(held_words, _Codes.HELD):
                    yield out()
                    codes, found, total = _Codes(), Counter(), 0
        yield out()

    rows = docs.select("text").mapInArrow(counted, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = stage(rows, fresh_path(docs.sparkSession, "word-counts"))
    total = counts.filter("code IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return counts.filter("code IS NOT NULL"), total


def _seeds(items: DataFrame, counts: DataFrame, total: int, rare: float, size: int) -> DataFrame:
    """``(key, item, place, n)``: the seeds of every item as keys of their n-grams."""
    schema = "key long, item long, place int, n int"

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, met in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                codes, numbers = (met.values.field(k).to_numpy(zero_copy_only=False) for k in (1, 2))
                n = min(size, len(codes))
                places = seed_places(numbers, total, rare, size)
                keys = gram_keys(codes, n)[places].tolist()
                rows += [(key, item, place, n) for key, place in zip(keys, places.tolist(), strict=True)]
            yield _batch(schema, [pa.int64(), pa.int64(), pa.int32(), pa.int32()], rows)

    placed = items.select("item", F.posexplode("codes").alias("place", "code")).join(counts, "code", "left")
    met = F.struct("place", "code", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
    rows = placed.groupBy("item").agg(F.array_sort(F.collect_list(met)).alias("met")).mapInArrow(chosen, schema)
    return stage(rows, fresh_path(items.sparkSession, "seeds"))


def _slots(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.uint64) >> np.uint64(64 - SLOT_BITS)


def _filled(seeds: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The bits that keys of seeds set among ``2 ** SLOT_BITS``, 64 a number: at most 32 MiB of them."""
    slot = F.shiftrightunsigned("key", 64 - SLOT_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    rows = seeds.select(F.shiftrightunsigned(slot, 6).alias("at"), bit.alias("bit"))
    table = rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    return table.column("at").to_numpy(), table.column("bits").to_numpy().view(np.uint64)


def _with_seeds(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Documents that may hold seeds, whole, with the keys and places of those n-grams."""
    schema = "uid long, doc_id long, text_hash long, text string, keys array<long>, places array<int>"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    lengths = sorted(row.n for row in seeds.select("n").distinct().collect())
    at, bits = _filled(seeds)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        held = np.zeros(1 << SLOT_BITS - 6, np.uint64)
        held[at] = bits
        for batch in batches:
            rows = []
            uids, ids, hashes, texts = batch.columns
            for i, text in enumerate(texts):
                numbers = codes.of(words(text.as_py()))
                keys, places = [], []
                for n in lengths:
                    own = gram_keys(numbers, n)
                    slots = _slots(own)
                    found = np.flatnonzero(held[slots >> np.uint64(6)] >> (slots & np.uint64(63)) & np.uint64(1))
                    keys.append(own[found])
                    places.append(found)
                if any(map(len, keys)):
                    row = uids[i].as_py(), ids[i].as_py(), hashes[i].as_py(), text.as_py()
                    rows.append((*row, np.concatenate(keys), np.concatenate(places)))
            yield _batch(schema, kinds, rows)

    named = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text_hash", "text")
    return stage(named.mapInArrow(gathered, schema), fresh_path(docs.sparkSession, "with-seeds"))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    min_score: float = MIN_SCORE,
    rare: float = RARE,
    seed_words: int = SEED_WORDS,
    held_words: int = HELD_WORDS,
) -> DataFrame:
    """``(doc_id, text_hash, item_id, score, first_word, last_word)``: passages that copy a test item.

    Seeds are the items' n-grams that are rare by the corpus's own word frequencies, which leaked
    passages hardly move, or all of an item's if fewer than half of them are rare. They are a table
    that is joined with the documents' n-grams. Wherever one stands in a document, the passage around
    it is aligned with the item; ``score`` is the share of the best possible score. The best passage
    of each document and item counts.

    A copy is found if one seed in it is whole; its score and place are then those of the alignment
    with the whole document. Copies without a whole seed are missed: the README has the recall.

    Documents are read twice, however many items there are: for word counts, and for n-grams. A task
    keeps the n-grams that a bitmap of the seeds' keys lets through, at most 32 MiB; a fuller bitmap
    only sends more of them to the join. Only texts with such n-grams are shuffled, once. Whole texts
    are read. A document's seeds are one row.

    Null and empty texts hold and match nothing; items without words are passed over; items or
    documents that repeat are reported by id (repeated items once). Rows without an id are reported
    with a null one. An empty table on either side gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").alias("text")
    )
    items = _items(benchmark)
    seeds = _seeds(items, *_corpus_counts(rows, items, held_words), rare, seed_words)
    texts = _with_seeds(rows, seeds)
    grams = texts.select("uid", F.explode(F.arrays_zip("keys", "places")).alias("gram"))
    grams = grams.select("uid", F.col("gram.keys").alias("key"), F.col("gram.places").alias("at"))
    hits = grams.join(seeds, "key").groupBy("uid", "item").agg(
        F.array_sort(F.collect_set(F.col("at") - F.col("place"))).alias("starts")
    )
    named = hits.join(items.select("item", "codes"), "item")
    lists = named.groupBy("uid").agg(F.collect_list(F.struct("item", "codes", "starts")).alias("hits"))
    lists = stage(lists, fresh_path(spark, "hits"))
    schema = "doc_id long, text_hash long, item long, score double, first_word long, last_word long"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, masks = _Codes(), {}
        for batch in batches:
            out = []
            ids, hashes, own, found = batch.columns
            for i, text in enumerate(own):
                numbers = codes.of(words(text.as_py()))
                for hit in found[i]:
                    item = hit["item"].as_py()
                    body, starts = (hit[k].values.to_numpy() for k in ("codes", "starts"))
                    if item not in masks:
                        if len(masks) >= MASKS_HELD:
                            masks.clear()
                        masks[item] = word_masks(body)
                    if best := best_match(body, masks[item], numbers, starts, min_score):
                        out.append((ids[i].as_py(), hashes[i].as_py(), item, *best))
            yield _batch(schema, kinds, out)

    held = texts.select("uid", "doc_id", "text_hash", "text").join(lists.hint("merge"), "uid")
    matched = held.select("doc_id", "text_hash", "text", "hits").mapInArrow(aligned, schema)
    names = benchmark.select(F.xxhash64("text").alias("item"), F.col("item_id").cast("long").alias("item_id")).distinct()
    result = matched.join(names, "item").select("doc_id", "text_hash", "item_id", "score", "first_word", "last_word")
    return stage(result, fresh_path(spark, "matches"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no copy of a test item; all columns of ``docs``."""
    leaks = contaminated(docs, benchmark).select(F.col("doc_id").alias("leak_id"), "text_hash").distinct()
    leaks = stage(leaks, fresh_path(docs.sparkSession, "leaks"))
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("leak_id")) & (F.xxhash64("row.text") == F.col("text_hash"))
    return rows.join(leaks.hint("merge"), same, "left_anti").select("row.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(docs, benchmark).select("doc_id", "item_id", "score", "first_word", "last_word")
