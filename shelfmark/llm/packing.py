"""Sum-of-squares packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.storage import fresh_path, stage

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
# pieces that one task packs by itself; more pieces make more groups
GROUP_PIECES = 16_384
# words that a worker remembers; then it starts anew
CACHED_WORDS = 400_000

# lower-case forms of letters below this stay below it
_LATIN_END = 0x180


def _word_pattern() -> re.Pattern:
    """The tokenizer's own splitting, spelled out for texts of Latin letters."""
    letters, digits, spaces = "", "", "\t\n\x0b\x0c\r \x85\xa0"
    for code in range(_LATIN_END):
        kind = unicodedata.category(chr(code))[0]
        letters += re.escape(chr(code)) if kind == "L" else ""
        digits += re.escape(chr(code)) if kind == "N" else ""
    # The word rules of the tokenizer file.
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{spaces}{letters}{digits}]+")


class Encoder:
    """Ids of texts by a tokenizer file whose words are encoded one by one, as ``tokenizers`` gives them.

    Words of Latin texts are looked up among those met before; new ones are encoded together. Any
    other text, and one with special tokens, goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends_word[number] = token.endswith("</w>")
        self.words: dict[str, bytes] = {}
        self.pattern = _word_pattern()
        self.foreign = re.compile(f"[^\x00-{chr(_LATIN_END - 1)}]")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [None if self._foreign(text) else self.pattern.findall(text.lower()) for text in texts]
        if len(self.words) > CACHED_WORDS:
            self.words = {}
        new = set().union(*[set(words).difference(self.words) for words in split if words])
        if new:
            self._learn(sorted(new))
        known = self.words
        return [
            self._whole(text).tobytes() if words is None else b"".join([known[word] for word in words])
            for text, words in zip(texts, split, strict=True)
        ]

    def _foreign(self, text: str) -> bool:
        if "<|" in text:
            return True
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.foreign.search(text) is not None
        return False

    def _whole(self, text: str) -> np.ndarray:
        (encoding,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoding.ids, "<u4")

    def _learn(self, new: list[str]) -> None:
        ids = self._whole(" ".join(new))
        bounds = np.flatnonzero(self.ends_word[ids]) + 1
        if len(bounds) != len(new):
            raise ValueError("the tokenizer does not end every word with a token of its own")
        data, begin = ids.tobytes(), 0
        for word, end in zip(new, (4 * bounds).tolist(), strict=True):
            self.words[word] = data[begin:end]
            begin = end


def _together(column: pa.Array, chars: int = 1 << 19) -> Iterator[list[str]]:
    """The texts of a column, null ones empty, in lists of about so many characters."""
    texts, size = [], 0
    for text in column:
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= chars:
            yield texts
            texts, size = [], 0
    yield texts


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One for each worker process, whose tasks share the words it knows."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: documents as token ids, long ones cut.

    Each document ends with id 0. One of more than ``capacity`` ids is cut into pieces of that
    length, the last may be shorter. A null or empty text is its end alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer or tokenizer_path())
        end = np.array([END_ID], "<u4").tobytes()
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        for batch in batches:
            rows = []
            encoded = (x for texts in _together(batch.column(1)) for x in encoder.encode(texts))
            for doc_id, data in zip(batch.column(0).to_pylist(), encoded, strict=True):
                data += end
                for n, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append((doc_id, n, at // 4, len(part) // 4, zlib.crc32(part), part if ids else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)][: 5 + ids]
            yield pa.RecordBatch.from_arrays(arrays, names[: 5 + ids])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(cut, _PIECE + ", ids binary" * ids)


def place(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, in the order given.

    An item goes where the sum over all gaps of the squared number of open bins with that gap
    becomes smallest, a new bin among the choices; ties go to the fullest bin.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    counts = np.zeros(capacity + 1, np.int64)
    bins, offsets, made = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i, size in enumerate(lengths.tolist()):
        # by the gap left behind: from an open bin, or at the end from a new one
        rise = 2 * counts[: capacity - size + 1] + 1
        rise[0] = 0
        change = np.where(counts[size:] > 0, rise - 2 * counts[size:] + 1, 1 << 60)
        change[-1] = rise[-1]
        left = int(change.argmin())
        gap = left + size
        if gap == capacity:
            bins[i] = made
            made += 1
        else:
            bins[i] = open_bins[gap].pop()
            counts[gap] -= 1
            offsets[i] = capacity - gap
        if left:
            open_bins[left].append(int(bins[i]))
            counts[left] += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: no sequence holds more than ``capacity`` ids.

    Pieces are dealt into even groups by their place in the staged table, whatever their keys, and
    each group is packed by itself, long pieces first. A group's last, half-empty sequences are all
    that the split costs. ``pieces`` is read from files, so a task that runs again gets the same.
    """
    n = pieces.count()
    groups = max(1, -(-n // group_pieces))
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        bins, offsets = place(frame["length"].to_numpy(), capacity)
        group = int(frame["pack_group"].iloc[0])
        return frame.drop(columns="pack_group").assign(sequence_id=bins * groups + group, offset=offsets)

    return dealt.groupBy("pack_group").applyInPandas(packed, f"{_PIECE}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    Null and empty texts are one id long. A null id stays null, repeated rows are packed as often as
    they stand there, other columns are not read, an empty table gives no rows. Any length up to
    ``capacity`` may tie with others; equal pieces may swap places between runs on other partitions.
    """
    pieces = token_pieces(docs, tokenizer, capacity)
    return pack(stage(pieces, fresh_path(docs.sparkSession, "pieces")), capacity)


def sequences(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``(sequence_id, n_ids, doc_ids, ids)``: the packed sequences themselves, ids as 32-bit words."""
    spark = docs.sparkSession
    held = stage(token_pieces(docs, tokenizer, capacity, ids=True), fresh_path(spark, "piece-ids"))
    packed = pack(held.drop("ids"), capacity)
    places = packed.select("doc_id", "piece", "ids_crc32", "length", "sequence_id", "offset")
    key = [F.col(f"p.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ("doc_id", "piece", "ids_crc32", "length")]
    unique = held.dropDuplicates(["doc_id", "piece", "ids_crc32", "length"])
    joined = places.alias("p").join(unique.alias("h"), key[0] & key[1] & key[2] & key[3])
    parts = F.array_sort(F.collect_list(F.struct("p.offset", "p.doc_id", "h.ids")))
    grouped = joined.groupBy("sequence_id").agg(F.sum("p.length").alias("n_ids"), parts.alias("parts"))
    hexed = F.array_join(F.transform("parts.ids", F.hex), "")
    return grouped.select("sequence_id", "n_ids", F.col("parts.doc_id").alias("doc_ids"), F.unhex(hexed).alias("ids"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
