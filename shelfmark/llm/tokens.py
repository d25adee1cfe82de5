"""Token counts of whole texts: byte pair encoding as merges on ragged arrays, many words at a time."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.packing import _LATIN_END, CACHED_WORDS, _word_pattern, tokenizer_path

LIMIT = 2048
# longer words are merged rank by rank over position lists, whose work does not repeat in every round
LONG_WORD = 4096
# characters that one call merges or splits at a time
CHUNK = 1 << 19

_NONE = np.iinfo(np.int64).max
# The word rules for which Latin texts may be split without the library.
_LATIN_RULES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> list[str]:
    """The character by which vocabulary files write each byte: printable ones stand for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (chr(256 + n) for n in range(256))
    return [chr(b) if b in plain else next(others) for b in range(256)]


class Merges:
    """The merge table of a vocabulary file, and how many symbols of a word survive it."""

    def __init__(self, model: dict):
        if model["type"] != "BPE" or model.get("dropout") or model.get("unk_token") or model.get("continuing_subword_prefix"):
            raise ValueError("a byte-level BPE without dropout, prefixes and unknown symbols is needed")
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = _byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], np.int64)
        self.final = np.array([vocabulary[c + suffix] for c in letters], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = max(vocabulary.values()) + 1
        left, right = (np.array([vocabulary[pair[side]] for pair in pairs], np.int64) for side in (0, 1))
        self.product = np.array([vocabulary["".join(pair)] for pair in pairs], np.int64)
        keys = left * self.size + right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        # a product that an earlier merge takes up must be offered to it at once: such merges go one by one
        first_use = np.full(self.size, _NONE)
        np.minimum.at(first_use, left, np.arange(len(pairs)))
        np.minimum.at(first_use, right, np.arange(len(pairs)))
        self.one_by_one = first_use[self.product] < np.arange(len(pairs))
        # words that are taken whole, where the file asks for it
        self.whole = {_as_bytes(token, letters) for token in vocabulary} - {None} if model.get("ignore_merges") else set()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], _NONE)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols that are left of each word, which must not be empty."""
        lengths = np.array([len(w) for w in words], np.int64)
        ids = self.inner[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(lengths)
        ids[ends - 1] = self.final[np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)]
        found = lengths.copy()
        for k in np.flatnonzero(lengths > LONG_WORD):
            found[k] = self._long(ids[ends[k] - lengths[k] : ends[k]].copy())
        live = np.flatnonzero((lengths > 1) & (lengths <= LONG_WORD))
        ids = ids[np.repeat((lengths > 1) & (lengths <= LONG_WORD), lengths)]
        found[live] = self._together(ids, lengths[live])
        for k, word in enumerate(words) if self.whole else ():
            found[k] = 1 if word in self.whole else found[k]
        return found

    def _together(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """All words at once: in every round each word merges its lowest-ranked pair wherever it stands."""
        found, word = lengths.copy(), np.arange(len(lengths))
        while len(word):
            begin = np.cumsum(lengths) - lengths
            rank = np.append(self.ranks(ids[:-1], ids[1:]), _NONE)
            rank[begin + lengths - 1] = _NONE
            lowest = np.minimum.reduceat(rank, begin)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            at = np.flatnonzero((rank == lowest[owner]) & (rank < _NONE))
            at = at[_every_other(np.diff(at) == 1, len(at))]
            first = np.append(True, owner[at[1:]] != owner[at[:-1]])[: len(at)]
            at = at[first | ~self.one_by_one[rank[at]]]
            ids[at] = self.product[rank[at]]
            lengths = lengths - np.bincount(owner[at], minlength=len(lengths))
            found[word] = lengths
            live = (lowest < _NONE) & (lengths > 1)
            stays = live[owner]
            stays[at + 1] = False
            ids, lengths, word = ids[stays], lengths[live], word[live]
        return found

    def _long(self, ids: np.ndarray) -> int:
        """One word by the same rounds, each of which touches only the places of its pair."""
        n = len(ids)
        after, before, gone = np.arange(1, n + 1), np.arange(-1, n - 1), np.zeros(n, bool)
        places: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def offer(at: np.ndarray) -> None:
            rank = self.ranks(ids[at], ids[after[at]])
            at, rank = at[rank < _NONE], rank[rank < _NONE]
            order = np.argsort(rank, kind="stable")
            cuts = np.flatnonzero(np.diff(rank[order])) + 1
            for part in np.split(order, cuts) if len(order) else ():
                r = int(rank[part[0]])
                if r not in places:
                    heappush(heap, r)
                places.setdefault(r, []).append(at[part])

        offer(np.arange(n - 1))
        heapify(heap)
        while heap:
            r = heappop(heap)
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[~gone[at] & (after[at] < n)]
            at = at[self.ranks(ids[at], ids[after[at]]) == r]
            at = at[_every_other(after[at[:-1]] == at[1:], len(at))]
            if self.one_by_one[r] and len(at) > 1:
                places[r], at = [at[1:]], at[:1]
                heappush(heap, r)
            if not len(at):
                continue
            ids[at] = self.product[r]
            taken = after[at]
            gone[taken] = True
            after[at] = after[taken]
            inside = at[after[at] < n]
            before[after[inside]] = inside
            left = before[at]
            offer(np.unique(np.concatenate([left[left >= 0], inside])))
        return int(n - gone.sum())


def _every_other(joined: np.ndarray, n: int) -> np.ndarray:
    """Of hits in a row that overlap (each ``joined`` to the next), the first, third and so on."""
    begins = np.append(True, ~joined)[:n]
    place = np.arange(n)
    return (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0


def _as_bytes(token: str, letters: list[str]) -> bytes | None:
    known = {c: b for b, c in enumerate(letters)}
    return bytes(known[c] for c in token) if all(c in known for c in token) else None


class Counter:
    """Token counts by a vocabulary file, as ``tokenizers`` gives them without special tokens added.

    Pre-tokens of Latin texts are split by the rules spelled out in ``packing``; any other text is split
    by the library's own normaliser and pre-tokeniser. All are merged here.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.merges = Merges(described["model"])
        added = described.get("added_tokens") or []
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens must be plain strings")
        self.special = re.compile("|".join(re.escape(t["content"]) for t in added) or "(?!)")
        self.latin = _LATIN_RULES in json.dumps(described.get("pre_tokenizer"), ensure_ascii=False).replace("\\\\", "\\")
        self.pattern, self.foreign = _word_pattern(), re.compile(f"[^\x00-{chr(_LATIN_END - 1)}]")
        self.bytes_of = str.maketrans({c: chr(b) for b, c in enumerate(_byte_letters())})
        # those of Latin texts as they stand there, the library's in its own letters
        self.words: dict[str, int] = {}
        self.pieces: dict[str, int] = {}

    def _split(self, text: str) -> tuple[dict[str, int], list[str]]:
        if self.latin and not self.foreign.search(text):
            return self.words, self.pattern.findall(text.lower())
        normalizer = self.library.normalizer
        text = normalizer.normalize_str(text) if normalizer else text
        return self.pieces, [piece for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def count(self, texts: list[str]) -> list[int]:
        for known in (self.words, self.pieces):
            if len(known) > CACHED_WORDS:
                known.clear()
        split, special = [], []
        for text in texts:
            parts = self.special.split(text) if "<" in text else [text]
            special.append(len(parts) - 1)
            split.append([self._split(part) for part in parts if part])
        for known, encoded in ((self.words, str.encode), (self.pieces, self._piece_bytes)):
            new = sorted(set().union(*(set(w).difference(known) for row in split for k, w in row if k is known)))
            if new:
                known.update(zip(new, self.merges.counts([encoded(w) for w in new]).tolist(), strict=True))
        return [n + sum(sum(map(known.__getitem__, words)) for known, words in row) for n, row in zip(special, split, strict=True)]

    def _piece_bytes(self, piece: str) -> bytes:
        return piece.translate(self.bytes_of).encode("latin-1")

    def cut(self, text: str) -> Iterator[str]:
        """A long text in parts that are counted alone: no token of the Latin rules reaches over a space."""
        at = 0
        while self.latin and len(text) - at > CHUNK:
            end = text.find(" ", at + CHUNK)
            if end < 0:
                break
            yield text[at:end]
            at = end
        yield text[at:] if at else text


@lru_cache(maxsize=1)
def _counter(path: str) -> Counter:
    """One for each worker process, whose tasks share the words it knows."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Counter(path)


def _batch_counts(counter: Counter, texts: pa.Array) -> np.ndarray:
    total = np.zeros(len(texts), np.int64)
    rows: list[int] = []
    parts: list[str] = []
    size = 0

    def flush() -> None:
        np.add.at(total, rows, counter.count(parts))
        rows.clear()
        parts.clear()

    for row, text in enumerate(texts):
        for part in counter.cut(text.as_py() or ""):
            rows.append(row)
            parts.append(part)
            size += len(part)
            if size >= CHUNK:
                flush()
                size = 0
    if rows:
        flush()
    return total


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every text, one row per row.

    A null or empty text has no bytes and no tokens. A null id stays null, repeated rows are counted
    each, other columns are not read, an empty table gives no rows. Texts of any length are counted
    whole: long ones in parts cut at spaces, where no token can reach over. Strings of special
    tokens count as one token. Nothing is shuffled.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer or tokenizer_path())
        for batch in batches:
            found = pa.array(_batch_counts(counter, batch.column(2)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    found = rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
