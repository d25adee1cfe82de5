"""Removal of long repeated substrings by prefix doubling over ranked positions.

Equal prefixes share a rank. Ranks of 1, 2, 4, 8, 16 and then ``half`` bytes are doubled inside the
task, as 64-bit names that every task computes alike. At ``half`` bytes Spark compares positions for
the first time: the positions of a document fall into blocks that share the smallest rank within
reach, and only that rank is dealt out, one for about fourteen positions. Blocks whose rank no other
document has are unique and drop out. What is left and not settled block by block is doubled once
more: pairs of ranks ``half`` bytes apart, position by position, up to the threshold.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.shuffles import shuffles_end_with_writes
from shelfmark.storage import fresh_path, stage

THRESHOLD = 50
# bytes that are ranked in one go, and those whose blocks leave a task together
CHUNK_BYTES = 128 * 1024
BATCH_BYTES = 8 << 20
# longest block; longer runs of one rank are cut
MAX_BLOCK = 250
# bytes kept of a block's rank, besides those that choose the partition, and of its content's name
NAME_BYTES = 5
# the same for a pair of ranks: all, as a match of pairs is not compared further
PAIR_BYTES = 8
# texts that a task remembers, to pass over those that repeat them; bounds memory only
REMEMBERED = 1 << 17
PARTITIONS = "spark.sql.shuffle.partitions"
# bytes of text whose ranks one task compares, about as many as it holds packed
PART_BYTES = 128 << 20
# blocks or positions that a comparing task has unpacked at a time
SLICE_ROWS = 1 << 19

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_FIRST = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64)
# ranks a missing id: none comes after it
NO_ID = np.iinfo(np.int64).max


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of two neighbouring prefixes."""
    rank = left * _A
    rank ^= rank >> np.uint64(29)
    rank += right
    rank *= _B
    rank ^= rank >> np.uint64(32)
    return rank


def prefix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes at every position that has as many."""
    ranks, done = {1: _FIRST[data]}, 1
    while 2 * done <= length:
        ranks[2 * done] = _joined(ranks[done][:-done], ranks[done][done:])
        done *= 2
    result, have = ranks[done], done
    while have < length:
        step = max(k for k in ranks if k <= length - have)
        result = _joined(result[: len(ranks[step]) - have], ranks[step][have:])
        have += step
    return result


class Blocks(NamedTuple):
    """Runs of positions with one smallest rank: the rank, a name of the bytes, where, how many."""

    rank: np.ndarray
    name: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray


def _segments(texts: list[bytes], threshold: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Chunks of ``(document, offset, bytes)``; cuts overlap so that every string is whole in one."""
    chunk, size = [], 0
    for doc, text in enumerate(texts):
        for at in range(0, max(0, len(text) - threshold) + 1, CHUNK_BYTES):
            part = text[at : at + CHUNK_BYTES + threshold - 1]
            if len(part) < threshold:
                continue
            chunk.append((doc, at, part))
            size += len(part)
            if size >= CHUNK_BYTES:
                yield chunk
                chunk, size = [], 0
    if chunk:
        yield chunk


def _pairs(data: np.ndarray, ranks: np.ndarray, threshold: int) -> np.ndarray:
    """Ranks doubled to the threshold: pairs half of it apart, and an odd last byte."""
    half, n = threshold // 2, len(data) - threshold + 1
    full = _joined(ranks[:n], ranks[half : half + n])
    return _joined(full, _FIRST[data[threshold - 1 :]]) if threshold % 2 else full


def _least(ranks: np.ndarray, reach: int) -> np.ndarray:
    """The smallest of ``reach`` ranks from each position on."""
    least, have = ranks, 1
    while 2 * have <= reach:
        least = np.minimum(least[: len(least) - have], least[have:])
        have *= 2
    rest = reach - have
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _chunk_blocks(chunk: list[tuple[int, int, bytes]], threshold: int) -> Blocks:
    half = threshold // 2
    data = np.frombuffer(b"".join([part for *_, part in chunk]), np.uint8)
    lengths = np.array([len(part) for *_, part in chunk])
    begins = np.cumsum(lengths) - lengths
    ranks = prefix_ranks(data, half)
    full = _pairs(data, ranks, threshold)
    least = _least(ranks, threshold - half + 1)
    counts = lengths - threshold + 1
    owner = np.repeat(np.arange(len(chunk)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begins[owner] + within
    key, full = least[at], full[at]
    opens = np.ones(len(at), bool)
    opens[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(opens)
    offset = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    if offset.max() >= MAX_BLOCK:
        offset %= MAX_BLOCK
        starts = np.flatnonzero(offset == 0)
    size = np.diff(np.append(starts, len(at)))
    # the strings of a block in order: equal names, equal bytes
    sums = np.add.reduceat(full * (2 * offset + 1).astype(np.uint64), starts)
    docs = np.array([doc for doc, *_ in chunk])
    bases = np.array([base for _, base, _ in chunk])
    return Blocks(
        key[starts],
        _joined(sums, size.astype(np.uint64)),
        docs[owner[starts]],
        bases[owner[starts]] + within[starts],
        size,
    )


def text_blocks(texts: list[bytes], threshold: int = THRESHOLD) -> Blocks:
    """Blocks of all positions where a string of ``threshold`` bytes starts."""
    found = [_chunk_blocks(chunk, threshold) for chunk in _segments(texts, threshold)]
    if not found:
        empty = np.zeros(0, np.int64)
        return Blocks(empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty)
    return Blocks(*(np.concatenate(column) for column in zip(*found, strict=True)))


def _runs(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Touching intervals of a document made one."""
    if not len(doc):
        return doc, begin, end
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    # ends grow within a document once they are lifted by the document's place
    place = np.cumsum(np.append(False, doc[1:] != doc[:-1]))
    lift = place * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift)
    opens = np.append(True, begin[1:] + lift[1:] > reach[:-1])
    starts = np.flatnonzero(opens)
    last = np.append(starts[1:], len(doc)) - 1
    return doc[starts], begin[starts], reach[last] - lift[starts]


def _split(names: np.ndarray, size: int) -> list[bytes]:
    """Low bytes of 64-bit names, one plane per byte."""
    return [np.ascontiguousarray(plane).tobytes() for plane in names.view(np.uint8).reshape(-1, 8)[:, :size].T]


def _pack(blocks: Blocks, keep: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> bytes:
    """Blocks in planes that compress well, and the documents they name."""
    docs, place = np.unique(blocks.doc[keep], return_inverse=True)
    start = blocks.start[keep].astype("<u4").view(np.uint8).reshape(-1, 4).T
    parts = [
        struct.pack("<II", len(keep), len(docs)),
        ids[docs].astype("<i8").tobytes(),
        hashes[docs].astype("<i8").tobytes(),
        *_split(blocks.rank[keep], NAME_BYTES),
        *_split(blocks.name[keep], NAME_BYTES),
        place.astype("<u2").tobytes(),
        *[np.ascontiguousarray(plane).tobytes() for plane in start],
        blocks.count[keep].astype(np.uint8).tobytes(),
    ]
    return b"".join(parts)


def _whole(planes: np.ndarray, kind: str) -> np.ndarray:
    """Numbers from the planes of their low bytes."""
    wide = np.zeros((planes.shape[1], np.dtype(kind).itemsize), np.uint8)
    wide[:, : len(planes)] = planes.T
    return wide.view(kind).ravel()


def _packed_rows(data: bytes) -> int:
    return struct.unpack_from("<I", data)[0]


def _slices(held: list[bytes]) -> int:
    """In how many slices packed rows are taken, by the low byte of their names."""
    return min(255, -(-sum(map(_packed_rows, held)) // SLICE_ROWS))


def _own(low: np.ndarray, slices: int, slice_: int) -> np.ndarray | slice:
    return np.flatnonzero(low % slices == slice_) if slices > 1 else slice(None)


def _unpack(data: bytes, slices: int = 1, slice_: int = 0) -> tuple[np.ndarray, ...]:
    """Columns of the packed blocks, or of one slice of them by the low byte of the rank."""
    n, n_docs = struct.unpack_from("<II", data)
    at = 8

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, count, at)
        at += found.nbytes
        return found

    ids, hashes = take("<i8", n_docs), take("<i8", n_docs)
    rank, name = (take("u1", NAME_BYTES * n).reshape(NAME_BYTES, n) for _ in range(2))
    own = _own(rank[0], slices, slice_)
    place = take("<u2", n)[own]
    start = take("u1", 4 * n).reshape(4, n)
    count = take("u1", n)[own].astype(np.int64)
    start = _whole(start[:, own], "<u4").astype(np.int64)
    return _whole(rank[:, own], "<u8"), _whole(name[:, own], "<u8"), ids[place], hashes[place], start, count


_DEALT = "part int, blocks binary, id long, hash long, begin long, beyond long"
_MARK = "id long, hash long, begin long, beyond long, settled boolean"


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that repeat an id and text (columns 0 and 1) of the task's earlier ones left out."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        fresh = []
        for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            fresh.append(key not in seen)
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen.add(key)
        yield batch if all(fresh) else batch.filter(pa.array(fresh, pa.bool_()))


def _dealt(parts: int, threshold: int):
    """Task function: texts to blocks by partition of their rank, and runs that the batch settles itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _folded(batches):
            ids, hashes, texts, size = [], [], [], 0
            for doc, hashed, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ids.append(doc)
                hashes.append(hashed)
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= BATCH_BYTES or len(texts) == 1 << 16:
                    yield from emit(ids, hashes, texts)
                    ids, hashes, texts, size = [], [], [], 0
            if texts:
                yield from emit(ids, hashes, texts)

    def emit(ids: list[int], hashes: list[int], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        ids, hashes = np.array(ids, np.int64), np.array(hashes, np.int64)
        blocks = text_blocks(texts, threshold)
        if not len(blocks.rank):
            return
        # of equal blocks only those of the first document travel: the others are covered by it
        owner = ids[blocks.doc]
        order = np.lexsort((owner, blocks.name, blocks.rank))
        rank, name, owner = blocks.rank[order], blocks.name[order], owner[order]
        opens = np.append(True, (rank[1:] != rank[:-1]) | (name[1:] != name[:-1]))
        first = owner[np.flatnonzero(opens)][np.cumsum(opens) - 1]
        covered = order[owner > first]
        kept = np.sort(order[owner == first])
        doc, begin, beyond = _runs(blocks.doc[covered], blocks.start[covered], (blocks.start + blocks.count + threshold - 1)[covered])
        part = ((blocks.rank[kept] >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
        by_part = np.argsort(part, kind="stable")
        bounds = np.searchsorted(part[by_part], np.arange(parts + 1))
        rows = [(p, _pack(blocks, kept[by_part[i:j]], ids, hashes)) for p, (i, j) in enumerate(zip(bounds, bounds[1:], strict=False)) if i < j]
        nothing = pa.nulls(len(rows), pa.int64())
        yield _batch([[p for p, _ in rows], [b for _, b in rows], nothing, nothing, nothing, nothing], _DEALT)
        yield _dealt_runs(ids[doc], hashes[doc], begin, beyond, parts)

    return run


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(part.split() for part in schema.split(", ")), strict=True)
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def _dealt_runs(ids: np.ndarray, hashes: np.ndarray, begin: np.ndarray, beyond: np.ndarray, parts: int) -> pa.RecordBatch:
    """Settled runs on their way, spread by document: copies share a hash, but no id."""
    mixed = _joined(ids.view(np.uint64), hashes.view(np.uint64))
    return _batch([(mixed % np.uint64(parts)).astype(np.int32), pa.nulls(len(ids), pa.binary()), ids, hashes, begin, beyond], _DEALT)


def _united(held: list[pa.RecordBatch]) -> list[np.ndarray]:
    """Columns of the settled runs of a partition's documents; those of repeated rows come once."""
    ids, hashes, begin, beyond = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in (2, 3, 4, 5))
    order = np.lexsort((hashes, ids))
    ids, hashes, begin, beyond = (x[order] for x in (ids, hashes, begin, beyond))
    doc = np.cumsum(np.append(False, (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])))
    opens = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    doc, begin, beyond = _runs(doc, begin, beyond)
    return [ids[opens[doc]], hashes[opens[doc]], begin, beyond]


def _compared(threshold: int):
    """Task function: all blocks of some ranks to marks, each of them once.

    ``settled`` marks are bytes to remove: a block whose equal stands in an earlier document. The
    others are blocks that share their rank with different blocks, to be compared by position; of
    equal ones only those of their first document. Blocks stay packed but for one slice of ranks at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, runs = [], []
        for batch in batches:
            data = batch.column(1)
            held += [x.as_py() for x in data if x.is_valid]
            runs.append(batch.filter(data.is_null()))
        if any(r.num_rows for r in runs):
            columns = _united(runs)
            yield _batch([*columns, np.full(len(columns[0]), True)], _MARK)
        del runs
        slices = _slices(held)
        for n in range(slices):
            yield from compared(*(np.concatenate(c) for c in zip(*(_unpack(x, slices, n) for x in held), strict=True)))

    def compared(rank, name, ids, hashes, start, count) -> Iterator[pa.RecordBatch]:
        order = np.argsort(rank, kind="stable")
        opens = np.append(True, rank[order][1:] != rank[order][:-1])
        sizes = np.diff(np.append(np.flatnonzero(opens), len(order)))
        order = order[np.repeat(sizes > 1, sizes)]
        rank, name, ids, hashes, start, count = (x[order] for x in (rank, name, ids, hashes, start, count))
        if not len(rank):
            return
        order = np.lexsort((start, hashes, ids, name, rank))
        rank, name, ids, hashes, start, count = (x[order] for x in (rank, name, ids, hashes, start, count))
        # a row that other tasks repeat counts once
        once = np.append(True, np.any([x[1:] != x[:-1] for x in (rank, name, ids, hashes, start)], axis=0))
        rank, name, ids, hashes, start, count = (x[once] for x in (rank, name, ids, hashes, start, count))
        new_rank = np.append(True, rank[1:] != rank[:-1])
        new_name = new_rank | np.append(True, name[1:] != name[:-1])
        group = np.cumsum(new_rank) - 1
        first = ids[np.flatnonzero(new_name)][np.cumsum(new_name) - 1]
        later = ids > first
        names_in = np.bincount(group, new_name)
        low = np.minimum.reduceat(ids, np.flatnonzero(new_rank))
        high = np.maximum.reduceat(ids, np.flatnonzero(new_rank))
        unsettled = ~later & (names_in[group] > 1) & (low != high)[group]
        for chosen, settled in ((later, True), (unsettled, False)):
            begin = start[chosen]
            beyond = begin + count[chosen] + (threshold - 1 if settled else 0)
            n = len(begin)
            yield _batch([ids[chosen], hashes[chosen], begin, beyond, np.full(n, settled)], _MARK)

    return run


def _pack_positions(name: np.ndarray, place: np.ndarray, at: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> bytes:
    """Positions in order of document and place, as planes; most steps between them are one."""
    docs, place = np.unique(place, return_inverse=True)
    steps = np.diff(at, prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4).T
    parts = [
        struct.pack("<II", len(at), len(docs)),
        ids[docs].astype("<i8").tobytes(),
        hashes[docs].astype("<i8").tobytes(),
        *_split(name, PAIR_BYTES),
        place.astype("<u2").tobytes(),
        *[np.ascontiguousarray(plane).tobytes() for plane in steps],
    ]
    return b"".join(parts)


def _position_names(data: bytes, slices: int = 1, slice_: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray | slice]:
    """Names and ids of the packed positions, or of one slice of them by their name's low byte, and which these are."""
    n, n_docs = struct.unpack_from("<II", data)
    ids = np.frombuffer(data, "<i8", n_docs, 8)
    begin = 8 + 16 * n_docs
    planes = np.frombuffer(data, "u1", PAIR_BYTES * n, begin).reshape(PAIR_BYTES, n)
    own = _own(planes[0], slices, slice_)
    place = np.frombuffer(data, "<u2", n, begin + PAIR_BYTES * n)[own]
    return _whole(planes[:, own], "<u8"), ids[place], own


def _positions(data: bytes) -> tuple[np.ndarray, ...]:
    """Where the packed positions are: ids and hashes of the documents, whose each is, and its offset."""
    n, n_docs = struct.unpack_from("<II", data)
    ids, hashes = np.frombuffer(data, "<i8", 2 * n_docs, 8).reshape(2, n_docs)
    begin = 8 + 16 * n_docs + PAIR_BYTES * n
    place = np.frombuffer(data, "<u2", n, begin).astype(np.int64)
    steps = _whole(np.frombuffer(data, "u1", 4 * n, begin + 2 * n).reshape(4, n), "<i4")
    return ids, hashes, place, np.cumsum(steps.astype(np.int64))


def _paired(parts: int, threshold: int):
    """Task function: unsettled blocks of a text to positions, named by the pair of ranks there.

    Positions travel by the rank of their block, so that the runs they make come together again. Of
    positions with one pair only those of the first document leave the batch.
    """
    half = threshold // 2

    def ranked(text: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names, keys = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
        for low in range(0, len(text), CHUNK_BYTES):
            i, j = np.searchsorted(at, (low, low + CHUNK_BYTES))
            if i < j:
                data = np.frombuffer(text[low : low + CHUNK_BYTES + threshold - 1], np.uint8)
                ranks = prefix_ranks(data, half)
                keys[i:j] = _least(ranks, threshold - half + 1)[at[i:j] - low]
                names[i:j] = _pairs(data, ranks, threshold)[at[i:j] - low]
        return names, keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in _folded(batches):
            held, ids, hashes, size = [], [], [], 0
            for doc, hashed, packed, spans in zip(*(batch.column(k) for k in range(4)), strict=True):
                begin = spans.values.field("begin").to_numpy()
                beyond = spans.values.field("beyond").to_numpy()
                order = np.argsort(begin)
                at = np.concatenate([np.arange(i, j) for i, j in zip(begin[order], beyond[order], strict=True)])
                held.append((np.full(len(at), len(ids)), at, *ranked(unzip.decompress(packed.as_py()), at)))
                ids.append(doc.as_py())
                hashes.append(hashed.as_py())
                size += len(at)
                if size >= BATCH_BYTES // 16 or len(ids) == 1 << 16:
                    yield from emit(held, np.array(ids, np.int64), np.array(hashes, np.int64))
                    held, ids, hashes, size = [], [], [], 0
            if held:
                yield from emit(held, np.array(ids, np.int64), np.array(hashes, np.int64))

    def emit(held: list, ids: np.ndarray, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        place, at, name, key = (np.concatenate(c) for c in zip(*held, strict=True))
        later = _after_first(name, ids[place])
        yield _run_batch(place[later], at[later], ids, hashes, parts, threshold)
        kept = np.flatnonzero(~later)
        part = ((key[kept] >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
        by_part = kept[np.argsort(part, kind="stable")]
        bounds = np.searchsorted(np.sort(part), np.arange(parts + 1))
        rows = []
        for p, (i, j) in enumerate(zip(bounds, bounds[1:], strict=False)):
            if i < j:
                own = by_part[i:j]
                rows.append((p, _pack_positions(name[own], place[own], at[own], ids, hashes)))
        nothing = pa.nulls(len(rows), pa.int64())
        yield _batch([[p for p, _ in rows], [b for _, b in rows], nothing, nothing, nothing, nothing], _DEALT)

    return run


def _after_first(name: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which entries share their name with one of a smaller id."""
    if not len(name):
        return np.zeros(0, bool)
    order = np.lexsort((ids, name))
    opens = np.append(True, name[order][1:] != name[order][:-1])
    first = ids[order][np.flatnonzero(opens)][np.cumsum(opens) - 1]
    later = np.zeros(len(name), bool)
    later[order] = ids[order] > first
    return later


def _run_batch(place: np.ndarray, at: np.ndarray, ids: np.ndarray, hashes: np.ndarray, parts: int, threshold: int) -> pa.RecordBatch:
    doc, begin, beyond = _runs(place, at, at + threshold)
    return _dealt_runs(ids[doc], hashes[doc], begin, beyond, parts)


_RUN = "id long, hash long, begin long, beyond long"


def _compared_pairs(threshold: int):
    """Task function: all positions of some ranks to runs that an earlier document has.

    They stay packed, one slice of names at a time is compared; the runs are made where they came
    packed together, so slices do not cut them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, settled = [], []
        for batch in batches:
            data = batch.column(1)
            held += [x.as_py() for x in data if x.is_valid]
            settled.append(batch.filter(data.is_null()))
        if any(r.num_rows for r in settled):
            yield _batch(_united(settled), _RUN)
        del settled
        later = [np.zeros(_packed_rows(x), bool) for x in held]
        slices = _slices(held)
        for n in range(slices):
            name, ids, own = zip(*(_position_names(x, slices, n) for x in held), strict=True)
            found = _after_first(np.concatenate(name), np.concatenate(ids))
            for flags, places, part in zip(later, own, np.split(found, np.cumsum([len(x) for x in name])[:-1]), strict=True):
                flags[places] = part
        for data, flags in zip(held, later, strict=True):
            ids, hashes, place, at = _positions(data)
            doc, begin, beyond = _runs(place[flags], at[flags], at[flags] + threshold)
            yield _batch([ids[doc], hashes[doc], begin, beyond], _RUN)

    return run


def _parts(texts: DataFrame) -> int:
    """Partitions for the ranks of the texts: the session's number, or as many as their bytes need."""
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(texts.sparkSession.conf.get(PARTITIONS)), -(-n_bytes // PART_BYTES))


def _texts(docs: DataFrame) -> DataFrame:
    """``(id, hash, text, unnamed)``: UTF-8 bytes under a key that tells different texts of one id apart, by 64 bits."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        F.coalesce(doc_id, F.lit(int(NO_ID))).alias("id"),
        F.xxhash64(text).alias("hash"),
        text.cast("binary").alias("text"),
        doc_id.isNull().alias("unnamed"),
    )


def _zipped(texts: DataFrame, folded: bool = False) -> DataFrame:
    """The texts as they are shuffled: compressed one by one; ``folded``, repeated rows go once per task."""
    names = ["id", "hash", "zipped", "unnamed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zipper = zstandard.ZstdCompressor(level=3)
        for batch in _folded(batches) if folded else batches:
            packed = [zipper.compress(text.as_py()) for text in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(packed, pa.binary()), batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return texts.mapInArrow(run, "id long, hash long, zipped binary, unnamed boolean")


def repeated_bytes(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``(id, hash, begin, beyond)``: byte intervals that a string of an earlier document covers.

    A block's equal in an earlier document settles all its positions, in the task or where the block's
    rank is compared. Positions of blocks that only share their rank are doubled to the threshold and
    compared pair by pair, again first in the task. Rows that repeat an id and text are dealt once
    per task and compared once, so the marks of a text do not grow with its rows. Each part of the
    ranks is one partition, and there are as many as the bytes of the texts need.
    """
    spark = docs.sparkSession
    texts = _texts(docs)
    parts = _parts(texts)
    dealt = texts.mapInArrow(_dealt(parts, threshold), _DEALT).repartitionById(parts, "part")
    with shuffles_end_with_writes(spark):
        marks = stage(dealt.mapInArrow(_compared(threshold), _MARK), fresh_path(spark, "block-marks"))
    spans = F.collect_list(F.struct("begin", "beyond"))
    unsettled = marks.filter("NOT settled").groupBy("id", "hash").agg(spans.alias("spans"))
    held = _zipped(texts, folded=True).drop("unnamed").join(unsettled.hint("merge"), ["id", "hash"])
    pairs = held.mapInArrow(_paired(parts, threshold), _DEALT).repartitionById(parts, "part")
    with shuffles_end_with_writes(spark):
        runs = stage(pairs.mapInArrow(_compared_pairs(threshold), _RUN), fresh_path(spark, "pair-runs"))
    return marks.filter("settled").drop("settled").unionByName(runs)


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD, texts: bool = True) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept])`` per row of ``docs``.

    A byte goes if a string of ``threshold`` bytes that covers it also starts in a document with a
    smaller ``doc_id``; matches lie within one document and are judged on the input.

    A null text is empty. A null id stays null and ranks with the largest there is, 2^63 - 1, after
    all others; rows of one rank take nothing from each other, and equal rows get equal results. Texts
    shorter than the threshold stay whole. Other columns are not read. An empty table gives no rows.
    """
    marks = repeated_bytes(docs, threshold)
    spans = marks.groupBy("id", "hash").agg(F.collect_list(F.struct("begin", "beyond")).alias("spans"))
    held = _zipped(_texts(docs)).join(spans.hint("merge"), ["id", "hash"], "left").select("id", "zipped", "spans", "unnamed")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            unnamed = batch.column(3).to_pylist()
            for doc, packed, spans, missing in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), unnamed, strict=True):
                text = unzip.decompress(packed.as_py())
                kept, n_spans = text, 0
                if spans.is_valid:
                    begin = spans.values.field("begin").to_numpy()
                    beyond = spans.values.field("beyond").to_numpy()
                    _, begin, beyond = _runs(np.zeros(len(begin), np.int64), begin, beyond)
                    n_spans = len(begin)
                    edges = [0, *np.stack([begin, beyond], 1).ravel().tolist(), len(text)]
                    kept = b"".join([text[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)])
                digest = hashlib.sha256(kept).hexdigest()
                rows.append((None if missing else doc, len(text), len(text) - len(kept), n_spans, digest, kept)[: 5 + texts])
            columns = list(zip(*rows, strict=True)) or [()] * (5 + texts)
            yield _batch(list(columns), schema)

    return held.mapInArrow(cut, schema)


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), texts=False)
