import hashlib
import random
import time

import numpy as np
import pytest

from shelfmark.llm import substrings as S
from shelfmark.llm.shuffles import CLEANUP, shuffles_end_with_writes
from tests.conftest import SF_DIR
from tests.llm.oracle import duck

SCHEMA = "doc_id long, text string, hash int"


def plain(rows, threshold=50):
    """Every string of every document in a dictionary of the smallest id that has it."""
    far = S.NO_ID
    data = [(far if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in data:
        for at in range(len(t) - threshold + 1):
            s = t[at : at + threshold]
            if first.get(s, far + 1) > i:
                first[s] = i
    out = []
    for (doc, _), (i, t) in zip(rows, data, strict=True):
        gone = bytearray(len(t))
        for at in range(len(t) - threshold + 1):
            if first[t[at : at + threshold]] < i:
                gone[at : at + threshold] = b"\x01" * threshold
        spans = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(t)))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def same(found, expected):
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_documents_against_a_dictionary(spark):
    rows = duck().execute("SELECT doc_id, text FROM documents").fetchall()
    expected = plain(rows)
    assert sum(e[2] for e in expected) > 100_000
    same(S.op5_suffix_array_dedup(spark, SF_DIR), expected)


@pytest.mark.parametrize("threshold", [8, 11])
def test_short_strings_against_a_dictionary(spark, monkeypatch, threshold):
    monkeypatch.setattr(S, "CHUNK_BYTES", 64)
    monkeypatch.setattr(S, "BATCH_BYTES", 400)
    monkeypatch.setattr(S, "MAX_BLOCK", 5)
    monkeypatch.setattr(S, "PART_BYTES", 700)
    monkeypatch.setattr(S, "SLICE_ROWS", 20)
    draw, rows = random.Random(threshold), []
    pool = ["".join(draw.choice("ab") for _ in range(draw.randint(5, 40))) for _ in range(12)]
    for n in range(150):
        parts = [draw.choice([*pool, "é" * 9, "a" * 30, "".join(draw.choice("abc") for _ in range(12))]) for _ in range(draw.randint(0, 7))]
        rows.append((draw.choice([n, n, n // 2, None]), "".join(parts)))
    docs = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(6)
    same(S.remove_repeats(docs, threshold), plain(rows, threshold))


def test_ranks_name_equal_prefixes():
    data = np.frombuffer(bytes(random.Random(1).choices(b"ab", k=4000)), np.uint8)
    for length in (1, 2, 3, 7, 12, 25):
        ranks = S.prefix_ranks(data, length)
        assert len(ranks) == len(data) - length + 1
        by_rank = {}
        for at, rank in enumerate(ranks.tolist()):
            by_rank.setdefault(rank, set()).add(bytes(data[at : at + length]))
        assert all(len(x) == 1 for x in by_rank.values())
        assert len(by_rank) == len({bytes(data[i : i + length]) for i in range(len(ranks))})


def test_edges(spark):
    copy = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(500))
    rows = [(None, copy), (None, copy), (3, copy), (3, copy), (3, copy[100:300]), (9, None), (9, ""), (10, "x" * 49), (11, "x" * 49), (12, "x" * 300_000), (13, "x" * 300_000 + "y"), (int(S.NO_ID), copy + "z")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    same(S.remove_repeats(docs), [
        *[(None, 500, 500, 1, hashlib.sha256(b"").hexdigest())] * 2,
        *[(3, 500, 0, 0, hashlib.sha256(copy.encode()).hexdigest())] * 2,
        (3, 200, 0, 0, hashlib.sha256(copy[100:300].encode()).hexdigest()),
        *[(9, 0, 0, 0, hashlib.sha256(b"").hexdigest())] * 2,
        *[(n, 49, 0, 0, hashlib.sha256(b"x" * 49).hexdigest()) for n in (10, 11)],
        (12, 300_000, 0, 0, hashlib.sha256(b"x" * 300_000).hexdigest()),
        (13, 300_001, 300_000, 1, hashlib.sha256(b"y").hexdigest()),
        (int(S.NO_ID), 501, 500, 1, hashlib.sha256(b"z").hexdigest()),
    ])
    assert S.remove_repeats(docs.limit(0)).count() == 0


def test_texts_with_one_short_hash_stay_apart(spark):
    shared = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(120))
    # equal in the low 32 bits of their hashes
    ours, other = shared + "10333", "short text " * 11 + "155083"
    rows = [(1, shared), (None, ours), (None, other)]
    low = spark.createDataFrame([(t,) for _, t in rows[1:]], "t string").selectExpr("xxhash64(t) & 4294967295 AS h")
    assert low.distinct().count() == 1
    same(S.remove_repeats(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)), plain(rows))


@pytest.mark.parametrize("doc_id", [7, None])
def test_marks_do_not_grow_with_repeated_rows(spark, doc_id):
    draw = random.Random(3)
    shared, tail, other = ("".join(draw.choices("abcdefgh", k=n)) for n in (90, 400, 400))
    rows = [(1, other + shared), *[(doc_id, shared + tail)] * 200, (9, tail[:200])]
    docs = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(4)
    single = spark.createDataFrame([(*r, 0) for r in dict.fromkeys(rows)], SCHEMA)
    marks = S.repeated_bytes(docs)
    # each of four tasks may add what its own rows settle
    assert marks.count() <= 4 * S.repeated_bytes(single).count()
    same(S.remove_repeats(docs), plain(rows))
    batches = iter(spark.createDataFrame(rows[1:-1], "id long, text string").selectExpr("coalesce(id, 0)", "xxhash64(text)", "cast(text AS binary)").toArrow().to_batches())
    dealt = [S._unpack(x.as_py()) for b in S._dealt(1, 50)(batches) for x in b.column(1) if x.is_valid]
    assert sum(len(d[0]) for d in dealt) == len(S.text_blocks([(shared + tail).encode()]).rank)


def test_positions_keep_whole_names():
    names = np.array([5, 5 + (1 << 48), 5 + (1 << 63), (1 << 64) - 1], np.uint64)
    ids, hashes = np.array([3, S.NO_ID]), np.array([-1, 1 << 40])
    place, at = np.array([0, 0, 1, 1]), np.array([0, 1, 7, 300_000])
    data = S._pack_positions(names, place, at, ids, hashes)
    got = [S._position_names(data, 2, n) for n in (0, 1)]
    assert sorted(np.concatenate([x[0] for x in got]).tolist()) == names.tolist()
    name, owner, _ = S._position_names(data)
    assert (name.tolist(), owner.tolist()) == (names.tolist(), ids[place].tolist())
    assert S._after_first(*S._position_names(data, 255, 77)[:2]).tolist() == []
    assert [x.tolist() for x in S._positions(data)] == [x.tolist() for x in (ids, hashes, place, at)]


def test_slices_of_packed_blocks_hold_each_once():
    blocks = S.text_blocks([bytes(random.Random(n).choices(b"abcd", k=3000)) for n in range(5)])
    ids, hashes = np.arange(5) - 2, np.arange(5) << 40
    data = S._pack(blocks, np.arange(len(blocks.rank)), ids, hashes)
    whole = sorted(zip(*(c.tolist() for c in S._unpack(data)), strict=True))
    parts = [S._unpack(data, 7, n) for n in range(7)]
    assert sorted(row for part in parts for row in zip(*(c.tolist() for c in part), strict=True)) == whole
    owners = [set((part[0] & np.uint64(255)).tolist()) for part in parts]
    assert sum(map(len, owners)) == len(set().union(*owners)) and len(whole) == len(blocks.rank)


def test_partitions_follow_the_bytes(spark, monkeypatch):
    texts = S._texts(spark.createDataFrame([(n, "x" * 1000, 0) for n in range(100)], SCHEMA))
    monkeypatch.setattr(S, "PART_BYTES", 1000)
    assert S._parts(texts) == 100
    monkeypatch.undo()
    assert S._parts(texts) == S._parts(texts.limit(0)) == int(spark.conf.get(S.PARTITIONS))


def test_largest_id_and_missing_ids_rank_alike(spark):
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(200))
    rows = [(int(S.NO_ID), text), (None, text), (None, text[:90])]
    same(S.remove_repeats(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)), plain(rows))


def test_shuffles_end_with_writes(spark, tmp_path):
    before = spark.conf.get(CLEANUP, "false")
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return sum(f.length() for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()) if f.getName().startswith("shuffle"))

    with pytest.raises(ZeroDivisionError), shuffles_end_with_writes(spark):
        held = shuffled()
        rows = spark.range(500_000).selectExpr("id", "xxhash64(id) AS h").repartition(4, "h")
        rows.write.parquet(str(tmp_path / "rows"))
        for _ in range(50):
            if shuffled() <= held:
                break
            time.sleep(0.1)
        assert shuffled() <= held
        raise ZeroDivisionError
    assert spark.conf.get(CLEANUP, "false") == before
