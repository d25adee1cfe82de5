import random
import struct
from collections import defaultdict

import pytest

from shelfmark.llm import codes as C
from tests.conftest import SF_DIR
from tests.llm.oracle import assert_same


def test_sql(spark):
    assert_same(C.op12_vector_code_compression(spark, SF_DIR), C.OP12_SQL)


def plain(rows, parts, k, rounds):
    """Lloyd's algorithm with Python's whole numbers."""
    from math import floor, isfinite

    kept = [(i, lab, v) for i, lab, v in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    longest = max(len(v) for _, _, v in kept)
    width = -(-longest // parts)
    whole = [[*[floor(256 * x) if abs(x) < 2**53 else 256 * int(x) for x in v], *[0] * (width * parts - len(v))] for _, _, v in kept]
    order = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0] or 0, kept[j][2]))[:k]
    cut = lambda j, p: whole[j][p * width : (p + 1) * width]
    books = [[cut(j, p) for j in order] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    pick = lambda j, p: min(range(len(order)), key=lambda e: (gap(cut(j, p), books[p][e]), e))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for j in range(len(kept)):
                held[pick(j, p)].append(cut(j, p))
            for e, members in held.items():
                books[p][e] = [sum(axis) // len(members) for axis in zip(*members, strict=True)]
    found, by_label = [], defaultdict(int)
    for j, (i, lab, _) in enumerate(kept):
        chosen = [pick(j, p) for p in range(parts)]
        error = sum(gap(cut(j, p), books[p][e]) for p, e in enumerate(chosen))
        by_label[lab] += error
        found.append((i, lab, bytes(chosen).hex(), error))
    fits = lambda x: x if x < 2**63 else None
    digest = C.Codebooks(width * parts, books).digest()
    return [(i, code, fits(error), fits(by_label[lab]), digest) for i, lab, code, error in found]


SCHEMA = "vec_id long, label int, embedding array<float>, code string"


def same(spark, rows, schema=SCHEMA, **options):
    found = C.compress(spark.createDataFrame([(*r, "x") for r in rows], schema), **options)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    if "float" in schema:
        single = lambda x: None if x is None else struct.unpack("f", struct.pack("f", x))[0]
        rows = [(i, lab, v and [single(x) for x in v]) for i, lab, v in rows]
    o = {"parts": C.PARTS, "entries": C.ENTRIES, "rounds": C.ROUNDS} | options
    expected = plain(rows, o["parts"], o["entries"], o["rounds"])
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_rounds_and_salts(spark, rounds):
    draw = random.Random(rounds)
    hot = [draw.randint(-64, 64) / 256 for _ in range(6)]
    rows = [(n, n % 3 or None, hot if n % 3 else [draw.randint(-300, 300) / 256 for _ in range(6)]) for n in range(300)]
    same(spark, rows, parts=3, entries=7, rounds=rounds, cell_members=11)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 1, [0.5, -0.25, 0.001, 3.0, 1.0]), (1, 1, [0.5, -0.25, 0.001, 3.0, 1.0]), (1, None, [0.25]), (None, None, []),
        (2, 2, None), (3, 2, [nan, 1.0]), (4, 2, [inf]), (5, 2, [None, 1.0]), (6, 2, [-0.0, -1 / 512, 1 / 512]), (None, 2, [9.0] * 4),
    ]
    same(spark, rows)
    same(spark, rows, parts=2, entries=2)
    same(spark, [(1, 1, []), (2, 1, [])])
    same(spark, [(n, n % 2, [2.0**17 * n, -(2.0**100), 3.0e38, 0.3]) for n in range(5)], parts=2, entries=3)
    same(spark, [(1, 1, [1.7e308, 1.0]), (2, 2, [1.0, 2.0])], SCHEMA.replace("float", "double"), parts=2, entries=2)
    none = spark.createDataFrame([], SCHEMA)
    assert C.compress(none).count() == 0 and C.fit_codebooks(none) is None


def test_only_changed_members_move(spark, monkeypatch):
    moved = []
    monkeypatch.setattr(C, "_to_owners", lambda rows, n, f=C._to_owners: (moved.append(rows.count()), f(rows, n))[1])
    draw = random.Random(9)
    rows = [(n, 0, [draw.gauss(n % 4, 0.1) for _ in range(4)], "") for n in range(400)]
    frame = spark.createDataFrame(rows, SCHEMA)
    C.fit_codebooks(frame, parts=2, entries=4, rounds=6)
    assert moved[0] == 800 and moved[-1] == 0 and all(n < 400 for n in moved[1:])


def test_decode(spark):
    rows = [(n, 0, [n / 256, 1.0, -2.0, n / 128], "") for n in range(4)]
    frame = spark.createDataFrame(rows, SCHEMA)
    books = C.fit_codebooks(frame, parts=2, entries=4)
    found = {r.vec_id: r.approximation for r in C.decode(C.encode(frame, books), books).collect()}
    assert found == {n: v for n, _, v, _ in rows}
