import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import packing as P
from tests.conftest import SF_DIR
from tests.llm.oracle import duck


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.tokenizer_path())


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


TEXTS = ["", " ", "it's I'LL x'sx ''s", "a<|endoftext|>b <|x|>", "Σας ΣΑΣ", "é́", "日本語 text", "İi̇ Iſ", "\x00\x1c a\x85b\xa0c", "²³½ 12 a1"]


def test_encoder_is_the_tokenizer(tokenizer, monkeypatch):
    monkeypatch.setattr(P, "CACHED_WORDS", 300)
    encoder, draw = P.Encoder(P.tokenizer_path()), random.Random(1)
    letters = [chr(c) for c in range(0x180)]
    texts = TEXTS + [
        "".join(draw.choice(letters if draw.random() < 0.5 else "abc 'sSxXÉİ12,.\n\t!") for _ in range(draw.randint(0, 40)))
        for _ in range(500)
    ]
    for at in range(0, len(texts), 7):
        for text, ids in zip(texts[at : at + 7], encoder.encode(texts[at : at + 7]), strict=False):
            assert ids == np.array(whole(tokenizer, text)[:-1], "<u4").tobytes(), text


def plain_place(lengths, capacity):
    """The sum of squares, computed in full for every choice."""
    fill, where = [], []
    for size in lengths:
        choices = {}
        for b in [*range(len(fill)), len(fill)]:
            after = [*fill, 0] if b == len(fill) else list(fill)
            after[b] += size
            if after[b] <= capacity:
                gaps = [capacity - f for f in after if f < capacity]
                score = sum(gaps.count(g) ** 2 for g in set(gaps))
                choices.setdefault((score, capacity - after[b]), b)
        best = min(choices)
        where.append((best, lengths))
        b = choices[best]
        fill = [*fill, 0] if b == len(fill) else fill
        fill[b] += size
    return sorted(fill)


@pytest.mark.parametrize("capacity", [5, 12, 30])
def test_places_by_sum_of_squares(capacity):
    draw = random.Random(capacity)
    for _ in range(20):
        lengths = [draw.randint(1, capacity) for _ in range(40)]
        bins, offsets = P.place(np.array(lengths), capacity)
        held = {}
        for size, b, at in zip(lengths, bins.tolist(), offsets.tolist(), strict=True):
            assert held.get(b, 0) == at
            held[b] = at + size
        assert sorted(held.values()) == plain_place(lengths, capacity)


def check_packed(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents(spark, tokenizer):
    texts = duck().execute("SELECT doc_id, text FROM documents").fetchall()
    rows = P.op9_best_fit_packing(spark, SF_DIR).collect()
    n = check_packed(rows, 2048)
    assert n <= 1.01 * -(-sum(r.length for r in rows) // 2048) + 1
    got = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    expected = []
    for doc_id, text in texts:
        ids = whole(tokenizer, text)
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            expected.append((doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert got == sorted(expected)


def test_edges(spark, tokenizer):
    rows = [(None, None, 1), (1, "", 1), (2, "one two three", 1), (2, "one two three", 1), (3, "x " * 70, 1), (4, "a b c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece int")
    found = P.pack_documents(docs, capacity=8).collect()
    check_packed(found, 8)
    assert sum(r.length for r in found) == 1 + 1 + 4 + 4 + 71 + 4
    assert sorted(r.start for r in found if r.doc_id == 3) == list(range(0, 71, 8))
    made = [(np.frombuffer(r.ids, "<u4").tolist(), r.n_ids) for r in P.sequences(docs, capacity=8).collect()]
    assert all(len(ids) == n <= 8 for ids, n in made)
    flat = [i for ids, _ in made for i in ids]
    assert sorted(flat) == sorted(i for _, text, _ in rows for i in whole(tokenizer, text))
    assert P.pack_documents(docs.limit(0)).count() == 0


def test_groups_split_the_work(spark):
    pieces = spark.range(1000).selectExpr(
        "cast(null as long) as doc_id", "0 as piece", "0L as start", "id % 100 + 1 as length", "0L as ids_crc32"
    )
    rows = P.pack(pieces, 100, group_pieces=100).collect()
    assert len(rows) == 1000 and check_packed(rows, 100) < 1.1 * sum(r.length for r in rows) / 100 + 10
    assert len({r.sequence_id % 10 for r in rows}) == 10
