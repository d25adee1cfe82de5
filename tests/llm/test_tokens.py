import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import tokens as T
from shelfmark.llm.packing import tokenizer_path
from tests.conftest import SF_DIR
from tests.llm.oracle import duck

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
TEXTS = [
    "", " ", "it's I'LL x'sx ''s", "a<|endoftext|>b <|x|> <|startoftext|><|startoftext|>", "Σας ΣΑΣ", "é́ é",
    "日本語 text, 日本語", "İi̇ Iſ", "\x00\x1c a\x85b\xa0c", "²³½ 12 a1", "<|ENDOFTEXT|>", "🙂🙃 <", "aaaaaaaaaaaaaaaaaaaaaaa", "ǅ ǆ ̸< x",
]


@pytest.fixture(scope="module", params=FILES)
def file(request):
    path = tokenizer_path(request.param)
    return path, Tokenizer.from_file(path)


def library(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_counts_are_the_librarys(file, monkeypatch):
    path, tokenizer = file
    monkeypatch.setattr(T, "CACHED_WORDS", 300)
    counter, draw = T.Counter(path), random.Random(3)
    letters = [chr(c) for c in range(0x180)] + list("日本語абвΣ🙂é́")
    texts = TEXTS + [
        "".join(draw.choice(letters if draw.random() < 0.3 else "abc the 'sSxXÉİ12,.\n\t!<|>") for _ in range(draw.randint(0, 60)))
        for _ in range(600)
    ]
    for at in range(0, len(texts), 7):
        part = texts[at : at + 7]
        assert counter.count(part) == [library(tokenizer, t) for t in part], part


@pytest.mark.parametrize("long_word", [3, 40, 10**6])
def test_long_words(file, monkeypatch, long_word):
    path, tokenizer = file
    monkeypatch.setattr(T, "LONG_WORD", long_word)
    counter, draw = T.Counter(path), random.Random(long_word)
    texts = ["".join(draw.choice(alphabet) for _ in range(n)) for alphabet in ("ab", "theinga", "abcdefghijklmnopqrstuvwxyz") for n in (2, 3, 7, 50, 900)]
    texts += ["a" * 5000, "ab" * 3001, "日本" * 700]
    assert counter.count(texts) == [library(tokenizer, t) for t in texts]


def test_merges_whose_product_is_used_by_an_earlier_merge():
    """``abc`` can be made in two ways; the pair it forms comes before the second of them."""
    letters = T._byte_letters()
    made = ["bc", "abc", "abcabc", "ab"]
    vocabulary = {c: n for n, c in enumerate(letters)} | {w: 256 + n for n, w in enumerate(made)}
    model = {"type": "BPE", "vocab": vocabulary, "merges": [["abc", "abc"], ["a", "b"], ["ab", "c"], ["b", "c"]]}
    from tokenizers import models

    plain = Tokenizer(models.BPE(vocab=vocabulary, merges=[tuple(m) for m in model["merges"]]))
    merges, draw = T.Merges(model), random.Random(5)
    assert merges.one_by_one.any()
    words = ["".join(draw.choice("abc") for _ in range(draw.randint(1, 30))) for _ in range(300)] + ["abc" * n for n in range(1, 9)]
    expected = [len(plain.model.tokenize(w)) for w in words]
    assert merges.counts([w.encode() for w in words]).tolist() == expected
    assert [merges._long(merges.inner[np.frombuffer(w.encode(), np.uint8)]) for w in words] == expected


def test_documents(spark):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = T.op11_token_counts(spark, SF_DIR).collect()
    expected = [(i, len((t or "").encode()), n := library(tokenizer, t), n > 2048) for i, t in duck().execute("SELECT doc_id, text FROM documents").fetchall()]
    assert sorted(map(tuple, rows)) == sorted(expected)


def test_edges(spark, monkeypatch):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    long = "word it's <|endoftext|> " * 60_000
    rows = [(None, None, 1), (1, "", 1), (2, "one two", 1), (2, "one two", 1), (3, long, 1), (4, "x" * 700_000, 1), (5, "日 " * 400_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    found = T.token_counts(docs, limit=2)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    key = lambda r: (r[0] is not None, *map(repr, r))
    expected = [(i, len((t or "").encode()), n := library(tokenizer, t), n > 2) for i, t, _ in rows]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)
    assert T.token_counts(docs.limit(0)).count() == 0
