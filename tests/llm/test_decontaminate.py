import random

import numpy as np

from shelfmark.llm import decontaminate as D
from tests.conftest import SF_DIR
from tests.llm.oracle import duck

ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string, item_id string"


def plain_score(item, passage):
    """The whole Smith-Waterman table, cell by cell."""
    above = [0] * (len(passage) + 1)
    best = 0
    for word in item:
        row = [0]
        for j, other in enumerate(passage, 1):
            same = D.MATCH if word == other else D.MISMATCH
            row.append(max(0, above[j - 1] + same, above[j] + D.GAP, row[j - 1] + D.GAP))
        best, above = max(best, *row), row
    return best


def test_words_by_table_and_by_pattern():
    draw = random.Random(6)
    for last in (0x7F, 0xFF, 0x17F, 0x2FFF):
        for _ in range(300):
            text = "".join(chr(draw.randint(0, last)) for _ in range(draw.randint(0, 60)))
            assert D.words(text) == D._WORD.findall(text.lower())
    assert D.words(None) == D.words("") == []


def test_alignment_against_the_whole_table():
    draw = random.Random(2)
    for _ in range(200):
        item = [draw.randrange(6) for _ in range(draw.randint(1, 12))]
        passage = [draw.randrange(6) for _ in range(draw.randint(1, 25))]
        score, first, last = D.align(np.array(item), np.array(passage))
        assert score == plain_score(item, passage)
        if score:
            assert plain_score(item, passage[first : last + 1]) == score


def test_documents_against_every_pair(spark):
    docs = duck().execute("SELECT doc_id, text FROM documents").fetchall()
    items = duck().execute("SELECT item_id, text FROM benchmark").fetchall()
    expected = set()
    for doc_id, text in docs:
        own = D.words(text)
        held = set(own)
        for item_id, item in items:
            wanted = D.words(item)
            # fewer common words than this cannot reach the score
            if sum(w in held for w in wanted) >= D.MIN_SCORE * len(wanted):
                numbers = {w: n for n, w in enumerate(dict.fromkeys(wanted))}
                score, *_ = D.align(np.array([numbers[w] for w in wanted]), np.array([numbers.get(w, -1) for w in own]))
                if score >= D.MIN_SCORE * D.MATCH * len(wanted):
                    expected.add((doc_id, item_id))
    found = D.op8_decontamination(spark, SF_DIR).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(found) == len(expected) > 10


def _edited(text, draw):
    """A tenth of the words replaced, left out or doubled."""
    out = []
    for word in text.split():
        case = draw.random()
        out += [word] if case > 0.1 else [["other"], [], [word, word]][draw.randrange(3)]
    return " ".join(out)


def test_edited_copies_are_caught_and_others_left(spark):
    items = duck().execute("SELECT item_id, text FROM benchmark").fetchall()
    clean = [t for (t,) in duck().execute("SELECT text FROM documents ORDER BY doc_id DESC LIMIT 60").fetchall()]
    draw, rows = random.Random(4), []
    for n, (_, item) in enumerate(items):
        before, after = draw.choice(clean)[:400], draw.choice(clean)[-400:]
        rows.append((n, f"{before}\n{_edited(item, draw).upper()}! {after}", "x"))
        rows.append((1000 + n, f"{before}\n{after}", "x"))
    docs, benchmark = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)
    found = D.contaminated(docs, benchmark).collect()
    planted = {(n, item_id) for n, (item_id, _) in enumerate(items)}
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(planted & got) >= 0.95 * len(planted)
    bare = {r for r in got if r[0] >= 1000}
    assert {(d - 1000, i) for d, i in bare} <= got
    all_counted = D.contaminated(docs, benchmark, held_words=10).collect()
    assert {(r.doc_id, r.item_id) for r in all_counted} == got


def _changed(item, draw, vocabulary):
    """A copy with foreign words put in, also many at once, words left out, replaced and swapped."""
    out = list(item)
    for _ in range(draw.randint(0, 4)):
        at = draw.randrange(len(out))
        case = draw.randrange(5)
        if case == 0:
            out[at:at] = draw.choices(vocabulary, k=draw.choice([1, 2, len(item) // 2, 3 * len(item) // 4]))
        elif case == 1:
            del out[at : at + draw.randint(1, 6)]
            out = out or [item[0]]
        elif case == 2:
            out[at] = draw.choice(vocabulary)
        elif case == 3:
            half = len(out) // 2
            out = out[half:] + out[:half]
        else:
            other = draw.randrange(len(out))
            out[at], out[other] = out[other], out[at]
    return out


def test_changed_copies_against_the_whole_document(spark):
    draw = random.Random(12)
    vocabulary = [f"w{n}" for n in range(400)]
    items = [(n, draw.choices(vocabulary, k=draw.randint(8, 60))) for n in range(40)]
    rows = []
    for n in range(240):
        copies = [_changed(draw.choice(items)[1], draw, vocabulary) for _ in range(draw.randint(1, 2))]
        filler = lambda: draw.choices(vocabulary, k=draw.randint(0, 80))
        rows.append((n, [w for copy in copies for w in (*filler(), *copy)] + filler()))
    docs = spark.createDataFrame([(n, " ".join(text), "x") for n, text in rows], DOCS)
    benchmark = spark.createDataFrame([(n, " ".join(text)) for n, text in items], ITEMS)
    found = {(r.doc_id, r.item_id): r.score for r in D.contaminated(docs, benchmark).collect()}
    expected = {}
    number = {w: k for k, w in enumerate(vocabulary)}
    as_numbers = lambda text: np.array([number[w] for w in text])
    for doc_id, text in rows:
        for item_id, item in items:
            if len(set(item) & set(text)) >= 0.5 * len(set(item)) or len(item) < 16:
                score, first, last = D.align(as_numbers(item), as_numbers(text))
                if score >= D.MIN_SCORE * D.MATCH * len(item):
                    expected[doc_id, item_id] = (score / (D.MATCH * len(item)), text[first : last + 1], item)
    assert len(expected) > 200 and set(found) <= set(expected)
    assert all(found[key] == expected[key][0] for key in found)
    assert len(found) >= 0.97 * len(expected)
    grams = lambda words: {tuple(words[k : k + 3]) for k in range(len(words) - 2)}
    for key in set(expected) - set(found):
        _, passage, item = expected[key]
        assert not grams(passage) & grams(item)


def test_copy_with_a_long_insertion(spark):
    item = [f"a{n}" for n in range(40)]
    text = [*item[:10], "x", *item[11:20], *[f"z{n}" for n in range(30)], *item[20:31], "y", *item[32:]]
    codes = D._Codes()
    own, numbers = codes.of(item), codes.of(["b"] * 50 + text + ["b"] * 50)
    keys = D.gram_keys(own, 3).tolist()
    starts = np.unique([at - keys.index(k) for at, k in enumerate(D.gram_keys(numbers, 3).tolist()) if k in keys])
    score, first, last = D.best_match(own, D.word_masks(own), numbers, starts, 0.5)
    assert (score, first, last) == (plain_score(item, text) / 80, 50, 50 + len(text) - 1) and score > 0.5


def test_words_in_order():
    draw = random.Random(3)
    for _ in range(300):
        item = [draw.randrange(5) for _ in range(draw.randint(1, 20))]
        passage = [draw.randrange(7) for _ in range(draw.randint(0, 30))]
        table = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
        for i, a in enumerate(item):
            for j, b in enumerate(passage):
                table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
        assert D._in_order(D.word_masks(np.array(item)), len(item), passage) == table[-1][-1]


def test_edges(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(None, f"a {item} b", "c"), (1, None, "c"), (2, "", "c"), (3, item, "c"), (3, item, "c"), (4, "two", "c")]
    items = [(1, item), (1, item), (None, "zz yy xx ww"), (5, None), (6, "?!")]
    docs, benchmark = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)
    found = D.contaminated(docs, benchmark).collect()
    assert sorted((r.doc_id or -1, r.item_id, r.score) for r in found) == [(-1, 1, 1.0), (3, 1, 1.0), (3, 1, 1.0)]
    left = D.without_leaks(docs, benchmark)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 4]
    assert D.contaminated(docs.limit(0), benchmark).count() == 0
    assert D.contaminated(docs, benchmark.limit(0)).count() == 0
    assert D.without_leaks(docs, benchmark.limit(0)).count() == len(rows)


def test_short_and_long_texts(spark):
    long = "word " * 100_000 + "alpha beta gamma delta epsilon zeta eta theta"
    docs = spark.createDataFrame([(1, long, None)], DOCS)
    benchmark = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, "alpha"), (3, "mu")], ITEMS)
    found = D.contaminated(docs, benchmark).collect()
    assert sorted((r.item_id, r.first_word, r.last_word) for r in found) == [(1, 100_000, 100_007), (2, 100_000, 100_000)]


def test_edited_copy_of_an_item_that_its_leak_makes_common(spark):
    item = "one two three four five six seven eight nine ten eleven twelve".split()
    place = 5
    edited = " ".join([*item[:place], "other", *item[place + 1 :]])
    # the edited word is the rarest: every rarest n-gram holds it
    rows = [*[(n, " ".join(item), "x") for n in range(20)], *[(n, edited, "x") for n in range(20, 25)]]
    rows += [(n, "nothing of the kind stands here", "x") for n in range(25, 50)]
    found = D.contaminated(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1, " ".join(item))], ITEMS)).collect()
    assert sorted(r.doc_id for r in found) == list(range(25))
    counts = np.array([20 + 5 * (w != item[place]) for w in item])
    assert D.seed_places(counts, 600, D.RARE, D.SEED_WORDS).tolist() == list(range(10))
