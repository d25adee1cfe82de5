import re

import pytest

from shelfmark.llm import quality as Q
from tests.conftest import SF_DIR
from tests.llm.oracle import assert_same, duck

PROSE = "The quick brown fox jumps over the lazy dog again, and then it sleeps."


def test_documents_against_sql(spark):
    assert_same(Q.op2_quality_rules(spark, SF_DIR), Q.OP2_SQL)


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        (PROSE, None),
        ("Hi!", None),
        ("BUY!! NOW!! CHEAP!!", "punctuation"),
        ("one ### two %%% three &&&", "punctuation"),
        ("a list of quite a few words without any end to it", "punctuation"),
        ("a short heading without an end", None),
        ("Home | News | Sport | Weather", "navigation"),
        ("Home About Contact", "navigation"),
        ("A well-known author - one - wrote this long sentence about dashes and such things.", None),
        ("This site uses cookies.", "boilerplate"),
        ("All Rights Reserved.", "boilerplate"),
    ],
)
def test_line_rules(line, rule):
    assert Q.line_fails(line, len(line.split())) == rule


def test_repeated_words_against_all_windows():
    for text in ["a b c d e f", "a b c d e a b c d e", "x " * 30, "a b c d e z a b c d e q r s t u v", ""]:
        words = text.encode().split()
        windows = [words[i : i + 5] for i in range(len(words) - 4)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
        assert Q.repeated_words(words) == len(covered)


def test_every_phrase_has_a_hint():
    for phrase in re.sub(r"\(\?:[^)]*\)\??", "", Q.BOILERPLATE.replace("(?:use|service)", "use")).split("|"):
        assert any(hint in phrase.encode() for hint in Q._HINTS), phrase


def test_edges(spark):
    long = "\n".join([PROSE] + [f"Word{i} b{i} c{i} d{i} e{i}." for i in range(20000)])
    rows = [
        (None, None, 0, "x"),
        (2, "", 0, "x"),
        (3, PROSE, 3, "x"),
        (3, PROSE, 3, "x"),
        (4, PROSE + "\nHome | News | Sport | Weather", 9, "y"),
        (5, "Home | News | Sport | Weather\n" * 3 + PROSE, 9, None),
        (6, long, 9, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, kept string")
    kept = sorted(map(tuple, Q.clean_documents(docs).collect()))
    assert Q.clean_documents(docs).columns == docs.columns
    assert kept == [
        (3, PROSE, len(PROSE), "x"),
        (3, PROSE, len(PROSE), "x"),
        (4, PROSE, len(PROSE), "y"),
        (6, long, len(long), None),
    ]
    found = Q.quality(docs, cleaned=True).collect()
    assert len(found) == len(rows)
    assert [r.n_words for r in found if r.doc_id in (None, 2)] == [0, 0]
    assert Q.quality(docs.limit(0)).count() == Q.clean_documents(docs.limit(0)).count() == 0


def test_labelled_documents():
    rows = duck().execute("SELECT text, quality FROM documents JOIN labels USING (doc_id)").fetchall()
    verdicts = [(Q.judge(text), quality) for text, quality in rows]
    clean = [v for v, quality in verdicts if quality == 1 and not v.base_failed]
    bad = [v for v, quality in verdicts if quality == 0]
    assert sum(v.kept for v in clean) >= 0.99 * len(clean)
    assert sum(not v.kept for v in bad) >= 0.95 * len(bad)


SENTENCES = {
    "hindi": ("यह एक लंबा वाक्य है जिसमें दस से अधिक शब्द हैं और अंत में विराम है", "।"),
    "urdu": ("یہ ایک لمبا جملہ ہے جس میں دس سے زیادہ الفاظ ہیں اور آخر میں نشان ہے", "۔"),
    "amharic": ("ይህ ከአስር በላይ ቃላት ያለው ረጅም አረፍተ ነገር ነው እና መጨረሻው ላይ ምልክት አለው ብዙ", "።"),
    "armenian": ("Սա երկար նախադասություն է որը ունի տասը բառից ավելի և վերջում կա նշան այստեղ", "։"),
    "burmese": ("ဒါ က စာ ကြောင်း ရှည် တစ် ခု ဖြစ် ပြီး စာ လုံး များ ပါ", "။"),
}


@pytest.mark.parametrize("script", SENTENCES)
def test_sentences_end_in_every_script(script):
    words, end = SENTENCES[script]
    n = len(words.split())
    assert Q.line_fails(f"{words}{end}", n) is None
    assert Q.line_fails(words, n) == "punctuation"
    numbered = "\n".join(f"{' '.join(f'{w}{k}' for w in words.split())}{end}" for k in range(12))
    assert Q.judge(numbered).kept and not Q.judge(numbered.replace(end, "")).kept
