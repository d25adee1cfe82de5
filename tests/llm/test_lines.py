from shelfmark.llm import lines as L
from tests.conftest import SF_DIR
from tests.llm.oracle import assert_same


def test_documents_against_sql(spark):
    assert_same(L.op3_line_dedup(spark, SF_DIR), L.OP3_SQL)


def plain(texts, size=3):
    """Windows in a dictionary, documents in order."""
    seen, out = set(), []
    for text in texts:
        lines = (text or "").split("\n")
        keys = [line.strip(" \t\x0b\x0c\r") for line in lines]
        gone = set()
        for at in range(len(lines) - size + 1):
            window = tuple(keys[at : at + size])
            if any(window):
                if window in seen:
                    gone.update(range(at, at + size))
                seen.add(window)
        out.append("\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else text)
    return out


TEXTS = [
    None,
    "",
    "a\nb",
    "a\nb\nc\nd",
    "x\na\nb \nc\ny",
    "x\na\nb \n c\nd\nz",
    "q\nq\nq\nq\nq",
    "\n\n\n\n",
    "\n\n\n\nend",
    "a\nb\nc\na\nb\nc",
    "a\nb\nc\nd",
    "\n".join(f"line {i}" for i in range(30000)),
    "\n".join(f"line {i}" for i in range(0, 30000) if i % 7),
    "line 1\nline 2\nline 3",
]


def test_cases_against_a_dictionary(spark):
    rows = [(n, text, 0 if text is None else len(text), n) for n, text in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n_chars int, at int").repartition(5)
    found = L.dedupe_lines(docs)
    assert found.schema == docs.schema
    got = {r.doc_id: r for r in found.collect()}
    expected = plain(TEXTS)
    assert [got[n].text for n in range(len(TEXTS))] == expected
    assert [got[n].n_chars for n in range(len(TEXTS))] == [len(t or "") for t in expected]


def test_edges(spark):
    rows = [(None, "a\nb\nc", "k"), (1, "a\nb\nc", "l"), (2, "d\ne\nf", None), (2, "d\ne\nf", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string")
    found = L.dedupe_lines(docs)
    assert found.columns == docs.columns
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(
        map(repr, [(None, "a\nb\nc", "k"), (1, "", "l"), (2, "d\ne\nf", None), (2, "d\ne\nf", None)])
    )
    assert L.dedupe_lines(docs.limit(0)).count() == 0
