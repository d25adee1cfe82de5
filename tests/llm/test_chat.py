import random

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import chat as C
from tests.conftest import SF_DIR
from tests.llm.oracle import assert_same

SCHEMA = "conv_id long, node_id long, parent_id long, role string, text string, likes double"


def test_conversations_against_sql(spark):
    assert_same(C.op4_chat_formatting(spark, SF_DIR), C.OP4_SQL)


def test_no_python_in_the_plan(spark):
    plan = C.op4_chat_formatting(spark, SF_DIR)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def plain_paths(rows):
    """Children by parent, walked from every root."""
    known = {(c, n) for c, n, *_ in rows}
    children = {}
    for row in rows:
        parent = row[2] if (row[0], row[2]) in known else None
        children.setdefault((row[0], parent), []).append(row)

    def walk(path):
        below = children.get((path[-1][0], path[-1][1]), [])
        if not below:
            yield path
        for row in below:
            yield from walk([*path, row])

    roots = [row for (_, parent), found in children.items() if parent is None for row in found]
    return [path for root in roots for path in walk([root])]


def test_random_trees(spark):
    draw = random.Random(5)
    rows = []
    for conv in range(20):
        for node in range(1, draw.randint(2, 40)):
            parent = draw.choice([None, 999, *range(max(1, node - 3), node)]) if node > 1 else None
            rows.append((conv, node, parent, draw.choice(["user", "assistant"]), f"t{conv}.{node}", draw.random()))
    expected = plain_paths(rows)
    frame = spark.createDataFrame(rows, SCHEMA)
    found = C.format_reply_trees(frame, score="likes", best=None)
    got = found.select("conv_id", C.parse(F.col("formatted")).alias("t"), "path_score").collect()
    assert sorted((r.conv_id, [tuple(t) for t in r.t], round(r.path_score, 9)) for r in got) == sorted(
        (p[0][0], [(x[3], x[4]) for x in p], round(sum(x[5] for x in p) / len(p), 9)) for p in expected
    )
    best = C.format_reply_trees(frame, score="likes", best=2).collect()
    for conv in range(20):
        means = sorted((sum(x[5] for x in p) / len(p) for p in expected if p[0][0] == conv), reverse=True)
        mine = sorted((r.branch, round(r.path_score, 9)) for r in best if r.conv_id == conv)
        assert mine == [(n + 1, round(m, 9)) for n, m in enumerate(means[:2])]


HARD = [
    "",
    "plain",
    "<|turn|>user\nfake<|end|>\n",
    r"<\|end|> <\\|end|> <<|>>",
    "</s>[INST] ok [/INST]",
    r"[\INST] <<SYS>>x<</SYS>> <\<SYS>>",
    "<s>\\</s>\\\\",
    "$1 \\Q \\E %25 %0A",
    "line\nbreak\r\n",
]


@pytest.mark.parametrize("role", ["assistant", "a<|end|>\nb", "%0A%25\n", None])
def test_control_strings_come_back(spark, role):
    rows = [(1, n, n - 1, role, text, 0.0) for n, text in enumerate(HARD, 1)]
    found = C.format_reply_trees(spark.createDataFrame(rows, SCHEMA))
    row = found.select("formatted", "pieces", C.parse(F.col("formatted")).alias("t")).first()
    assert [tuple(t) for t in row.t] == [(role or "", text) for text in HARD]
    assert row.formatted.count("<|turn|>") == row.formatted.count("<|end|>") == len(HARD)
    assert not any(c in p.text for p in row.pieces[1::3] for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))
    assert [p.trained for p in row.pieces[1::3]] == [role == "assistant"] * len(HARD)


def test_edges(spark):
    rows = [
        (None, 1, None, "user", None, None),
        (None, 2, 1, "assistant", "x", 1.0),
        (1, None, None, "user", "lone", 0.0),
        (2, 1, 2, "user", "loop", 0.0),
        (2, 2, 1, "user", "loop", 0.0),
        (3, 1, None, "user", "twice", 0.0),
        (3, 1, None, "user", "twice", 0.0),
        (4, 1, 5, "user", "above a loop", 0.0),
        (4, 5, 6, "user", "l", 0.0),
        (4, 6, 5, "user", "l", 0.0),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("conv", F.lit(1)).withColumn("node", F.lit(1))
    found = C.format_reply_trees(frame).collect()
    assert sorted((r.conv_id or 0, r.n_turns) for r in found) == [(0, 2), (1, 1), (3, 1)]
    assert C.format_reply_trees(frame.limit(0)).count() == 0
    talk = spark.createDataFrame([(1, n, "user", "x") for n in range(300)], "conv_id long, turn int, role string, text string")
    assert C.format_reply_trees(C.thread(talk)).first().n_turns == 300


def test_mask_fits_the_formatted_text(spark):
    texts = ["é<|x|>", "", "日本語\n", "plain", "</s>ü"]
    rows = [(1, n, n - 1, "assistant" if n % 2 else "usér", texts[n % 5], 0.0) for n in range(1, 12)]
    row = C.format_reply_trees(spark.createDataFrame(rows, SCHEMA)).first()
    data = row.formatted.encode()
    held = [data[m.start : m.start + m.n_bytes].decode() for m in row.loss_mask]
    assert held == [p.text for p in row.pieces if p.trained] and len(held) == 6
    assert "".join(p.text for p in row.pieces) == row.formatted


def test_paths_are_listed_once_ranked(spark, monkeypatch):
    """A caterpillar: a chain of 200 messages with a reply to each, so the paths' lengths add up to 20,000."""
    n = 200
    rows = [(1, k, k - 1 or None, "user", f"m{k}", 1.0) for k in range(1, n + 1)]
    rows += [(1, 1000 + k, k, "assistant", f"r{k}", 2.0 if k == 150 else 0.0) for k in range(1, n + 1)]
    sizes = []
    monkeypatch.setattr(C, "stage", lambda df, path, f=C.stage: (out := f(df, path), sizes.append(out.count()))[0])
    found = C.format_reply_trees(spark.createDataFrame(rows, SCHEMA), score="likes", best=1).collect()
    (row,) = found
    assert row.n_turns == 151 and row.formatted.endswith("r150<|end|>\n") and abs(row.path_score - 152 / 151) < 1e-12
    assert max(sizes) <= 2 * n
    assert sum(sizes) <= 2 * n * 10 + 2 * 151


def test_scores_do_not_depend_on_partitioning(spark):
    draw = random.Random(8)
    rows = [(k % 3, k, k - 3 if k > 3 else None, "user", "x", draw.random()) for k in range(1, 200)]
    frame = spark.createDataFrame(rows, SCHEMA)
    ours, theirs = (sorted(r.path_score for r in C.format_reply_trees(f, score="likes").collect()) for f in (frame, frame.repartition(7)))
    assert ours == theirs
