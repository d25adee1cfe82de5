"""Reply trees as conversations: paths by doubling self-joins, ranked by score, in one template."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.storage import fresh_path, stage

# The template, and control strings of this and other common templates.
TURN, END = "<|turn|>", "<|end|>\n"
TRAINED_ROLE = "assistant"
_CONTROL = r"(?=\||/?s>|</?SYS>>|/?INST\])"
_ESCAPE = rf"([<\[])(\\*){_CONTROL}"
_UNESCAPE = rf"([<\[])\\(\\*){_CONTROL}"


def escape(text: Column) -> Column:
    """No control string is left: a backslash stands behind its first character.

    Where backslashes stand there already, it is one more, so ``unescape`` gives back every text.
    """
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2")


def _escape_role(role: Column) -> Column:
    """Roles end at the line's end, so a line break inside one is encoded as well."""
    encoded = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escape(encoded)


def _unescape_role(role: Column) -> Column:
    plain = unescape(role)
    return F.replace(F.replace(plain, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _key(value: Column, otherwise: Column) -> Column:
    """A join key that tells null from every value."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), otherwise)


def _nodes(replies: DataFrame, conv: str, node: str, parent: str, role: str, text: str, score: str | None) -> DataFrame:
    content = F.concat_ws(
        "\n", F.lit("~"), *[_key(F.col(c), F.lit("~")) for c in (parent, role, text)]
    )
    rows = replies.select(
        F.col(conv).alias("conv_id"),
        _key(F.col(conv), F.lit("~")).alias("conv"),
        _key(F.col(node), F.sha1(content)).alias("node"),
        _key(F.col(parent), F.lit(None)).alias("parent"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        (F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)).alias("score"),
    )
    one = F.min(F.struct(F.col("parent").isNull(), "parent", "role", "text", "score", "conv_id"))
    return rows.groupBy("conv", "node").agg(one.alias("x")).select("conv", "node", "x.parent", "x.role", "x.text", "x.score", "x.conv_id")


def _reach(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Jump tables of doubling reach, and ``(conv, node, turns, total)``: every node's way from its root.

    In round k a node knows the one 2^k steps above it, and the turns and scores of the steps between;
    a self-join doubles that for those who have not come to their root. So no table has more than a
    row per message, and n turns take log2(n) rounds. Chains of parents that never end (loops) are
    left out. Each round lies in the shared folder.
    """
    spark = nodes.sparkSession
    known = nodes.select("conv", F.col("node").alias("parent"), F.lit(True).alias("there"))
    # a parent that is not in the table makes its reply a root
    above = F.when(F.col("there"), F.col("parent")).alias("above")
    first = nodes.join(known, ["conv", "parent"], "left")
    own = first.select("conv", "node", above, F.lit(1).cast("long").alias("turns"), F.col("score").alias("total"))
    paths = [fresh_path(spark, "reach")]
    rounds = [stage(own, paths[0])]
    largest = nodes.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    step = 1

    def ended() -> DataFrame:
        return spark.read.schema(rounds[0].schema).parquet(*paths).filter("above IS NULL")

    while step < largest and not (last := rounds[-1].filter("above IS NOT NULL")).isEmpty():
        over = last.unionByName(ended()).select(
            "conv", F.col("node").alias("above"), F.col("above").alias("top"), F.col("turns").alias("more"), F.col("total").alias("rest")
        )
        longer = last.join(over, ["conv", "above"]).select(
            "conv",
            "node",
            F.col("top").alias("above"),
            (F.col("turns") + F.col("more")).alias("turns"),
            (F.col("total") + F.col("rest")).alias("total"),
        )
        paths.append(fresh_path(spark, "reach"))
        rounds.append(stage(longer, paths[-1]))
        step *= 2
    jumps = [r.filter("above IS NOT NULL").select("conv", "node", "above") for r in rounds]
    return jumps, ended().select("conv", "node", "turns", "total")


def _listed(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """``(conv, leaf, node, up)``: every node on the paths of the chosen leaves, ``up`` steps above the leaf.

    Round k joins what is known, up to 2^k steps above each leaf, with the nodes 2^k steps further up,
    so the rows are those of the chosen paths.
    """
    spark = chosen.sparkSession
    parts = [fresh_path(spark, "paths")]
    found = stage(chosen.select("conv", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up")), parts[0])
    for k, jump in enumerate(jumps):
        parts.append(fresh_path(spark, "paths"))
        further = found.join(jump, ["conv", "node"])
        stage(further.select("conv", "leaf", F.col("above").alias("node"), (F.col("up") + (1 << k)).alias("up")), parts[-1])
        found = spark.read.schema(found.schema).parquet(*parts)
    return found


def format_reply_trees(
    replies: DataFrame,
    conv: str = "conv_id",
    node: str = "node_id",
    parent: str = "parent_id",
    role: str = "role",
    text: str = "text",
    score: str | None = None,
    best: int | None = 1,
) -> DataFrame:
    """One row per chosen root-to-leaf path: ``conv_id, branch, path_score, n_turns, formatted, pieces, loss_mask``.

    Branches of a tree are ranked by the mean score of their turns, ties by the leaf; ``best`` keeps
    that many of them; None keeps all, unranked. Leaves are ranked before any path is listed, so only
    chosen paths have a row per turn. ``pieces`` are the parts of ``formatted`` in order; those with
    ``trained`` are the assistant texts, which the loss covers. ``loss_mask`` are the same as ranges
    of bytes of ``formatted`` in UTF-8.

    Null roles and texts are empty, null scores zero. Rows without a conversation id form one
    conversation of their own. A row without a node id is a reply that nobody answered, a row without
    a parent, or whose parent is missing, a root. Of rows that repeat a node, the first by parent,
    role and text counts. Loops of parents have no root and come out nowhere. Other columns are not
    read. An empty table gives no rows. Built-in functions only.
    """
    spark = replies.sparkSession
    nodes = stage(_nodes(replies, conv, node, parent, role, text, score), fresh_path(spark, "nodes"))
    jumps, ended = _reach(nodes)
    answered = jumps[0].select("conv", F.col("above").alias("node"))
    leaves = ended.join(answered, ["conv", "node"], "left_anti")
    leaves = leaves.select("conv", F.col("node").alias("leaf"), (F.col("total") / F.col("turns")).alias("path_score"))
    if best is None:
        chosen = leaves.withColumn("branch", F.lit(None).cast("int"))
    else:
        first = Window.partitionBy("conv").orderBy(F.desc("path_score"), "leaf")
        chosen = leaves.withColumn("branch", F.row_number().over(first)).filter(F.col("branch") <= best)
    chosen = stage(chosen, fresh_path(spark, "chosen"))
    turn = _listed(chosen, jumps).join(nodes, ["conv", "node"]).select(
        "conv", "leaf", "conv_id", (-F.col("up")).alias("at"),
        F.concat(F.lit(TURN), _escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("said"),
        (F.col("role") == TRAINED_ROLE).alias("trained"),
    )
    size = F.octet_length("head") + F.octet_length("said") + len(END)
    before = Window.partitionBy("conv", "leaf").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = turn.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.octet_length("head"))
    collected = placed.groupBy("conv", "leaf").agg(
        F.first("conv_id").alias("conv_id"),
        F.array_sort(F.collect_list(F.struct("at", "head", "said", "trained", "start"))).alias("turns"),
    )

    def pieces(t: Column) -> Column:
        marks = [F.struct(part.alias("text"), F.lit(False).alias("trained")) for part in (t["head"], F.lit(END))]
        return F.array(marks[0], F.struct(t["said"].alias("text"), t["trained"].alias("trained")), marks[1])

    trained = F.filter("turns", lambda t: t["trained"])
    span = lambda t: F.struct(t["start"].alias("start"), F.octet_length(t["said"]).cast("long").alias("n_bytes"))
    return collected.join(chosen, ["conv", "leaf"]).select(
        "conv_id",
        "branch",
        "path_score",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["said"], F.lit(END))), "").alias("formatted"),
        F.flatten(F.transform("turns", pieces)).alias("pieces"),
        F.transform(trained, span).alias("loss_mask"),
    )


def parse(formatted: Column) -> Column:
    """Array of ``(role, text)`` of the turns in a formatted conversation."""

    def turn(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        role = F.substring(head, F.lit(len(TURN) + 1), F.length(head))
        text = F.substring(part, F.length(head) + 2, F.length(part))
        return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))

    parts = F.split(formatted, r"\Q" + END + r"\E")
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def thread(messages: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages in a row as a reply tree without branches: each answers the one before it.

    Null turns come first, ties go by role and text.
    """
    order = Window.partitionBy(conv).orderBy(turn, "role", "text")
    rows = messages.select(conv, turn, "role", "text").withColumn("node_id", F.row_number().over(order))
    return rows.withColumn("parent_id", F.expr("nullif(node_id - 1, 0)"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of one that holds control strings, read back from the output."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").cast(given.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(TRAINED_ROLE).alias("role"),
        F.lit(said).alias("text"),
    )
    formatted = format_reply_trees(thread(given.unionByName(extra)))
    formatted = formatted.drop("pieces").withColumn("utf8", F.encode("formatted", "UTF-8"))
    formatted = stage(formatted, fresh_path(spark, "formatted"))
    turns = F.transform(parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    covered = lambda m: F.substring("utf8", (m["start"] + 1).cast("int"), m["n_bytes"].cast("int"))
    trained = F.transform("loss_mask", lambda m: unescape(F.decode(covered(m), "UTF-8")))
    return formatted.select(
        "conv_id",
        F.size(parse(F.col("formatted"))).cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(F.array_join(trained, "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join(trained, ""), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# the same digests straight from the rows; only the escaping of control strings is repeated
OP4_SQL = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{TRAINED_ROLE}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{TRAINED_ROLE}'), '')) AS loss_sha256,
  CAST(sum({len(TURN) + 1 + len(END)} + length(role) + length(text)
    + len(regexp_extract_all(text, '[<\[]\\*(?:\||/?s>|</?SYS>>|/?INST\])'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""
