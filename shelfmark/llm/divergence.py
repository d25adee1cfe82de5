"""How the word frequencies of sources differ, exactly, with terms travelling as digests only."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.storage import fresh_path, stage

MIN_DOCUMENTS = 10
TOP = 10
UNIT = 1_000_000_000
DIGEST_BITS = 64

# (source, term) pairs that a task counts before it hands them on
HELD_PAIRS = 1_000_000
# bytes of one text that are split at a time
CHUNK = 1 << 22
# numbers in one block of terms x sources
BLOCK = 1 << 20


def _separators() -> bytes:
    """A byte table: letters and all beyond ASCII stay, upper-case letters turn, anything else separates."""
    return bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in bytes(range(256)).lower())


def _words(data: bytes) -> Iterator[list[bytes]]:
    """Terms of a UTF-8 text, long texts in portions cut where no term goes on."""
    plain, at = data.translate(_separators()), 0
    while at < len(plain):
        end = len(plain) if len(plain) - at <= CHUNK else plain.find(b" ", at + CHUNK)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def term_partials(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, first, n, docs)`` as each task met them; null texts and names are empty.

    ``first`` marks one row of each term a task hands on, which is all that a dictionary needs. A
    row without a term stands for each (lang, source) met.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            known: set[bytes] = set()
            for (lang, source), (n, with_term) in held.items():
                terms = [None, *n]
                first = [t is not None and t not in known for t in terms]
                known.update(n)
                names = [pa.array([name], pa.string()).take(pa.array(np.zeros(len(terms), np.int64))) for name in (lang, source)]
                counts = [pa.array([0, *c], pa.int64()) for c in (n.values(), map(with_term.__getitem__, n))]
                columns = [*names, pa.array(terms, pa.binary()), pa.array(first), *counts]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "first", "n", "docs"])
            held.clear()

        pairs = 0
        for batch in batches:
            for lang, source, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                n, with_term = held.setdefault((lang, source), (Counter(), Counter()))
                before, met = len(n), set()
                for words in _words(text):
                    n.update(words)
                    met.update(words)
                with_term.update(met)
                pairs += len(n) - before
                if pairs > HELD_PAIRS:
                    yield from handed()
                    pairs = 0
        yield from handed()

    empty = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source", "text")}
    rows = docs.select(empty["lang"].alias("lang"), empty["source"].alias("source"), empty["text"].cast("binary").alias("text"))
    found = rows.mapInArrow(counted, "lang string, source string, term binary, first boolean, n long, docs long")
    return found.withColumn("term", F.col("term").cast("string"))


def _digest(bits: int) -> Column:
    full = F.xxhash64("term")
    return F.when(F.col("term").isNotNull(), full if bits >= 64 else F.pmod(full, F.lit(1 << bits)))


def _names(partials: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """``(digest, split, term)`` of every term, and those of shared digests alone.

    The smallest and the largest term of a digest differ if several terms share it; these are
    numbered in order, and the number splits the digest.
    """
    said = partials.filter("first")
    ends = stage(said.groupBy("digest").agg(F.min("term").alias("lowest"), F.max("term").alias("highest")), path)
    alone = ends.filter("lowest = highest").select("digest", F.lit(0).alias("split"), F.col("lowest").alias("term"))
    shared = ends.filter("lowest <> highest").select("digest")
    terms = said.join(shared, "digest", "left_semi").select("digest", "term").distinct()
    numbered = terms.select("digest", F.row_number().over(Window.partitionBy("digest").orderBy("term")).alias("split"), "term")
    return alone.unionByName(numbered), numbered


def _share(count: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """``1 + floor(UNIT * (count + 2) / (total + 2 * kept))``, a thousand at a time: UNIT times a count may not fit."""
    below = total + 2 * kept
    value, rest = np.divmod(count + 2, below)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, below)
        value = value * 1000 + more
    return 1 + value


def _compared(kept: DataFrame, top: int) -> DataFrame:
    """From kept terms with the counts of their sources: sums per pair of sources, and the best terms.

    A task adds up its terms for each pair, which stay as many as the pairs however many terms there
    are, and hands on of each source the terms that reach its ``top`` in a batch, equal ones included.
    """

    def blocks(batch: pa.RecordBatch) -> Iterator[tuple]:
        column = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
        langs = column["lang"].dictionary_encode()
        number = langs.indices.to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            rows = np.flatnonzero(number == k)
            groups = column["groups"][int(rows[0])].values
            sources, totals = groups.field("source"), groups.field("total").to_numpy()
            size = max(1, BLOCK // max(1, len(sources)))
            for at in range(0, len(rows), size):
                some = pa.array(rows[at : at + size])
                counts = column["counts"].take(some)
                within, numbers = counts.flatten().field("source"), counts.flatten().field("n").to_numpy()
                table = np.zeros((len(some), len(sources)), np.int64)
                owner = np.repeat(np.arange(len(some)), np.diff(counts.offsets.to_numpy()))
                table[owner, pc.index_in(within, value_set=sources).to_numpy()] = numbers
                keys = [column[c].take(some).to_numpy() for c in ("digest", "split")]
                yield lang, sources, totals, column["kept_terms"][int(rows[0])].as_py(), table, keys

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[pa.Array, np.ndarray]] = {}
        names = ["lang", "source", "other", "digest", "split", "value"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64()]
        for batch in batches:
            found: list[list] = [[] for _ in names]
            for lang, sources, totals, kept_terms, table, (digest, split) in blocks(batch) if batch.num_rows else ():
                share = _share(table, totals[None, :], kept_terms)
                whole = _share(table.sum(1), totals.sum(), kept_terms)[:, None]
                _, pairs = sums.setdefault(lang, (sources, np.zeros((len(sources), len(sources)), np.int64)))
                for a in range(len(sources) - 1):
                    one, others = share[:, a : a + 1], share[:, a + 1 :]
                    pairs[a, a + 1 :] += ((one - others) ** 2 // (one + others)).sum(0)
                value = np.where((table > 0) & (share > whole), (share - whole) ** 2 // (share + whole), -1)
                for a, name in enumerate(sources.to_pylist()):
                    least = max(0, int(np.partition(value[:, a], -top)[-top])) if len(value) > top else 0
                    at = np.flatnonzero(value[:, a] >= least)
                    for column, more in zip(found, ([lang] * len(at), [name] * len(at), [None] * len(at), digest[at], split[at], value[at, a]), strict=True):
                        column.extend(more)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds, strict=True)], names)
        for lang, (sources, pairs) in sums.items():
            listed = sources.to_pylist()
            a, b = np.triu_indices(len(listed), 1)
            columns = [[lang] * len(a), [listed[x] for x in a], [listed[x] for x in b], [None] * len(a), [None] * len(a), pairs[a, b]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = "lang string, source string, other string, digest long, split int, value long"
    return kept.select("lang", "digest", "split", "counts", "groups", "kept_terms").mapInArrow(compared, schema)


def kept_terms(partials: DataFrame, shared: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``(lang, digest, split, docs, counts)`` of each language's kept terms, ``counts`` by source.

    One shuffle of digests and numbers, by term: the sums by source and those over all of them follow
    in place.
    """
    rows, key = partials.filter("digest IS NOT NULL"), ["lang", "digest"]
    if not shared.isEmpty():
        names = shared.select(F.col("digest").alias("of"), F.col("term").alias("named"), F.col("split").alias("number"))
        rows = rows.join(names, (F.col("digest") == F.col("of")) & (F.col("term") == F.col("named")), "left")
        rows, key = rows.withColumn("split", F.coalesce("number", F.lit(0))), [*key, "split"]
    by_source = (
        rows.select(*key, "source", "n", "docs")
        .repartition(*key)
        .groupBy(*key, "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    counts = F.collect_list(F.struct("source", "n")).alias("counts")
    by_term = by_source.groupBy(*key).agg(F.sum("docs").alias("docs"), counts)
    by_term = by_term.filter(F.col("docs") >= min_documents)
    return by_term if "split" in key else by_term.withColumn("split", F.lit(0))


def _groups(partials: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, kept_terms, groups)``: every source of a language with its occurrences of kept terms."""
    met = partials.filter("digest IS NULL").select("lang", "source").distinct()
    each = kept.select("lang", F.explode("counts").alias("c"))
    totals = each.groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("total"))
    listed = met.join(totals, ["lang", "source"], "left").groupBy("lang")
    sources = F.sort_array(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total"))))
    n = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept_terms"))
    return listed.agg(sources.alias("groups")).join(n, "lang", "left").fillna(0, ["kept_terms"])


def divergence(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP, digest_bits: int = DIGEST_BITS
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how sources of a language differ in their terms.

    Part ``pair`` has every other source of the language, part ``term`` up to ``top`` terms that the
    source uses more than its language does. Null texts, languages and sources are empty strings, and
    an empty name is a name. Equal values are ranked by item; terms equal to the last in rank are
    compared by their text, so ties are exact. Repeated rows count each, ids are not read, extra
    columns neither; an empty table gives no rows, a source without terms still has its pairs.

    Counting shuffles digests of fixed width. Each task's terms go along once, to find the smallest and
    largest of each digest: where these differ, the digest is split by term. The text of a term is
    joined back for rows of the result alone.
    """
    spark = docs.sparkSession
    partials = stage(term_partials(docs).withColumn("digest", _digest(digest_bits)), fresh_path(spark, "term-partials"))
    names, shared = _names(partials, fresh_path(spark, "term-ends"))
    kept = stage(kept_terms(partials, shared, min_documents), fresh_path(spark, "kept-terms"))
    groups = stage(_groups(partials, kept), fresh_path(spark, "source-groups"))
    found = stage(_compared(kept.join(groups, "lang"), top), fresh_path(spark, "compared"))

    ahead = found.filter("other IS NOT NULL").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    back = ahead.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value")
    listed = groups.select("lang", F.explode("groups.source").alias("source"), F.col("groups.source").alias("others"))
    every = listed.select("lang", "source", F.explode("others").alias("other")).filter("source <> other")
    pairs = every.join(ahead.unionByName(back), ["lang", "source", "other"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), F.coalesce("value", F.lit(0)).alias("value"))

    of_group = Window.partitionBy("lang", "source")
    candidates = found.filter("other IS NULL").withColumn("place", F.rank().over(of_group.orderBy(F.desc("value"))))
    terms = candidates.filter(F.col("place") <= top).join(names, ["digest", "split"])
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    rank = F.row_number().over(of_group.orderBy(F.desc("value"), "item")).alias("rank")
    return pairs.select("*", rank).unionByName(terms.select("*", rank).filter(F.col("rank") <= top))


def op13_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents),
words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM docs),
terms AS (
  SELECT d, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM words),
kept AS (SELECT lang, t FROM terms GROUP BY lang, t HAVING count(DISTINCT d) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
named AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, t, CAST(count(*) AS HUGEINT) AS n FROM terms JOIN kept USING (lang, t) GROUP BY ALL),
totals AS (
  SELECT named.lang, named.source, coalesce(sum(n), 0) AS total
  FROM named LEFT JOIN counts ON counts.lang = named.lang AND counts.source = named.source GROUP BY ALL),
shares AS (
  SELECT totals.lang, totals.source, kept.t, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v) AS p
  FROM totals JOIN kept ON kept.lang = totals.lang JOIN sizes ON sizes.lang = totals.lang
  LEFT JOIN counts ON counts.lang = totals.lang AND counts.source = totals.source AND counts.t = kept.t),
whole AS (
  SELECT lang, t, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // (any_value(total) + 2 * any_value(v)) AS q
  FROM counts JOIN (SELECT lang, sum(total) AS total FROM totals GROUP BY lang) USING (lang) JOIN sizes USING (lang)
  GROUP BY lang, t),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
    coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
  FROM named a JOIN named b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.t = x.t
  GROUP BY a.lang, a.source, b.source),
best AS (
  SELECT lang, source, t AS item, (p - q) * (p - q) // (p + q) AS value
  FROM shares JOIN whole USING (lang, t) WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (
    SELECT lang, source, 'term' AS part, item, value,
      row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM best)
  WHERE rank <= 10)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
"""
