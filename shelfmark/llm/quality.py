"""Line-first cleaning: lines are judged one by one, then the document by what is left of it."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW_WORDS = 5
MIN_WORDS = 10
# a document may repeat at most this share of its words, and lose at most that one, in percent
MAX_REPEATED = 20
MAX_LOST = 50
# punctuation rule: this many marks at least, and more than this percentage of the line's characters
MIN_MARKS = 3
MAX_MARKS = 12
# ... and a line this long has some mark that ends a clause
SENTENCE_WORDS = 10
# navigation rule: this many separators at least, and one to at most so many words
MIN_SEPARATORS = 2
WORDS_PER_SEPARATOR = 4

# ... or a line of up to so many words has menu words only
MENU_LINE = 12

# Character classes and phrases, as regular expressions that Python and SQL share.
SPACE = r"\x09-\x0D\x20"
SYMBOLS = "#*$%&|<>"
MARKS = r"[!#$%&*<>@^_`|~{}=+\\]"
# marks that end a clause, besides what Unicode lists as ends of sentences in any script
CLAUSE = ":;…：；؛"
SEPARATORS = r"\||»|›|•|·|>|/|-|–|—"
MENU_WORDS = "home|about|contact|login|logout|register|search|menu|sitemap|help|faq|next|previous|back|more|share"
BOILERPLATE = (
    "all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|uses cookies"
    "|accept (?:all )?cookies|enable javascript|subscribe to our newsletter|click here|read more"
    "|follow us on|powered by|skip to (?:main )?content|lorem ipsum"
)

# a word of every phrase above; texts without any need no search for phrases
_HINTS = (
    b"reserved", b"terms", b"policy", b"cookies", b"javascript", b"newsletter", b"click",
    b"read more", b"follow", b"powered", b"skip", b"lorem",
)



def _sentence_ends() -> str:
    """A class of the characters with Unicode's property for the end of a sentence, and clause marks."""
    everything = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    return f"[{CLAUSE}{''.join(regex.findall(r'\p{Sentence_Terminal}', everything))}]"


SENTENCE = _sentence_ends()
_MARK, _SENTENCE = re.compile(MARKS), re.compile(SENTENCE)
_SEPARATOR = re.compile(rf"(?<![^{SPACE}])(?:{SEPARATORS})(?![^{SPACE}])")
_MENU = re.compile(rf"(?i)(?:{MENU_WORDS})[.,:]?")
_BOILERPLATE = re.compile(f"(?i){BOILERPLATE}")
_WORD = re.compile(f"[^{SPACE}]+")
_SPACES = " \t\n\x0b\x0c\r"


class Verdict(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lost_words: int
    base_failed: bool
    kept: bool
    cleaned: str


def line_fails(line: str, n_words: int, phrases: bool = True) -> str | None:
    """The first rule that a line of ``n_words`` words breaks, if any."""
    separators = len(_SEPARATOR.findall(line)) if n_words > 1 else 0
    if separators >= MIN_SEPARATORS and WORDS_PER_SEPARATOR * separators >= n_words:
        return "navigation"
    if n_words <= MENU_LINE and all(map(_MENU.fullmatch, _WORD.findall(line))):
        return "navigation"
    marks = len(_MARK.findall(line))
    if marks >= MIN_MARKS and 100 * marks > MAX_MARKS * _letters(line):
        return "punctuation"
    if n_words >= SENTENCE_WORDS and not _SENTENCE.search(line):
        return "punctuation"
    return "boilerplate" if phrases and _BOILERPLATE.search(line) else None


def _letters(text: str) -> int:
    """Code points that belong to words."""
    return len(text) - sum(map(text.count, _SPACES))


def repeated_words(words: list[bytes], size: int = WINDOW_WORDS) -> int:
    """Words inside windows of ``size`` words that occur at least twice."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    joined, starts, ends, at = b" ".join(words), [], [], 0
    for word in words:
        starts.append(at)
        at += len(word)
        ends.append(at)
        at += 1
    windows = [joined[i:j] for i, j in zip(starts[:n], ends[size - 1 :], strict=True)]
    if len(set(windows)) == n:
        return 0
    counts = Counter(windows)
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered[i : i + size] = b"\x01" * size
    return sum(covered)


def judge(text: str | None) -> Verdict:
    text = text or ""
    data = text.encode()
    words = data.split()
    n_words, lowered = len(words), data.lower()
    phrases = any(hint in lowered for hint in _HINTS)
    lost, left, full = 0, [], []
    for line, raw in zip(text.split("\n"), data.split(b"\n"), strict=True):
        own = len(raw.split())
        if own:
            full.append(line)
        if own and line_fails(line, own, phrases):
            lost += own
        else:
            left.append(line)
    repeated = repeated_words(words)
    base_failed = n_words < MIN_WORDS or 100 * repeated > MAX_REPEATED * n_words
    return Verdict(
        n_words,
        _letters(text),
        sum(map(text.count, SYMBOLS)),
        len(full) - len(set(full)),
        repeated,
        lost,
        base_failed,
        not base_failed and 100 * lost <= MAX_LOST * n_words,
        "\n".join(left),
    )


_COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lost_words long"
_VERDICT = f"{_COUNTS}, base_failed boolean, kept boolean"


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cleaned: bool = False) -> DataFrame:
    """Counts and verdict per row of ``docs``, and the text left by the line rules if asked for.

    Lines with words fail by punctuation (too many marks, or a long line without any mark that ends
    a clause), navigation (separators between the words, or menu words only) or boilerplate
    (phrases). A document is kept unless it has under ten words, repeats too much of itself, or
    loses more than half of its words with the failing lines.

    A null or empty text has no words and is rejected. Repeated rows are judged alike, a null id
    stays null, an empty table gives no rows, other columns are not read. Every row is judged on its
    own, so no key is ever hot and nothing is shuffled.
    """
    schema = f"doc_id long, {_VERDICT}" + ", cleaned string" * cleaned
    names = [part.split()[0] for part in schema.split(", ")][1:]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = [judge(text.as_py()) for text in batch.column(1)]
            columns = [pa.array([getattr(v, name) for v in verdicts], _arrow(name)) for name in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(judged, schema)


def _arrow(name: str) -> pa.DataType:
    return {"base_failed": pa.bool_(), "kept": pa.bool_(), "cleaned": pa.string()}.get(name, pa.int64())


def clean_documents(docs: DataFrame) -> DataFrame:
    """Documents that are kept, their failing lines removed; all columns of ``docs``.

    ``n_chars``, where there is one, is the length of the text left. Null texts go with the rejected.
    One pass over the rows, whatever further columns they carry.
    """
    columns, schema = docs.columns, docs.schema
    at = columns.index("text")

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = [judge(text.as_py()) for text in batch.column(at)]
            texts = pa.array([v.cleaned for v in verdicts], pa.string())
            kept = pa.array([v.kept for v in verdicts], pa.bool_())
            yield batch.set_column(at, batch.schema.field(at).with_nullable(True), texts.cast(batch.schema.field(at).type)).filter(kept)

    left = docs.mapInArrow(swept, schema)
    if "n_chars" in columns:
        left = left.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType))
    return left.select(*columns)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    word = f"[^{SPACE}]+"
    return rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}') AS w
  FROM documents
), lines AS (
  SELECT doc_id, line, pos, regexp_extract_all(line, '{word}') AS lw
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs)
), judged AS (
  SELECT doc_id, line, pos, len(lw) AS n,
    len(regexp_extract_all(line, '{MARKS}')) AS marks,
    list_sum(list_transform(lw, lambda x: length(x))) AS chars,
    len(list_filter(lw, lambda x: regexp_full_match(x, '{SEPARATORS}'))) AS seps,
    len(list_filter(lw, lambda x: regexp_full_match(x, '(?i)(?:{MENU_WORDS})[.,:]?'))) AS menu,
    regexp_matches(line, '{SENTENCE}') AS sentence,
    regexp_matches(line, '(?i){BOILERPLATE}') AS boilerplate
  FROM lines WHERE len(lw) > 0
), by_line AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines,
    sum(CASE WHEN marks >= {MIN_MARKS} AND 100 * marks > {MAX_MARKS} * chars
              OR n >= {SENTENCE_WORDS} AND NOT sentence
              OR n > 1 AND seps >= {MIN_SEPARATORS} AND {WORDS_PER_SEPARATOR} * seps >= n
              OR n <= {MENU_LINE} AND menu = n OR boilerplate THEN n ELSE 0 END) AS lost
  FROM judged GROUP BY doc_id
), windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + {WINDOW_WORDS - 1}], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW_WORDS - 2})) AS p FROM docs)
), repeats AS (
  SELECT doc_id, p FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p + k) AS n
  FROM repeats, range(0, {WINDOW_WORDS}) AS r(k) GROUP BY doc_id
), base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[{SYMBOLS}]')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(lost, 0) AS BIGINT) AS n_lost_words
  FROM docs LEFT JOIN by_line USING (doc_id) LEFT JOIN covered c USING (doc_id)
), failed AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM base
)
SELECT *, NOT base_failed AND 100 * n_lost_words <= {MAX_LOST} * n_words AS kept FROM failed
"""


OP2_SQL = _sql()
