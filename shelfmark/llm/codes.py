"""Vectors as short codes: each part of a vector becomes the number of its nearest codebook entry."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.storage import fresh_path, remove, stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# members of one (position, entry, salt); an entry with more is spread over more salts
CELL_MEMBERS = 1024
# members that one owner task holds, on average
TASK_MEMBERS = 1 << 20

# below these, squared distances of a part stay within 64 bits; beyond, whole numbers of any size are used
_SMALL, _SHORT = 1 << 16, 1 << 12
_CHUNK = 8192
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    """Entries of each part position, as whole numbers in units of ``1 / SCALE``."""

    dimension: int
    entries: list[list[list[int]]]

    def digest(self) -> str:
        numbers = (str(x) for position in self.entries for entry in position for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def arrays(self) -> list[np.ndarray]:
        width = self.dimension // len(self.entries)
        return [_narrow(np.array(e, object).reshape(len(e), width)) for e in self.entries]


def _narrow(numbers: np.ndarray) -> np.ndarray:
    if numbers.shape[1] <= _SHORT and all(abs(x) < _SMALL * SCALE for x in numbers.flat):
        return numbers.astype(np.int64)
    return numbers


def _integers(values: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` of each component, exactly."""
    if values.shape[1] <= PARTS * _SHORT and (values.size == 0 or np.abs(values).max() < _SMALL):
        return np.floor(values * SCALE).astype(np.int64)
    # a double of 2**53 or more is whole by itself, and must not leave its range
    whole = [math.floor(x * SCALE) if abs(x) < 2.0**53 else int(x) * SCALE for x in values.flat]
    return np.array(whole, object).reshape(values.shape)


def _nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry, the lower one of equals, and the squared distance to it."""
    kind = np.int64 if points.dtype == entries.dtype == np.int64 else object
    chosen, nearest = np.zeros(len(points), np.int64), np.zeros(len(points), kind)
    for at in range(0, len(points), _CHUNK):
        block = points[at : at + _CHUNK]
        distance = np.zeros((len(block), len(entries)), kind)
        for axis in range(points.shape[1]):
            distance += (block[:, axis, None] - entries[None, :, axis]) ** 2
        best = distance.argmin(1)
        chosen[at : at + _CHUNK] = best
        nearest[at : at + _CHUNK] = distance[np.arange(len(block)), best]
    return chosen, nearest


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists as rows of so many numbers, short ones ended by zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    numbers = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return numbers.reshape(len(lengths), width)
    rows = np.zeros((len(lengths), width))
    rows[np.arange(width)[None, :] < lengths[:, None]] = numbers
    return rows


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, embedding)`` without null vectors and those with null or non-finite components."""
    numbers = F.col("embedding").cast("array<double>")
    bad = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select("vec_id", "label", numbers.alias("embedding"))
    return rows.filter(F.col("embedding").isNotNull() & ~bad)


def _first_codebooks(kept: DataFrame, dimension: int, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors with the smallest ids; of equal ids, those with the smaller vector."""
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    padded = np.array([[*r.embedding, *[0.0] * (dimension - len(r.embedding))] for r in rows]).reshape(len(rows), dimension)
    split = _integers(padded).reshape(len(rows), parts, dimension // parts)
    return Codebooks(dimension, [split[:, p].tolist() for p in range(parts)])


_MEMBER = "position int, entry int, salt int, part array<double>"


def _dealt(kept: DataFrame, books: Codebooks, salts: int) -> DataFrame:
    """Every part of every vector as a member of its nearest entry.

    Salts go round by the row's place in its task, so that copies of one vector are spread as well.
    """
    parts, arrays = len(books.entries), books.arrays()
    width = books.dimension // parts

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            values = _matrix(batch.column(0), books.dimension)
            whole = _integers(values).reshape(len(values), parts, width)
            entry = np.stack([_nearest(whole[:, p], arrays[p])[0] for p in range(parts)], 1)
            salt = np.repeat((np.arange(len(values)) + seen) % salts, parts)
            seen += len(values)
            position = np.tile(np.arange(parts), len(values))
            offsets = np.arange(len(values) * parts + 1) * width
            part = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.reshape(-1), pa.float64()))
            numbers = [pa.array(x, pa.int32()) for x in (position, entry.reshape(-1), salt)]
            yield pa.RecordBatch.from_arrays([*numbers, part], ["position", "entry", "salt", "part"])

    return kept.select("embedding").mapInArrow(assigned, _MEMBER)


def _to_owners(members: DataFrame, owners: int) -> DataFrame:
    return members.repartition(owners, "position", "entry", "salt")


def _judged(members: DataFrame, books: Codebooks) -> DataFrame:
    """Members where they are, with their nearest entry now and whether it is another one."""
    parts, arrays = len(books.entries), books.arrays()
    width = books.dimension // parts

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position, before = (batch.column(k).to_numpy() for k in (0, 1))
            whole = _integers(_matrix(batch.column(3), width))
            entry = before.copy()
            for p in np.unique(position):
                entry[position == p] = _nearest(whole[position == p], arrays[p])[0]
            columns = [batch.column(0), pa.array(entry, pa.int32()), batch.column(2), batch.column(3), pa.array(entry != before)]
            yield pa.RecordBatch.from_arrays(columns, ["position", "entry", "salt", "part", "moved"])

    return members.mapInArrow(judged, f"{_MEMBER}, moved boolean")


def _updated(members: DataFrame, books: Codebooks) -> Codebooks:
    """Means of the resident members, rounded down; entries without members stay.

    Each task adds up what lies there, one row per entry. Sums travel as decimal text: they may be of any size.
    """
    parts = len(books.entries)
    width, k = books.dimension // parts, len(books.entries[0])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * k, width), np.int64), np.zeros(parts * k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column(0).to_numpy().astype(np.int64) * k + batch.column(1).to_numpy()
            whole = _integers(_matrix(batch.column(3), width))
            order = np.argsort(cell, kind="stable")
            begins = np.flatnonzero(np.append(True, np.diff(cell[order]) > 0))
            here = cell[order][begins]
            part_sums = np.add.reduceat(whole[order], begins, axis=0)
            if part_sums.dtype == object and sums.dtype != object:
                sums = sums.astype(object)
            sums[here] += part_sums
            counts += np.bincount(cell, minlength=parts * k)
        used = np.flatnonzero(counts)
        totals = [[str(int(x)) for x in sums[c]] for c in used]
        columns = [pa.array(used // k, pa.int32()), pa.array(used % k, pa.int32()), pa.array(counts[used], pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(totals, pa.list_(pa.string()))], ["position", "entry", "n", "sums"])

    def means(frame: pd.DataFrame) -> pd.DataFrame:
        n = int(frame["n"].sum())
        mean = [str(sum(map(int, axis)) // n) for axis in zip(*frame["sums"], strict=True)]
        return pd.DataFrame({"position": frame["position"].iloc[:1], "entry": frame["entry"].iloc[:1], "mean": [mean]})

    partial = members.mapInArrow(added, "position int, entry int, n long, sums array<string>")
    found = partial.groupBy("position", "entry").applyInPandas(means, "position int, entry int, mean array<string>")
    entries = [list(position) for position in books.entries]
    # a row per entry of a position, whatever the input
    for row in found.collect():
        entries[row.position][row.entry] = [int(x) for x in row.mean]
    return Codebooks(books.dimension, entries)


def fit_codebooks(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, cell_members: int = CELL_MEMBERS
) -> Codebooks | None:
    """Codebooks of every part position by rounds of Lloyd's algorithm over all vectors; None without any.

    Parts live with the owner of their (position, entry, salt). Owners update entries from the members
    that lie with them; in the next round members are judged in place, and only those whose entry
    changed are shuffled to their new owner. Every state is a table in the shared folder.
    """
    spark = vectors.sparkSession
    kept = kept_vectors(vectors)
    n, longest = kept.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    if not n:
        return None
    dimension = -(-longest // parts) * parts
    books = _first_codebooks(kept, dimension, parts, entries)
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * parts // TASK_MEMBERS))
    members, states = None, []
    for _ in range(rounds):
        if members is None:
            states.append(fresh_path(spark, "members"))
            members = stage(_to_owners(_dealt(kept, books, -(-n // cell_members)), owners), states[-1])
        else:
            judged, arrived = fresh_path(spark, "judged"), fresh_path(spark, "arrived")
            _judged(members, books).write.partitionBy("moved").parquet(judged)
            rows = spark.read.schema(f"{_MEMBER}, moved boolean").parquet(judged)
            moved = stage(_to_owners(rows.filter("moved").drop("moved"), owners), arrived)
            members = rows.filter("NOT moved").drop("moved").unionByName(moved)
            while states:
                remove(spark, states.pop())
            states += [judged, arrived]
        books = _updated(members, books)
    for state in states:
        remove(spark, state)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``(vec_id, label, code, error)`` of every kept vector by finished codebooks; nothing is shuffled."""
    parts, arrays = len(books.entries), books.arrays()
    width = books.dimension // parts

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column(2), books.dimension)
            whole = _integers(values).reshape(len(values), parts, width)
            chosen = np.zeros((len(values), parts), np.uint8)
            error = np.zeros(len(values), object)
            for p in range(parts):
                chosen[:, p], distance = _nearest(whole[:, p], arrays[p])
                error += distance.astype(object)
            codes = [row.tobytes().hex() for row in chosen]
            errors = pa.array([int(e) if e <= _LONG else None for e in error], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()), errors], ["vec_id", "label", "code", "error"])

    kept = kept_vectors(vectors)
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    return kept.mapInArrow(encoded, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with ``approximation``, the vector that its code stands for."""
    flat = F.lit([[float(x) / SCALE for x in entry] for position in books.entries for entry in position])
    k = len(books.entries[0])

    def part(p: int):
        entry = F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
        return F.element_at(flat, entry + (p * k + 1))

    return codes.withColumn("approximation", F.flatten(F.array(*[part(p) for p in range(len(books.entries))])))


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, cell_members: int = CELL_MEMBERS
) -> DataFrame:
    """Code and error of every kept vector, the error of its label, and the digest of the codebooks.

    Null vectors and those with null or non-finite components are dropped. Vectors shorter than the
    longest one, empty ones included, and lengths that ``parts`` does not divide, count as ended by
    zeros. Ties of distance go to the lower entry; of equal ids the smaller vector comes first as a
    seed, null ids last; with fewer vectors than entries there are fewer entries. Repeated rows count
    each. Components of any finite size are exact; an error beyond 64 bits is null, and so is its
    label's. Null labels are one label. Other columns are not read; an empty table gives no rows.
    """
    if entries > 256:
        raise ValueError("a code holds two hex digits per part: at most 256 entries")
    spark = vectors.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in kept_vectors(vectors).schema}
    books = fit_codebooks(vectors, parts, entries, rounds, cell_members)
    if books is None:
        schema = f"vec_id {kinds['vec_id']}, code string, error long, label_error long, codebooks_sha256 string"
        return spark.createDataFrame([], schema)
    rows = stage(encode(vectors, books), fresh_path(spark, "codes"))
    total = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)")))
    sums = rows.groupBy(F.col("label").alias("of_label")).agg(total.try_cast("long").alias("label_error"))
    joined = rows.join(sums, rows["label"].eqNullSafe(sums["of_label"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op12_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _lloyd_sql(rounds: int) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"""d{r} AS (
  SELECT rid, p, e, sum((x - c) * (x - c)) AS d FROM parts JOIN b{r} USING (p, i) GROUP BY rid, p, e),
a{r} AS (SELECT rid, p, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM d{r} GROUP BY rid, p)"""
        )
        if r < rounds:
            steps.append(
                f"""s{r} AS (
  SELECT p, e, i, sum(x) AS s, count(*) AS n FROM a{r} JOIN parts USING (rid, p) GROUP BY p, e, i),
b{r + 1} AS (
  SELECT p, e, i, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
  FROM b{r} LEFT JOIN s{r} USING (p, e, i))"""
            )
    return ",\n".join(steps)


OP12_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
places AS (
  SELECT rid, v, len(v) // 16 AS w, unnest(range(len(v))) AS k FROM kept),
parts AS (SELECT rid, k // w AS p, k % w AS i, v[k + 1] AS x FROM places),
b0 AS (SELECT p, rid - 1 AS e, i, x AS c FROM parts WHERE rid <= 64),
{_lloyd_sql(ROUNDS)},
coded AS (
  SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d) AS error FROM a{ROUNDS} GROUP BY rid),
by_label AS (
  SELECT label, sum(error) AS label_error FROM coded JOIN kept USING (rid) GROUP BY label),
book AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) AS digest FROM b{ROUNDS})
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(label_error AS BIGINT) AS label_error,
  digest AS codebooks_sha256
FROM coded JOIN kept USING (rid) JOIN by_label ON by_label.label IS NOT DISTINCT FROM kept.label CROSS JOIN book
"""
