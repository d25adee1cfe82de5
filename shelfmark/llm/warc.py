"""WARC archives: pages out as records, records back as pages, segments joined and chunks decoded."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.storage import fresh_path, stage

# payloads below this many bytes are stored in full each time
MIN_REVISIT_BYTES = 0
SEGMENT_BYTES = 32 * 1024
CHUNK_BYTES = 8 * 1024
# bounds a file, which one task reads: so many records of up to a segment each
RECORDS_PER_FILE = 2000
# parsed blocks leave a task in batches of about this size
BATCH_BYTES = 8 << 20

# Names from the WARC 1.1 and HTTP 1.1 formats.
CRLF = b"\r\n"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_STATUS = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
DATE = "1970-01-01T00:00:00Z"
_PAGE_FIELD = "X-Page-Id"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing, with the last, empty chunk."""
    parts = (payload[i : i + size] for i in range(0, len(payload), size))
    return b"".join([b"%x\r\n%b\r\n" % (len(p), p) for p in parts]) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of chunked framing; extensions and trailers are passed over, faults raise."""
    at, parts = 0, []
    while True:
        line_end = body.index(CRLF, at)
        size = int(body[at:line_end].split(b";")[0].strip(), 16)
        at = line_end + 2
        if size == 0:
            return b"".join(parts)
        if at + size + 2 > len(body) or body[at + size : at + size + 2] != CRLF:
            raise ValueError("chunk of another length than stated")
        parts.append(body[at : at + size])
        at += size + 2


def record_id(page_id: int | None, url: str | None, digest: str, segment: int = 1) -> str:
    name = f"{page_id}\n{url}\n{digest}\n{segment}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _record(kind: str, name: str, block: bytes, fields: dict[str, object]) -> bytes:
    """A record without the two line ends that close it."""
    head = {"WARC-Type": kind, "WARC-Record-ID": name, "WARC-Date": DATE} | fields
    lines = [f"{k}: {v}".encode() for k, v in head.items() if v is not None]
    lines += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block)]
    return CRLF.join([VERSION, *lines, b"", block])


def page_records(
    page_id: int | None, url: str | None, payload: bytes, refers_to: str | None, segment_bytes: int = SEGMENT_BYTES
) -> list[bytes]:
    """A response in as many segments as it needs, or one revisit record of the one it refers to."""
    digest = sha1_base32(payload)
    name = record_id(page_id, url, digest)
    about = {
        "WARC-Target-URI": None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~"),
        _PAGE_FIELD: page_id,
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    if refers_to is not None:
        fields = about | {"WARC-Refers-To": refers_to, "WARC-Profile": PROFILE}
        return [_record("revisit", name, _STATUS + b"Content-Length: %d\r\n\r\n" % len(payload), fields)]
    block = _STATUS + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        return [_record("response", name, block, about)]
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = [_record("response", name, parts[0], about | {"WARC-Segment-Number": 1})]
    for n, part in enumerate(parts[1:], 2):
        fields = {"WARC-Segment-Origin-ID": name, "WARC-Segment-Number": n}
        if n == len(parts):
            fields["WARC-Segment-Total-Length"] = len(block)
        out.append(_record("continuation", record_id(page_id, url, digest, n), part, fields))
    return out


def write_warc(
    pages: DataFrame,
    path: str,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    segment_bytes: int = SEGMENT_BYTES,
) -> None:
    """Write ``pages(page_id, url, html)`` as gzipped WARC files below ``path``.

    Of pages with one payload of at least ``min_revisit_bytes``, the smallest ``page_id`` holds it
    and the others revisit that record; ties go to the smallest address. Only digests are grouped,
    with a partial minimum per task; the payloads meet none but the list of revisits.

    A null payload is empty. Null ids come after all others, null addresses before; the fields are
    left out. Rows that repeat id, address and payload are one page. Other columns are not read. An
    empty table gives an empty archive.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("sha1", F.sha1("html"))
    narrow = rows.select("page_id", "url", "sha1", F.octet_length("html").alias("n"))
    order = F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "url")
    narrow = stage(narrow.withColumn("place", order), fresh_path(spark, "payload-digests"))
    large = narrow.filter(F.col("n") >= min_revisit_bytes)
    firsts = large.groupBy("sha1", "n").agg(F.min("place").alias("first"))
    revisits = (
        large.join(firsts, ["sha1", "n"])
        .filter(F.col("place") > F.col("first"))
        .select(
            F.col("page_id").alias("p"), F.col("url").alias("u"), F.col("sha1").alias("s"),
            F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"),
            F.lit(True).alias("revisit"),
        )
        .distinct()
    )
    revisits = stage(revisits, fresh_path(spark, "revisits"))
    same = F.col("page_id").eqNullSafe(F.col("p")) & F.col("url").eqNullSafe(F.col("u")) & (F.col("sha1") == F.col("s"))
    joined = rows.join(revisits.hint("merge"), same, "left").select("page_id", "url", "html", "revisit", "first_id", "first_url")

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            ids, urls, htmls, revisit, first_ids, first_urls = batch.columns
            for i, html in enumerate(htmls.cast(pa.binary())):
                payload = html.as_py()
                refers = (
                    record_id(first_ids[i].as_py(), first_urls[i].as_py(), sha1_base32(payload))
                    if revisit[i].as_py()
                    else None
                )
                own = page_records(ids[i].as_py(), urls[i].as_py(), payload, refers, segment_bytes)
                held += own
                size += sum(map(len, own))
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["record"])
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["record"])

    records = joined.mapInArrow(built, "record binary").select(F.col("record").cast("string"))
    options = {"lineSep": "\r\n\r\n", "compression": "gzip", "maxRecordsPerFile": RECORDS_PER_FILE}
    records.write.options(**options).text(path)


def scan_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """Header fields, names in lower case, block and fault of every record in a WARC stream.

    Where no record begins, or a header states no length, reading goes on at the next line that begins
    one. A record that ends early keeps what is there; damaged compression ends the stream.
    """
    line, place = b"", "no WARC record"
    try:
        while line or (line := stream.readline()):
            if not line.strip():
                line = b""
                continue
            if not line.startswith(b"WARC/"):
                yield {}, b"", f"{place}: {line[:40]!r}"
                line = _next_record(stream)
                continue
            fields: dict[str, str] = {}
            while (line := stream.readline()).strip():
                name, _, value = line.decode(errors="replace").partition(":")
                fields[name.strip().lower()] = value.strip()
            stated, line = fields.get("content-length", ""), b""
            if not (stated.isascii() and stated.isdigit()):
                yield fields, b"", "no content length"
                line = _next_record(stream)
                continue
            block = stream.read(int(stated))
            yield fields, block, None if len(block) == int(stated) else "record shorter than stated"
    except (EOFError, OSError, zlib.error) as error:
        yield {}, b"", f"damaged compression: {error}"


def _next_record(stream: BinaryIO) -> bytes:
    while (line := stream.readline()) and not line.startswith(b"WARC/"):
        pass
    return line


def read_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of a sound WARC stream; the first fault raises."""
    for fields, block, fault in scan_records(stream):
        if fault:
            raise ValueError(fault)
        yield fields, block


def _stream(content: bytes) -> BinaryIO:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw


_PARSED = (
    "record_id string, kind string, url string, page_id long, refers_to_record string,"
    " digest string, segment int, origin string, total long, fault string, block binary"
)


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the files below ``path``, continuations by themselves."""
    names = [part.split()[0] for part in _PARSED.split(", ")]

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.binary()]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block, fault in scan_records(_stream(content.as_py())):
                    get = fields.get
                    page, segment, total = (_number(get(name)) for name in (_PAGE_FIELD.lower(), "warc-segment-number", "warc-segment-total-length"))
                    if -1 in (segment, total):
                        fault = fault or "no segment number or length"
                    rows.append((
                        get("warc-record-id"), get("warc-type"), get("warc-target-uri"), None if page == -1 else page,
                        get("warc-refers-to"), get("warc-payload-digest"), segment, get("warc-segment-origin-id"), total, fault, block,
                    ))
                    size += len(block)
                    if size >= BATCH_BYTES:
                        yield out(rows)
                        rows, size = [], 0
                yield out(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{gz,warc,txt}")
    return files.load(path).select("content").mapInArrow(parsed, _PARSED)


def _number(value: str | None) -> int | None:
    """A count in a header; -1 where it is none that 31 bits hold or, for lengths and ids, 63."""
    if value is None:
        return None
    return int(value) if value.isascii() and value.isdigit() and len(value) < 10 else _long(value)


def _long(value: str) -> int:
    whole = value.removeprefix("-")
    fits = whole.isascii() and whole.isdigit() and len(whole) < 20 and abs(int(value)) < 1 << 63
    return int(value) if fits else -1


def decoded(block: bytes) -> tuple[bytes | None, int | None]:
    """Payload of an HTTP response block, its transfer codings taken off, and the length its header states."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(CRLF)[1:])}
    stated = fields.get(b"content-length", b"")
    codings = [c.strip().lower() for c in fields.get(b"transfer-encoding", b"").split(b",") if c.strip()]
    for coding in reversed(codings):
        if coding not in _CODINGS:
            raise ValueError(f"unknown transfer coding {coding.decode(errors='replace')}")
        try:
            body = _CODINGS[coding](body)
        except (EOFError, OSError, zlib.error) as error:
            raise ValueError(f"damaged transfer coding: {error}") from error
    return body, int(stated) if stated.isdigit() else None


_CODINGS = {
    b"chunked": dechunked, b"identity": bytes, b"gzip": gzip.decompress, b"x-gzip": gzip.decompress, b"deflate": zlib.decompress,
}


def digest_fits(stated: str | None, payload: bytes) -> bool:
    """Whether a payload has the digest that is stated, in base32 or hexadecimal; an unknown algorithm tells nothing."""
    algorithm, _, value = (stated or "").rpartition(":")
    name = algorithm.lower().replace("-", "") or "sha1"
    if not value or name not in ("md5", "sha1", "sha256", "sha512"):
        return True
    found = hashlib.new(name, payload)
    return value.upper().rstrip("=") == base64.b32encode(found.digest()).decode().rstrip("=") or value.lower() == found.hexdigest()


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """``(record_id, kind, url, page_id, refers_to_record, digest, payload_bytes, fault[, payload])``.

    Segments are grouped by the record they continue, ordered by number, and must be complete and of
    the total length; one row per response and revisit. Chunked framing is taken off, length and
    digest are verified against the header; what does not fit is told in ``fault``, and the row
    stays. Records in one piece are not shuffled. Continuations without their first record are
    told as faults too; equal copies of a segment count once. A damaged archive gives a row with its
    ``fault`` for each place that cannot be read, a cut record, junk or a header without a length,
    and the records before and after it. A file is one task's, and must be below 2 GiB.
    """
    records = _parsed(spark, path)
    whole = records.filter("fault IS NOT NULL OR segment IS NULL AND kind IN ('response', 'revisit')").select(
        "record_id", "kind", "url", "page_id", "refers_to_record", "digest", F.array("block").alias("blocks"), "fault",
    )
    parts = records.filter("fault IS NULL AND segment IS NOT NULL").withColumn("key", F.coalesce("origin", "record_id"))
    grouped = parts.groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("segment", "block"))).alias("parts"),
        *[F.max(c).alias(c) for c in ("url", "page_id", "digest", "total")],
        F.max(F.when(F.col("origin").isNull(), F.col("kind"))).alias("kind"),
    )
    numbers = F.col("parts.segment")
    size = F.aggregate("parts.block", F.lit(0).cast("long"), lambda n, block: n + F.octet_length(block))
    fault = (
        F.when(numbers != F.sequence(F.lit(1), F.size(numbers)), "segments missing or doubled")
        .when(F.col("total").isNull() | (F.col("total") != size), "total length differs")
    )
    joined = grouped.select(
        F.col("key").alias("record_id"), F.coalesce("kind", F.lit("response")).alias("kind"), "url", "page_id",
        F.lit(None).cast("string").alias("refers_to_record"), "digest",
        F.col("parts.block").alias("blocks"), fault.alias("fault"),
    )
    schema = "record_id string, kind string, url string, page_id long, refers_to_record string, digest string, payload_bytes long, fault string"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, faults, bodies = [], [], []
            kinds, digests, old = batch.column("kind"), batch.column("digest"), batch.column("fault")
            for i, blocks in enumerate(batch.column("blocks")):
                size, fault, body = None, old[i].as_py(), None
                if fault is None:
                    try:
                        body, stated = decoded(b"".join(blocks.as_py()))
                        size = len(body)
                        if kinds[i].as_py() == "revisit":
                            body, size = None, stated
                        elif not digest_fits(digests[i].as_py(), body):
                            fault = "digest differs"
                    except ValueError as error:
                        fault = str(error)
                sizes.append(size)
                faults.append(fault)
                bodies.append(body)
            columns = [batch.column(c) for c in ("record_id", "kind", "url", "page_id", "refers_to_record")]
            columns.append(pa.array([d and d.rpartition(":")[2] for d in digests.to_pylist()], pa.string()))
            columns += [pa.array(sizes, pa.int64()), pa.array(faults, pa.string())]
            names = ["record_id", "kind", "url", "page_id", "refers_to_record", "digest", "payload_bytes", "fault"]
            if payloads:
                columns.append(pa.array(bodies, pa.binary()))
                names.append("payload")
            yield pa.RecordBatch.from_arrays(columns, names)

    return whole.unionByName(joined).mapInArrow(decode, schema + ", payload binary" * payloads)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archive; a revisit's reference is looked up by record."""
    path = fresh_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    back = read_warc(spark, path, payloads=False).dropDuplicates(["record_id"])
    back = stage(back, fresh_path(spark, "warc-index"))
    origin = back.filter("kind = 'response'").select(
        F.col("record_id").alias("origin"), F.col("page_id").alias("refers_to"), F.col("digest").alias("held")
    )
    found = back.join(origin, F.col("refers_to_record") == F.col("origin"), "left")
    sound = F.col("fault").isNull() & ((F.col("kind") == "response") | (F.col("held") == F.col("digest")))
    return found.select(
        "page_id",
        F.when(sound, F.col("payload_bytes")).otherwise(F.raise_error(F.concat(F.lit("bad record "), "record_id"))).cast("long").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
    )


OP6_SQL = """
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages
), firsts AS (SELECT h, min(page_id) AS first FROM digests GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(h, 10 * (i // 8) + 1, 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests JOIN firsts USING (h)
"""
