import gzip
import io

import pytest

from shelfmark.llm import warc as W
from shelfmark.storage import fresh_path
from tests.conftest import SF_DIR
from tests.llm.oracle import assert_same

SCHEMA = "page_id long, url string, html string, kind int"


def test_pages_against_sql(spark):
    assert_same(W.op6_warc(spark, SF_DIR), W.OP6_SQL)


PAYLOADS = ["", "x", "WARC/1.1\r\n\r\nWARC/1.1\r\n", "é" * 9000, "0\r\n\r\n" * 20000, "<p>" * 70000, "\r\n\r\n"]


def test_round_trip(spark):
    rows = [(n, f"http://h/{n}\r\nX: é {n}", text, n) for n, text in enumerate(PAYLOADS)]
    rows += [(n + 100, "http://again", text, n) for n, text in enumerate(PAYLOADS)]
    path = fresh_path(spark, "archive")
    W.write_warc(spark.createDataFrame(rows, SCHEMA), path, min_revisit_bytes=1, segment_bytes=1000)
    back = {r.page_id: r for r in W.read_warc(spark, path).collect()}
    assert len(back) == len(rows)
    for n, text in enumerate(PAYLOADS):
        first, second = back[n], back[n + 100]
        assert bytes(first.payload).decode() == text and first.fault is None
        assert first.kind == "response" and second.kind == ("revisit" if text else "response")
        assert second.payload_bytes == len(text.encode()) and second.digest == first.digest
        assert second.refers_to_record == (first.record_id if text else None)


def test_edges(spark):
    rows = [(None, None, None, 1), (5, None, "", 1), (5, None, "", 1), (7, "u", "a", 1), (None, "v", "a", 2)]
    path = fresh_path(spark, "archive")
    frame = spark.createDataFrame(rows, SCHEMA)
    W.write_warc(frame, path)
    back = W.read_warc(spark, path).dropDuplicates(["record_id"]).collect()
    assert sorted((r.page_id or -1, r.kind, r.payload_bytes) for r in back) == [
        (-1, "revisit", 0), (-1, "revisit", 1), (5, "response", 0), (7, "response", 1),
    ]
    empty = fresh_path(spark, "archive")
    W.write_warc(frame.limit(0), empty)
    assert W.read_warc(spark, empty).count() == 0


def _archive(folder, records):
    (folder / "a.warc.gz").write_bytes(b"".join(gzip.compress(r + b"\r\n\r\n") for r in records))
    return str(folder)


def test_damaged_segments_are_told(spark, tmp_path):
    records = W.page_records(1, "u", b"abc" * 2000, None, segment_bytes=1000)
    assert len(records) == 7
    cases = {
        None: records[::-1] + records[2:3],
        "segments missing or doubled": records[:3] + records[4:],
        "total length differs": records[:-1],
        "digest differs": [records[0].replace(b"sha1:", b"sha1:Z")] + records[1:],
    }
    for n, (fault, kept) in enumerate(cases.items()):
        folder = tmp_path / str(n)
        folder.mkdir()
        (row,) = W.read_warc(spark, _archive(folder, kept)).collect()
        assert row.fault == fault
        assert fault is not None or bytes(row.payload) == b"abc" * 2000


@pytest.mark.parametrize("size", [1, 7, 8192])
def test_chunks(size):
    for payload in (b"", b"a", b"\r\n0\r\n\r\n" * 100):
        assert W.dechunked(W.chunked(payload, size)) == payload
    assert W.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for bad in (b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b""):
        with pytest.raises(ValueError):
            W.dechunked(bad)


def test_files_are_plain_warc(spark):
    path = fresh_path(spark, "archive")
    W.write_warc(spark.createDataFrame([(1, "u", "a" * 50000, 0)], SCHEMA), path)
    files = spark.read.format("binaryFile").load(f"{path}/*.gz").collect()
    text = b"".join(gzip.decompress(file.content) for file in files)
    records = list(W.read_records(io.BytesIO(text)))
    assert [f["warc-type"] for f, _ in records] == ["response", "continuation"]
    assert sum(len(b) for _, b in records) == int(records[-1][0]["warc-segment-total-length"])


def _plain(folder, data):
    folder.mkdir()
    (folder / "a.warc").write_bytes(data)
    return str(folder)


def test_damaged_archives_tell_and_go_on(spark, tmp_path):
    good = [W.page_records(n, "u", b"abc%d" % n, None)[0] + b"\r\n\r\n" for n in (1, 2)]
    other = W.page_records(3, "u", b"x" * 50, None)[0]
    cases = {
        "no WARC record": good[0] + b"junk\r\nmore junk\r\n" + good[1],
        "no content length": good[0] + other.replace(b"Content-Length: ", b"Content-Width: ") + b"\r\n\r\n" + good[1],
        "record shorter than stated": good[0] + good[1] + other[:-20],
        "no segment number or length": good[0] + other.replace(b"WARC-Date", b"WARC-Segment-Number: x\r\nWARC-Date") + b"\r\n\r\n" + good[1],
        "unknown transfer coding": good[0] + other.replace(b"Encoding: chunked", b"Encoding: cheered") + b"\r\n\r\n" + good[1],
    }
    for n, (fault, data) in enumerate(cases.items()):
        rows = W.read_warc(spark, _plain(tmp_path / str(n), data)).collect()
        assert sorted(r.page_id for r in rows if r.fault is None) == [1, 2], fault
        assert [r.fault.startswith(fault) for r in rows if r.fault] == [True], fault
    packed = gzip.compress(b"".join(good))
    folder = tmp_path / "cut"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(packed[:-30])
    (folder / "b.warc.gz").write_bytes(packed)
    faults = [r.fault for r in W.read_warc(spark, str(folder)).collect() if r.fault]
    assert faults and all("damaged compression" in f or "shorter" in f for f in faults)
    assert W.read_warc(spark, _plain(tmp_path / "none", b"")).count() == 0
    with pytest.raises(ValueError, match="no WARC record"):
        list(W.read_records(io.BytesIO(b"junk")))


def test_transfer_codings_and_digests(spark, tmp_path):
    import hashlib
    import zlib

    payload = b"some text " * 30
    for codings, body in {
        b"gzip, chunked": W.chunked(gzip.compress(payload), 50),
        b"Chunked": W.chunked(payload),
        b"deflate,chunked": W.chunked(zlib.compress(payload)),
        b"identity": payload,
    }.items():
        assert W.decoded(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: " + codings + b"\r\n\r\n" + body) == (payload, None)
    with pytest.raises(ValueError, match="damaged"):
        W.decoded(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: gzip\r\n\r\nxx")
    sha256 = hashlib.sha256(payload)
    for stated, fits in {
        f"sha256:{sha256.hexdigest()}": True, f"sha256:{'0' * 64}": False, f"sha1:{W.sha1_base32(payload)}": True, "sha1:AAAA": False,
        f"md5:{hashlib.md5(payload).hexdigest().upper()}": True, "blake3:xyz": True, None: True, W.sha1_base32(payload): True,
    }.items():
        assert W.digest_fits(stated, payload) == fits, stated
    record = W.page_records(1, "u", payload, None)[0]
    stated = W.sha1_base32(payload).encode()
    (row,) = W.read_warc(spark, _plain(tmp_path / "a", record.replace(b"sha1:" + stated, b"sha256:" + sha256.hexdigest().encode()))).collect()
    assert row.fault is None and row.digest == sha256.hexdigest()
