"""Archives: exact round trip, dictionaries, broken records."""

import struct

import pytest
import zstandard

from depotkit.llm import warc
from depotkit.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, path string, content string, sha1 string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "p") for r in rows], PAGES)


def slow_records(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None and (html or "") not in first or page_id is not None and page_id < first[html or ""]:
            first[html or ""] = page_id
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        leader = first.get(html or "")
        revisit = leader is not None and leader != page_id
        out.append((page_id, len(data), warc.base32_sha1(data), "revisit" if revisit else "response", leader if revisit else None))
    return out


def returned(df):
    return [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()]


def key(row):
    return tuple((v is not None, str(v)) for v in row)


AWKWARD = [(i, f"http://a.example/{i}", f"<p>page {i} " + "some words " * i) for i in range(40)]
AWKWARD += [(100, None, None), (101, " ", ""), (102, "u\r\nX-Bad: 1", "\r\n\r\nWARC/1.1\r\n"), (103, "http://ü/", "日本 🙂" * 50000), (50, "x", AWKWARD[7][2]),
            (7, "again", AWKWARD[7][2]), (None, "x", "no id"), (None, "y", AWKWARD[9][2]), (-5, "z", "no id")]


def through_archives(spark, df):
    back = warc.archive_pages(df)
    return back.select(warc._page_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc._page_id("refers_to").alias("refers_to"), "error")


def test_query_equals_plain_loop(spark, folder):
    got = QUERIES["op1_warc"](spark, folder)
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    assert sorted(returned(got), key=key) == sorted(slow_records(rows), key=key)


def test_awkward_pages(spark):
    got = through_archives(spark, pages(spark, AWKWARD).repartition(3))
    assert got.filter("error is not null").count() == 0
    assert sorted(returned(got), key=key) == sorted(slow_records(AWKWARD), key=key)
    assert through_archives(spark, pages(spark, [])).count() == 0


def test_smaller_payloads_are_all_responses(spark):
    got = warc.page_records(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]), min_bytes=3)
    assert sorted((r.record_id, r.record_type) for r in got.collect()) == [
        ("<urn:page:1>", "response"), ("<urn:page:2>", "response"), ("<urn:page:3>", "response"), ("<urn:page:4>", "revisit")]


def response(n, payload=None):
    payload = f"<html>page {n} {'text ' * n}</html>".encode() if payload is None else payload
    return warc.record_bytes("response", f"<urn:page:{n}>", "http://x/", payload, warc.base32_sha1(payload), len(payload), None)


def test_frames_give_the_records_back():
    records = [response(n) for n in range(60)]
    data = warc.archive_of(records)
    assert struct.unpack_from("<I", data)[0] == warc.DICTIONARY_FRAME_MAGIC
    assert [r for _, r, _ in warc.frames(data)] == records
    assert [r for _, r, _ in warc.frames(warc.archive_of(records[:2]))] == records[:2]  # no dictionary
    size = struct.unpack_from("<I", data, 4)[0]
    packed = zstandard.ZstdCompressor().compress(data[8:8 + size])  # the dictionary may be compressed
    other = struct.pack("<II", warc.DICTIONARY_FRAME_MAGIC, len(packed)) + packed + struct.pack("<II", 0x184D2A50, 3) + b"abc" + data[8 + size:]
    assert [r for _, r, _ in warc.frames(other)] == records
    assert [(r is None, e is None) for _, r, e in warc.frames(data[:-5])][-1] == (True, False)
    assert list(warc.frames(b"")) == []
    assert [e for _, _, e in warc.frames(b"not zstd at all")] == ["no Zstandard frame"]


@pytest.mark.parametrize(("change", "error"), [
    (lambda r: r, None),
    (lambda r: r.replace(b"Digest: sha1:", b"Digest: sha256:"), None),
    (lambda r: r.replace(b"WARC-Type: ", b"WARC-Truncated: length\r\nWARC-Type: ").replace(b"page 3", b"page 4"), None),
    (lambda r: b"HTTP" + r, "no WARC header"),
    (lambda r: r.replace(b"WARC-Date: ", b"X-Date: "), "no warc-date"),
    (lambda r: r + b"x", "the block is not as long as content-length"),
    (lambda r: r[:-4], "the block is not as long as content-length"),
    (lambda r: r.replace(b"WARC-Type: ", b"WARC-Type "), "a header line is not a field"),
    (lambda r: r.replace(b"page 3", b"page 4"), "the payload does not match its digest"),
    (lambda r: r.replace(b"text/html; charset=utf-8\r\nContent-Length: 3", b"text/html; charset=utf-8\r\nContent-Length: 4"), "the payload is not as long as its HTTP header says"),
])
def test_validation(change, error):
    assert warc.parsed(change(response(3)))["error"] == error


def test_reads_files_and_reports_broken_ones(spark, tmp_path):
    records = [response(n) for n in range(12)]
    (tmp_path / "a.warc.zst").write_bytes(warc.archive_of(records))
    (tmp_path / "b.warc.zst").write_bytes(warc.archive_of(records)[:-9])
    (tmp_path / "c.warc.zst").write_bytes(b"")
    got = warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path))).collect()
    good = [r for r in got if r.path.endswith("a.warc.zst")]
    assert sorted(bytes(r.payload) for r in good) == sorted(r.partition(b"\r\n\r\n")[2].partition(b"\r\n\r\n")[2][:-4] for r in records)
    assert all(r.error is None for r in good)
    assert [r.error is None for r in got if r.path.endswith("b.warc.zst")].count(False) == 1
