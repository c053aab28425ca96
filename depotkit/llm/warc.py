"""WARC archives compressed with Zstandard: one frame a record, dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotkit.llm.common import folder_for, written

# Fixed values of the formats: Zstandard's magic numbers, and that of WARC's dictionary frame.
FRAME_MAGIC = 0xFD2FB528
DICTIONARY_FRAME_MAGIC = 0x184D2A5D
REQUIRED_FIELDS = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: An archive ends with the record that brings it beyond this size.
ARCHIVE_BYTES = 16 << 20
#: The dictionary of an archive is trained on so many of its first payloads, from each so many bytes.
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 64, 8192, 16384
DATE = "2024-01-01T00:00:00Z"
ARCHIVE = "path string, content binary"
RECORD = (
    "path string, position long, record_id string, record_type string, target_uri string, payload binary, "
    "payload_bytes long, payload_digest string, refers_to string, error string"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(kind: str, record_id: str, uri: str | None, payload: bytes, digest: str, size: int, refers_to: str | None) -> bytes:
    """One record: a response with its payload, or a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE)]
    fields += [("WARC-Target-URI", "".join(uri.split()))] if uri and uri.strip() else []
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    fields += [("WARC-Refers-To", refers_to), ("WARC-Profile", REVISIT_PROFILE)] if kind == "revisit" else []
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def archive_of(records: list[bytes]) -> bytes:
    """Records as an archive. Without enough to train on there is no dictionary frame."""
    import zstandard

    dictionary = None
    if len(records) >= 8:
        try:
            dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, [r[:SAMPLE_BYTES] for r in records[:SAMPLES]], level=3)
        except zstandard.ZstdError:  # too little or too uniform to train on
            dictionary = None
    out = []
    if dictionary is not None:
        raw = dictionary.as_bytes()
        out.append(struct.pack("<II", DICTIONARY_FRAME_MAGIC, len(raw)) + raw)
    press = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
    out += [press.compress(r) for r in records]
    return b"".join(out)


def _frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, by its block headers."""
    import zstandard

    head = bytes(data[at:at + 18])
    params = zstandard.get_frame_parameters(head)
    at += zstandard.frame_header_size(head)
    last = False
    while not last:
        if at + 3 > len(data):
            raise ValueError("the frame is cut off")
        block = int.from_bytes(data[at:at + 3], "little")
        last, kind, size = bool(block & 1), (block >> 1) & 3, block >> 3
        at += 3 + (1 if kind == 1 else size)
    at += 4 * params.has_checksum
    if at > len(data):
        raise ValueError("the frame is cut off")
    return at


def frames(data: bytes):
    """(position, record bytes or None, error) of each record frame of an archive."""
    import zstandard

    view, at, dictionary = memoryview(data), 0, None
    if len(view) >= 8:
        magic, size = struct.unpack_from("<II", view, 0)
        if magic == DICTIONARY_FRAME_MAGIC:
            raw = bytes(view[8:8 + size])
            if len(raw) < size:
                yield 0, None, "the dictionary frame is cut off"
                return
            if raw[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may itself be compressed
                raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
            dictionary, at = zstandard.ZstdCompressionDict(raw), 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(view):
        if len(view) - at < 8:
            yield at, None, "the archive ends inside a frame"
            return
        magic, size = struct.unpack_from("<II", view, at)
        if 0x184D2A50 <= magic <= 0x184D2A5F:  # any other skippable frame
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            yield at, None, "no Zstandard frame"
            return
        try:
            end = _frame_end(view, at)
            yield at, reader.decompressobj().decompress(view[at:end]), None
            at = end
        except (ValueError, zstandard.ZstdError) as problem:
            yield at, None, str(problem)
            return


def parsed(record: bytes) -> dict:
    """Fields of one record; ``error`` says what is wrong with its headers or lengths."""
    out = dict.fromkeys(("record_id", "record_type", "target_uri", "payload", "payload_bytes", "payload_digest", "refers_to", "error"))
    head, split, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not split or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        return out | {"error": "no WARC header"}
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            return out | {"error": "a header line is not a field"}
        fields.setdefault(name.lower(), value.strip())
    out |= {"record_id": fields.get("warc-record-id"), "record_type": fields.get("warc-type"),
            "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to")}
    if missing := [name for name in REQUIRED_FIELDS if not fields.get(name)]:
        return out | {"error": f"no {missing[0]}"}
    length = fields["content-length"]
    if not (length.isascii() and length.isdigit()) or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        return out | {"error": "the block is not as long as content-length"}
    block, named = rest[:-4], fields.get("warc-payload-digest", "")
    kind, _, told = named.rpartition(":")
    told = told.upper() if told and kind.lower() in ("", "sha1") else None  # other kinds are not checked
    payload, http = block, {}
    if fields.get("content-type", "").startswith("application/http"):
        top, split, payload = block.partition(b"\r\n\r\n")
        if not split:
            return out | {"error": "no HTTP header"}
        http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in top.decode("latin-1").split("\r\n")[1:])}
    if out["record_type"] == "revisit":
        size = http.get("content-length", "")
        if not out["refers_to"] or payload or not named:
            return out | {"error": "a revisit without its response, with a payload or without its digest"}
        return out | {"payload_bytes": int(size) if size.isdigit() else None, "payload_digest": told or named}
    digest = base32_sha1(payload)
    out |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest}
    if fields.get("warc-truncated"):  # cut when it was fetched: neither length nor digest can hold
        return out
    if http.get("content-length", str(len(payload))) != str(len(payload)):
        return out | {"error": "the payload is not as long as its HTTP header says"}
    return out | {"error": None if told in (None, digest) else "the payload does not match its digest"}


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of archives given as (path, content), as Spark's binaryFile source reads them.

    Columns as in RECORD: position is the frame's place in its archive; error is null for a sound
    record, else says what failed. A frame that can't be read ends its archive with one error row,
    as no later frame can be found. ``payloads=False`` leaves the payloads out after checking them.
    A null or empty content has no records; other columns of ``archives`` are left out.
    """

    def rows(path: str, content: bytes):
        for position, record, error in frames(content or b""):
            fields = parsed(record) if error is None else {"error": error}
            fields["payload"] = fields.get("payload") if payloads else None
            yield {"path": path, "position": position} | fields

    def run(batches):
        schema = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())) for n, t in (x.split() for x in RECORD.split(", "))])
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held, size = [], 0
                for row in rows(path, content.as_py()):
                    held.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return archives.select("path", "content").mapInArrow(run, RECORD)


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes (record_type, record_id, target_uri, payload, payload_digest, payload_bytes, refers_to)
    as .warc.zst files below ``folder`` and gives their (path, bytes).

    Each task rolls its records into archives of about ARCHIVE_BYTES. A file's name holds its task
    attempt, so a repeated task never meets a half-written file; the written table of paths names
    the files of the attempts that count.
    """
    names = ["record_type", "record_id", "target_uri", "payload", "payload_digest", "payload_bytes", "refers_to"]

    def run(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(base, recursive=True)
        task, count = TaskContext.get(), 0

        def rolled(records):
            nonlocal count
            name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{count:05d}.warc.zst"
            count += 1
            data = archive_of(records)
            with store.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(data)
            return pa.RecordBatch.from_pylist([{"path": name, "bytes": len(data)}], pa.schema([("path", pa.string()), ("bytes", pa.int64())]))

        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                kind, record_id, uri, payload, digest, length, refers_to = row
                held.append(record_bytes(kind, record_id, uri, payload or b"", digest, length, refers_to))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield rolled(held)
                    held, size = [], 0
        if held:
            yield rolled(held)

    return written(records.select(*names).mapInArrow(run, "path string, bytes long"), "archive-names")


def load_archives(names: DataFrame, folder: str) -> DataFrame:
    """(path, content) of the files of ``folder`` that ``names`` holds."""
    files = names.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    files = files.withColumn("name", F.substring_index("path", "/", -1)).select("path", "name", "content")
    return files.join(names.select(F.col("path").alias("name")), "name", "left_semi").select("path", "content")


def page_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Records of pages (page_id, url, html), for ``write_archives``.

    Of pages with equal payloads of at least ``min_bytes`` bytes, those with the smallest page_id
    are responses and the others revisit it. A null html is an empty payload. Rows that repeat the
    smallest page_id are all responses; a page without page_id is one only if no equal page has one.
    Digests are folded before they meet the payloads.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), payload.alias("payload"))
    own = own.withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    first = own.filter(F.col("payload_bytes") >= min_bytes).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    again = written(first.filter("n > 1").select("sha1", "first"), "repeated-payloads")
    own = own.join(again, "sha1", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    return own.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), urn("page_id").alias("record_id"), "target_uri",
        F.when(~revisit, F.col("payload")).alias("payload"), F.col("sha1"), "payload_bytes", F.when(revisit, urn("first")).alias("refers_to"))


def with_digest(records: DataFrame) -> DataFrame:
    """Adds payload_digest, the SHA-1 in upper-case base32, from its hex form in ``sha1``."""
    bits = F.conv  # five hex digits are twenty bits, so four base32 digits
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = []
    for k in range(8):
        number = bits(F.substring("sha1", 5 * k + 1, 5), 16, 10).cast("int")
        groups += [F.substring(F.lit(letters), F.shiftright(number, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return records.withColumn("payload_digest", F.concat(*groups)).drop("sha1")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Pages written to archives and read back: the records as ``read_archives`` gives them, without payloads."""
    folder = folder_for(pages, "warc")
    names = write_archives(with_digest(page_records(pages)), folder)
    if names.isEmpty():
        return names.sparkSession.createDataFrame([], RECORD)
    return read_archives(load_archives(names, folder), payloads=False)


def _page_id(urn: str):
    return F.regexp_extract(urn, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def op1_query(spark, sf_dir: str) -> DataFrame:
    """A record per page, as read back from the archives."""
    back = archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return back.select(_page_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       _page_id("refers_to").alias("refers_to"), "error")
