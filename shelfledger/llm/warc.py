"""WARC archives: written with segments, chunked framing and revisits; read back by reassembling segments.

Archives are written by Spark's text writer (a record's bytes, then the blank lines that end it), so they commit like any
table and can lie in any store. They are read as whole files; ``segment_bytes`` and ``records_per_archive`` bound a file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

SEGMENT_BYTES = 64 * 1024
RECORDS_PER_ARCHIVE = 1000
CHUNK_BYTES = 16 * 1024
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the format.
VERSION = "WARC/1.1"
END_OF_RECORD = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
# Extension fields of these archives: the page's id, the id that a revisit refers to, and the length of its payload.
PAGE_ID, REFERS_TO, PAYLOAD_LENGTH = "X-Page-Id", "X-Refers-To-Page-Id", "X-Payload-Length"


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def chunked(payload: bytes, chunk_bytes: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    parts = (payload[at : at + chunk_bytes] for at in range(0, len(payload), chunk_bytes))
    return b"".join(b"%x\r\n%b\r\n" % (len(part), part) for part in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are dropped. ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";", 1)[0], 16)
        if size == 0:
            return b"".join(parts)
        start = line + 2
        if body[start + size : start + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        parts.append(body[start : start + size])
        at = start + size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response: its body, without chunked framing if it has any."""
    end = block.index(b"\r\n\r\n")
    body = block[end + 4 :]
    return dechunked(body) if re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", block[:end]) else body


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the blank lines that end it. Fields without a value are left out; line breaks cannot enter one."""
    lines = [VERSION]
    lines += [f"{name}: {re.sub(r'[\r\n]+', ' ', str(value))}" for name, value in fields if value is not None]
    lines.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(lines) + END_OF_RECORD).encode() + block


def page_records(page: dict, new_id, segment_bytes: int) -> Iterator[bytes]:
    shared = [("WARC-Date", DATE), ("WARC-Target-URI", page["url"]), (PAGE_ID, page["page_id"])]
    digest = ("WARC-Payload-Digest", f"sha1:{base32(page['sha1'])}")
    http = ("Content-Type", "application/http; msgtype=response")
    first = new_id()
    if page["refers_to"] is not None:
        kind = [("WARC-Type", "revisit"), ("WARC-Record-ID", first), ("WARC-Profile", REVISIT_PROFILE)]
        more = [(REFERS_TO, page["refers_to"]), (PAYLOAD_LENGTH, page["size"]), http]
        yield record([*kind, *shared, digest, *more], HTTP_HEAD)
        return
    block = HTTP_HEAD + chunked(page["payload"])
    segments = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    number = ("WARC-Segment-Number", 1) if len(segments) > 1 else ("WARC-Segment-Number", None)
    yield record([("WARC-Type", "response"), ("WARC-Record-ID", first), *shared, digest, http, number], segments[0])
    for n, segment in enumerate(segments[1:], 2):
        total = len(block) if n == len(segments) else None
        kind = [("WARC-Type", "continuation"), ("WARC-Record-ID", new_id()), ("WARC-Segment-Origin-ID", first)]
        yield record([*kind, *shared, ("WARC-Segment-Number", n), ("WARC-Segment-Total-Length", total)], segment)


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    records_per_archive: int = RECORDS_PER_ARCHIVE,
) -> None:
    """Write a record per page (``page_id``, ``url``, ``html``) as gzipped archives.

    Of pages with equal payloads of at least ``min_bytes`` bytes, the one with the smallest id is a response and the others
    revisit it; shorter ones are all responses. A null page is an empty payload. A null id revisits a page that has one,
    and is a response where none has. Repeated rows with the smallest id are all responses. Other columns are ignored.
    Groups are found by digest and length from counts that are summed before they move; a large group of copies meets its
    one row in a join that adaptive execution splits.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    groups = rows.where(F.col("size") >= min_bytes).groupBy("sha1", "size")
    groups = groups.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    refers_to = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    marked = rows.join(groups, ["sha1", "size"], "left").withColumn("refers_to", refers_to)
    marked = marked.select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
        "sha1",
        "size",
        F.col("refers_to").cast("string").alias("refers_to"),
    )
    run = uuid.uuid4()

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0

        def new_id() -> str:  # a task that runs again names its records alike
            nonlocal count
            count += 1
            return f"<urn:uuid:{uuid.uuid5(run, f'{part}/{count}')}>"

        for batch in batches:
            for page in (row for i in range(0, batch.num_rows, 64) for row in batch.slice(i, 64).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(list(page_records(page, new_id, segment_bytes)))], ["record"])

    records = marked.mapInArrow(render, "record binary").select(F.col("record").cast("string").alias("value"))
    writer = records.write.option("lineSep", END_OF_RECORD).option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_archive).text(folder)


def parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive, plain or gzipped (one member or one per record): fields by lower-case name, block."""
    if archive[:2] == b"\x1f\x8b":
        members = []
        while archive:
            member = zlib.decompressobj(31)
            members.append(member.decompress(archive))
            archive = member.unused_data
        archive = b"".join(members)
    at = archive.find(b"WARC/")
    while at >= 0:
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        start, length = end + 4, int(fields["content-length"])
        if start + length > len(archive):
            raise ValueError("an archive ends inside a record")
        yield fields, archive[start : start + length]
        at = archive.find(b"WARC/", start + length)


ROW = (
    "origin string, segment int, total bigint, page_id string, url string, record_type string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary, block binary, complete boolean"
)
_ROW = pa.schema(
    [("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("page_id", pa.string())]
    + [("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string())]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary()), ("block", pa.binary()), ("complete", pa.bool_())]
)


def _decoded(block: bytes, with_payload: bool) -> dict:
    try:
        payload = payload_of(block)
    except ValueError:
        return {"complete": False}
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    found = {"payload_digest": digest, "payload_bytes": len(payload), "complete": True}
    return found | ({"payload": payload} if with_payload else {})


def _segments(fields: dict[str, str], block: bytes, with_payload: bool) -> dict:
    """A row for a record: decoded if it is whole, with its block if it is a segment."""
    row = {
        "origin": fields.get("warc-segment-origin-id") or fields.get("warc-record-id"),
        "segment": int(fields.get("warc-segment-number", 1)),
        "total": int(t) if (t := fields.get("warc-segment-total-length")) else None,
        "page_id": fields.get(PAGE_ID.lower()),
        "url": fields.get("warc-target-uri"),
        "record_type": fields.get("warc-type"),
        "refers_to": fields.get(REFERS_TO.lower()),
    }
    if row["record_type"] == "revisit":
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        size = fields.get(PAYLOAD_LENGTH.lower())
        return row | {"payload_digest": digest, "payload_bytes": int(size) if size else None, "complete": True}
    if "warc-segment-number" in fields:
        return row | {"block": block}
    return row | _decoded(block, with_payload)


def _joined(rows: list[dict], with_payload: bool) -> dict:
    """One record from its segments in order: whole if they are numbered 1, 2, ... and have the length that is told."""
    first, block = rows[0], b"".join(row["block"] for row in rows)
    numbered = [row["segment"] for row in rows] == list(range(1, len(rows) + 1))
    whole = numbered and len(rows) > 1 and rows[-1]["total"] == len(block)
    return first | {"block": None} | (_decoded(block, with_payload) if whole else {"complete": False})


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per response or revisit of the archives in a folder.

    ``page_id`` (as text), ``url``, ``record_type``, ``payload_digest`` (bare base32 SHA-1 of the payload that was read),
    ``payload_bytes``, ``payload`` (null for revisits, or if not wanted), ``refers_to``, ``complete``: false where a segment
    is missing, the total length differs or the chunked framing is broken; digest, length and payload are null there.
    An empty folder of archives gives no row. Segments are dealt by their origin and sorted by number; a task holds one
    record at a time.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in parsed(content.as_py()):
                    if fields.get("warc-type") in ("response", "revisit", "continuation"):
                        rows.append(_segments(fields, block, with_payload))
                    if len(rows) == 100:
                        yield pa.RecordBatch.from_pylist(rows, _ROW)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, _ROW)

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        slices = (batch.slice(i, 256) for batch in batches for i in range(0, batch.num_rows, 256))
        for part in chain(slices, [None]):
            done = []
            for row in part.to_pylist() if part else [None]:
                if held and (row is None or row["origin"] != held[0]["origin"] or row["block"] is None):
                    done.append(_joined(held, with_payload))
                    held = []
                if row is not None:
                    if row["block"] is None:
                        done.append(row)
                    else:
                        held.append(row)
            if done:
                yield pa.RecordBatch.from_pylist(done, _ROW)

    files = spark.read.format("binaryFile").load(folder).select("content")
    records = files.mapInArrow(parse, ROW).repartition("origin").sortWithinPartitions("origin", "segment")
    return records.mapInArrow(reassemble, ROW).select(
        "page_id", "url", "record_type", "payload_digest", "payload_bytes", "payload", "refers_to", "complete"
    )
