from __future__ import annotations

import base64
import glob
import gzip
import hashlib

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from shelfledger.llm import warc
from shelfledger.llm.queries import op1_warc

BIG = "é\r\n\r\nWARC/1.1\r\n0\r\n\r\n" * 20_000


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@given(st.binary(max_size=300), st.integers(1, 50))
def test_chunked_framing_round_trip(payload, size):
    assert warc.dechunked(warc.chunked(payload, size)) == payload


def test_chunk_extensions_and_trailers():
    assert warc.dechunked(b"3;x=1\r\nabc\r\n0\r\nT: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunked(b"3\r\nabcd\r\n0\r\n\r\n")


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha1 string")


def test_round_trip(spark, tmp_path):
    rows = [(5, "u5", "same", "x"), (2, "u2\r\nX: y", "same", "x"), (9, None, "same", None), (1, "u", BIG, "x")]
    rows += [(3, "", None, "x"), (4, "v", "", "x"), (2, "u2", "same", "x"), (None, "n", "same", "x"), (None, "n", "alone", "x")]
    warc.write_archives(pages(spark, rows), f"{tmp_path}/a", segment_bytes=1000, records_per_archive=50)
    got = warc.read_archives(spark, f"{tmp_path}/a").collect()
    assert len(got) == len(rows) and all(r.complete for r in got)
    by = {(r.page_id, r.url): r for r in got}
    same = digest(b"same")
    assert {(r.page_id, r.record_type, r.refers_to) for r in got if r.payload_digest == same} == {
        ("2", "response", None), ("5", "revisit", "2"), ("9", "revisit", "2"), (None, "revisit", "2"),
    }
    big = next(r for r in got if r.page_id == "1")
    assert bytes(big.payload) == BIG.encode() and big.payload_digest == digest(BIG.encode())
    empty = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in got if r.payload_digest == digest(b"")}
    assert empty == {("3", "response", None, 0), ("4", "revisit", "3", 0)}
    assert by[("5", "u5")].payload_bytes == 4 and (None, "n") in by
    assert len(glob.glob(f"{tmp_path}/a/*.gz")) > 5


def test_lower_bound_on_copies(spark, tmp_path):
    warc.write_archives(pages(spark, [(1, "u", "ab", ""), (2, "u", "ab", ""), (3, "u", "abc", ""), (4, "u", "abc", "")]), f"{tmp_path}/a", min_bytes=3)
    got = warc.read_archives(spark, f"{tmp_path}/a").orderBy("page_id").collect()
    assert [r.record_type for r in got] == ["response", "response", "response", "revisit"]


def test_damaged_records(spark, tmp_path):
    """A missing segment, a wrong total and segments in the wrong order, plain and with a gzip member per record."""
    end = warc.END_OF_RECORD.encode()
    page = {"page_id": "1", "url": "u", "payload": b"x" * 500, "sha1": hashlib.sha1(b"x" * 500).hexdigest(), "size": 500, "refers_to": None}
    ids = iter(f"<r{n}>" for n in range(100))
    one, two, three = ([r + end for r in warc.page_records(page | {"page_id": str(n)}, lambda: next(ids), 100)] for n in (1, 2, 3))
    del two[2]
    three[-1] = three[-1].replace(b"Total-Length: ", b"Total-Length: 1")
    (tmp_path / "a.warc").write_bytes(b"".join(reversed(one)))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in [*two, *three]))
    got = warc.read_archives(spark, str(tmp_path)).orderBy("page_id").collect()
    assert [(r.page_id, r.complete, r.payload_bytes) for r in got] == [("1", True, 500), ("2", False, None), ("3", False, None)]


def test_empty_table(spark, tmp_path):
    warc.write_archives(pages(spark, []), f"{tmp_path}/a")
    assert warc.read_archives(spark, f"{tmp_path}/a").collect() == []


def test_query_against_the_pages(spark):
    folder = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{folder}/pages.parquet").collect()
    first: dict[str, int] = {}
    for r in sorted(source, key=lambda r: r.page_id):
        first.setdefault(r.html or "", r.page_id)
    got = {r.page_id: r for r in op1_warc(spark, folder).collect()}
    assert len(got) == len(source)
    for r in source:
        payload, origin = (r.html or "").encode(), first[r.html or ""]
        expected = (len(payload), digest(payload), *(("response", None) if origin == r.page_id else ("revisit", origin)))
        assert (got[r.page_id].payload_bytes, got[r.page_id].payload_digest, got[r.page_id].record_type, got[r.page_id].refers_to) == expected
