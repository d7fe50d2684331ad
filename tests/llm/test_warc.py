"""WARC archives: format, round trip and revisit rules."""

import struct

import pytest
import zstandard
from pyarrow import fs
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.oracle_check import digest
from tidewater.llm import warc
from tidewater.llm.catalog import ORACLES, QUERIES

SCHEMA = "page_id long, url string, html string"


def rows_of(spark, rows, **options):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", payload string, record_type int")
    manifest = warc.write_archives(pages, **options)
    return manifest, warc.read_archives(manifest)


def test_query_like_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF001}/pages.parquet')")
    want = con.execute(ORACLES["op10_warc"]).fetchdf()
    assert digest(QUERIES["op10_warc"](spark, SF001).toPandas())[:3] == digest(want)[:3]


def test_round_trip_nulls_ties_and_long_pages(spark):
    rows = [(5, "http://a", "same"), (3, None, "same"), (9, "bad\r\nurl ", "same"), (4, "http://é", None), (8, "", "")]
    rows += [(20 + i, f"http://p/{i}", "<p>" + "äb" * (i * 50)) for i in range(60)] + [(99, "http://long", "y" * 3_000_000)]
    _, back = rows_of(spark, rows)
    found = {r.page_id: r for r in back.collect()}
    assert len(found) == len(rows)
    for page_id, url, html in rows:
        r, data = found[page_id], (html or "").encode()
        assert r.url == url and r.payload_bytes == len(data)
        first = min(i for i, _, h in rows if (h or "").encode() == data)
        if page_id == first:
            assert r.record_type == "response" and r.refers_to is None and bytes(r.html) == data
        else:
            assert r.record_type == "revisit" and r.refers_to == first and r.html is None


def test_min_payload_and_repeated_ids(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (2, "u", "abcdef"), (2, "u", "abcdef"), (7, "u", "abcdef"), (None, "u", "abcdef")]
    _, back = rows_of(spark, rows, min_payload=3)
    kinds = sorted((r.page_id or -1, r.payload_bytes, r.record_type) for r in back.collect())
    assert kinds == [(-1, 6, "revisit"), (1, 2, "response"), (2, 2, "response"), (2, 6, "response"), (2, 6, "response"), (7, 6, "revisit")]


def test_empty_table(spark):
    manifest, back = rows_of(spark, [])
    assert manifest.count() == 0 and back.count() == 0


def test_file_format(spark):
    """A leading skippable frame with the dictionary, then one frame per record."""
    rows = [(i, f"http://p/{i}", f"<html><body><p>page {i} says the same thing</p></body></html>" * 5) for i in range(300)]
    manifest, _ = rows_of(spark, rows, sample_bytes=20_000)
    entry = manifest.orderBy(F.desc("records")).first()
    store, path = fs.FileSystem.from_uri(entry["file"])
    data = store.open_input_stream(path).read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    raw = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    reader, at, records = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw)), 8 + size, 0
    while at < len(data):
        one = reader.decompressobj()
        record = one.decompress(data[at:])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") and one.eof
        at = len(data) - len(one.unused_data)
        records += 1
    assert records == entry["records"] + 1  # and the warcinfo record


def test_damaged_payload_is_reported():
    record = warc.record_bytes(1, "u", b"abc", "X" * 32, None, "2024-01-01T00:00:00Z")
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    with pytest.raises(ValueError):
        warc.parse_record(fields, block[:-4])
