"""WARC archives with dictionary-compressed records, and their reader.

``write_archives`` marks repeated payloads as revisits, writes one archive
file per task into shared storage and returns a manifest.  Each file is a
``.warc.zst``: a leading skippable frame (magic 0x184D2A5D) holds a Zstandard
dictionary built from the file's own first records, then every record is a
frame of its own compressed with it, so a record can be read alone.  The
dictionary sample is bounded by ``sample_bytes``; a task holds that sample and
one record, nothing else.

A retried or speculative task writes another file; only files named in the
manifest, which Spark commits, belong to the archive.

Which record is the response is decided on narrow rows (digest, page_id): one
partial minimum per digest, so a payload held by a third of all pages is one
row per task.  Pages are then joined to the repeated digests only, broadcast
up to ``BROADCAST_ROWS`` fixed-size rows and by a shuffle beyond.

Defined results
  null html: empty payload.  null url: empty header, read back as null.
  Repeated page_id among equal payloads: every row with the smallest page_id
  is a response.  null page_id sorts last; if no id is known, all are responses.
  Empty table: no files, no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import uuid
from base64 import b32encode
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept_lineage, shared_path, stored

DICT_MAGIC = 0x184D2A5D
DICT_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20
FILE_BYTES = 1 << 30
LEVEL = 3
#: Rows of (20-byte digest, id) that may be broadcast: about 16 MB.
BROADCAST_ROWS = 200_000
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html binary"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 5 hex digits are 4 base-32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def revisits(pages: DataFrame, min_payload: int = 0, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``page_id, url, payload, payload_digest, refers_to`` (null for responses)."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("payload_digest", sha1_base32(F.col("payload")))
    large = F.octet_length("payload") >= min_payload
    firsts = (
        rows.where(large)
        .groupBy(F.unhex(F.sha1("payload")).alias("_sha1"))
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_sha1", "_first")
    )
    firsts = kept_lineage(firsts)
    if firsts.count() <= broadcast_rows:
        firsts = F.broadcast(firsts)
    key = F.when(large, F.unhex(F.sha1("payload")))
    rows = rows.join(firsts, key == F.col("_sha1"), "left")
    refers = F.when(F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return rows.select("page_id", "url", "payload", "payload_digest", refers.alias("refers_to"))


def _header(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record; a revisit holds the HTTP header but not the payload."""
    response = refers_to is None
    block = HTTP + payload if response else HTTP
    plain = url is not None and url.isprintable() and url == url.strip()
    fields = [
        ("WARC-Type", "response" if response else "revisit"),
        ("WARC-Record-ID", f"<urn:x-page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", url if plain else ""),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if not plain:
        fields.append(("X-Target-JSON", json.dumps(url)))
    if not response:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:x-page:{refers_to}>"),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(fields) + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int = DICT_BYTES):
    """A trained dictionary, or the raw sample where there is too little to train on."""
    import zstandard as zstd

    total = sum(map(len, samples))
    if len(samples) >= 16 and total >= 8 * 1024:
        try:
            return zstd.train_dictionary(min(size, max(1024, total // 8)), samples)
        except zstd.ZstdError:
            pass
    return zstd.ZstdCompressionDict(b"".join(samples)[:size] or b"\r\n\r\n WARC", dict_type=zstd.DICT_TYPE_RAWCONTENT)


def dictionary_frame(dictionary) -> bytes:
    import zstandard as zstd

    body = zstd.ZstdCompressor(level=9).compress(dictionary.as_bytes())
    return struct.pack("<II", DICT_MAGIC, len(body)) + body


class ArchiveWriter:
    """Writes one ``.warc.zst``; the first ``sample_bytes`` of records make its dictionary."""

    def __init__(self, out, date: str, sample_bytes: int = SAMPLE_BYTES, level: int = LEVEL):
        self.out, self.sample_bytes, self.level = out, sample_bytes, level
        info = b"software: tidewater\r\nformat: WARC File Format 1.1\r\n"
        fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date)]
        fields += [("Content-Type", "application/warc-fields"), ("Content-Length", str(len(info)))]
        self.waiting: list[bytes] = [_header(fields) + info + b"\r\n\r\n"]
        self.held, self.records, self.written, self.coder = 0, 0, 0, None

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.coder is not None:
            self._put(self.coder.compress(record))
            return
        self.waiting.append(record)
        self.held += len(record)
        if self.held >= self.sample_bytes:
            self._start()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def _start(self) -> None:
        import zstandard as zstd

        dictionary = build_dictionary(self.waiting)
        self.coder = zstd.ZstdCompressor(level=self.level, dict_data=dictionary)
        self._put(dictionary_frame(dictionary))
        for record in self.waiting:
            self._put(self.coder.compress(record))
        self.waiting = []

    def close(self) -> None:
        if self.coder is None:
            self._start()
        self.out.close()


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_archives(
    pages: DataFrame,
    path: str | None = None,
    min_payload: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    sample_bytes: int = SAMPLE_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write all pages; the manifest ``file, records, bytes`` of the archive files.

    ``path`` is a folder in storage that all executors reach (default: a new
    one in the shared scratch folder).
    """
    folder = path or shared_path(pages.sparkSession, "warc")

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        store, root = _filesystem(folder)
        writer = name = None

        def done():
            writer.close()
            return pa.RecordBatch.from_pydict({"file": [name], "records": [writer.records], "bytes": [writer.written]})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    store.create_dir(root, recursive=True)
                    writer = ArchiveWriter(store.open_output_stream(f"{root}/{name}"), date, sample_bytes)
                writer.add(record_bytes(*row, date))
                if writer.written >= file_bytes:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()

    rows = revisits(pages, min_payload)
    manifest = rows.mapInArrow(write, "file string, records long, bytes long")
    return stored(manifest, "warc-manifest").select(F.concat(F.lit(folder + "/"), "file").alias("file"), "records", "bytes")


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of one archive, one record in memory."""
    import zstandard as zstd

    magic, length = struct.unpack("<II", stream.read(8))
    if magic != DICT_MAGIC:
        raise ValueError("the archive does not start with a dictionary frame")
    packed = stream.read(length)
    raw = zstd.ZstdDecompressor().decompress(packed)
    text = io.BufferedReader(
        zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(raw)).stream_reader(stream, read_across_frames=True), 1 << 18
    )
    while line := text.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := text.readline()) != b"\r\n":
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[key] = value
        block = text.read(int(fields["Content-Length"]))
        if text.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield fields, block


def _id(value: str | None) -> int | None:
    digits = (value or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(digits) if digits else None


def parse_record(fields: dict[str, str], block: bytes) -> tuple:
    """A row of ``RECORD``; the digest of a response is computed from its payload again."""
    url = json.loads(fields["X-Target-JSON"]) if "X-Target-JSON" in fields else fields["WARC-Target-URI"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    page_id, kind = _id(fields["WARC-Record-ID"]), fields["WARC-Type"]
    if kind == "revisit":
        return page_id, url, int(fields["X-Payload-Length"]), digest, kind, _id(fields["WARC-Refers-To"]), None
    payload = block.partition(b"\r\n\r\n")[2]
    found = b32encode(hashlib.sha1(payload).digest()).decode()
    if found != digest or len(payload) != int(fields["X-Payload-Length"]):
        raise ValueError(f"payload of page {page_id} does not match its digest")
    return page_id, url, len(payload), found, kind, None, payload


def read_archives(manifest: DataFrame, batch_bytes: int = 8 << 20) -> DataFrame:
    """Every response and revisit of the archives as rows of ``RECORD``, a task per file."""
    names = [c.split()[0] for c in RECORD.split(", ")]

    def load(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = dict(zip(names, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()), strict=True))
        for batch in batches:
            for file in batch.column("file").to_pylist():
                store, path = _filesystem(file)
                rows, held = [], 0
                with store.open_input_stream(path) as stream:
                    for fields, block in records_of(stream):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(parse_record(fields, block))
                        held += len(block) + 200
                        if held >= batch_bytes:
                            yield _batch(pa, types, rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(pa, types, rows)

    files = manifest.select("file")
    n = max(1, files.count())
    return files.repartition(n).mapInArrow(load, RECORD)


def _batch(pa, types, rows):
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))
