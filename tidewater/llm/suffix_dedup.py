"""Removal of every byte of a 200-byte string that occurs more than once in the corpus.

Candidates first, exactly: each 200-byte window is represented by its anchor,
the ``GRAM``-byte string inside it with the smallest hash.  Equal windows have
equal anchors, so only windows whose anchor occurs twice can repeat.  The windows
of one anchor occurrence are consecutive; they and the bytes they reach are one
*snippet*, and equal snippets are one row with a count from the start (all
windows of a snippet that occurs twice repeat).

The remaining distinct snippets of anchors with several are dealt to shards by
anchor.  A shard's snippets, one text, are suffix-sorted by the external induced
sorting of ``induced``: disk-backed queues carry suffixes and common-prefix
values.  A window repeats if its suffix has a common prefix of at least 200
bytes with a neighbour in that order.  A shard may be far larger than its
queues' memory; an anchor with more than ``HOT`` distinct snippets (a passage
that a large part of the documents holds, at its edges) is not sorted in one
shard but decided by counting 128-bit hashes of its windows, which partial
aggregation spreads.

The spans of the repeated windows are merged per document and cut out.

Rows equal in id and text are one row in all of this, found by counting ids and
text hashes; their own text is one span, all of it, and the spans are joined
back to every row.

Defined results
  null text is empty.  Texts shorter than 200 bytes are kept whole.  Equal rows
  are documents each, so a text of 200 bytes or more that is there twice is
  removed from both.  A doc_id with different texts: each row is treated by its
  own text.  Empty table: no rows.  Input columns other than the id and text are
  ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import induced
from .common import kept_lineage, stored
from .shingles import mix, powers

WINDOW = 200
GRAM = 64
HOT = 20_000
#: Snippet bytes of a shard, about; its suffix order takes some 60 bytes of memory or disk for each.
SHARD_BYTES = 2 << 20
PIECE = 4 << 20
BROADCAST_IDS = 1_000_000


def anchors(data: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of each anchor occurrence."""
    parts = []
    for at in range(0, max(0, len(data) - window + 1), PIECE):
        part = _anchors(data[at : at + PIECE + window - 1], window, gram)
        parts.append((part[0], part[1] + at, part[2]))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _anchors(data: np.ndarray, window: int, gram: int):
    up, down = powers.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    hashes = mix((total[gram:] - total[:-gram]) * down[: len(data) - gram + 1])
    # The smallest 40 hash bits, then the leftmost place.
    low = (hashes & ~np.uint64((1 << 24) - 1)) | np.arange(len(hashes), dtype=np.uint64)
    width, size = window - gram + 1, 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
    place = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return hashes[place[starts]], starts, np.diff(np.append(starts, len(place)))


def _bytes(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid else np.zeros(0, np.uint8)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows with the key by which intermediate tables find a text again."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).alias("doc_id"), data.alias("data"))
    return rows.withColumn("key", F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.xxhash64("data").alias("hash")))


KEY = "struct<id:string,hash:bigint>"


def anchor_rows(keyed: DataFrame) -> DataFrame:
    """``key, anchor, start, n`` of every anchor occurrence."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keys, data = batch.column("key"), batch.column("data")
            index, found, held = [], [], 0
            for i in range(batch.num_rows):
                h, start, n = anchors(_bytes(data[i]))
                index.append(np.full(len(h), i))
                found.append((h, start, n))
                held += len(h)
                if held >= 1 << 16 or i == batch.num_rows - 1:
                    h, start, n = (np.concatenate(x) for x in zip(*found, strict=True))
                    columns = [keys.take(pa.array(np.concatenate(index))), pa.array(h.view(np.int64)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "anchor", "start", "n"])
                    index, found, held = [], [], 0

    return keyed.where(F.octet_length("data") >= WINDOW).select("key", "data").mapInArrow(run, f"key {KEY}, anchor long, start int, n int")


def _ids_of(rows: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """Distinct keys, marked for broadcast if they are few (about 50 bytes each)."""
    keys = kept_lineage(rows.select("key").distinct())
    return F.broadcast(keys) if keys.count() <= limit else keys


def snippets(keyed: DataFrame, repeated: DataFrame) -> DataFrame:
    """``key, anchor, start, n, digest, snippet`` of the occurrences in ``repeated``."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            keys, data, places = batch.column("key"), batch.column("data"), batch.column("places")
            for i in range(batch.num_rows):
                text = data[i].as_py()
                own = places[i].values
                start, n = own.field("start").to_pylist(), own.field("n").to_pylist()
                cut = [text[s : s + c + WINDOW - 1] for s, c in zip(start, n, strict=True)]
                columns = [keys.take(pa.array(np.full(len(cut), i))), own.field("anchor"), own.field("start"), own.field("n")]
                columns += [pa.array([xxhash.xxh3_128_digest(c) for c in cut], pa.binary()), pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "anchor", "start", "n", "digest", "snippet"])

    places = repeated.groupBy("key").agg(F.collect_list(F.struct("anchor", "start", "n")).alias("places"))
    known = keyed.join(_ids_of(repeated), "key", "left_semi").select("key", "data")
    return known.join(places, "key").mapInArrow(run, f"key {KEY}, anchor long, start int, n int, digest binary, snippet binary")


def repeated_windows(cuts: list[bytes], sizes: list[int], window: int = WINDOW, memory: int = induced.MEMORY) -> Iterator[tuple[int, np.ndarray]]:
    """For each of distinct snippets its windows (their first ``sizes`` places) that
    occur in the list more than once, found in the order of all their suffixes."""
    lengths = np.array([len(c) for c in cuts], np.int64)
    begins = np.concatenate(([0], np.cumsum(lengths + 1)))
    text = np.zeros(begins[-1] + 1, np.int16)
    for c, at in zip(cuts, begins, strict=False):
        text[at : at + len(c)] = np.frombuffer(c, np.uint8)
        text[at : at + len(c)] += 2
        text[at + len(c)] = 1
    again = np.zeros(len(text), bool)
    above = None
    for positions, after in induced.suffixes(text, window, memory):
        # ``after`` is shared with the larger neighbour, which came just before.
        hit = after >= window
        again[positions[hit]] = True
        again[positions[:-1][hit[1:]]] = True
        if hit[0]:
            again[above] = True
        above = positions[-1]
    for i, (at, n) in enumerate(zip(begins, sizes, strict=False)):
        yield i, np.flatnonzero(again[at : at + n])


def _runs(places: np.ndarray) -> list[tuple[int, int]]:
    """Consecutive places as (first, last)."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.append(0, cut + 1)].tolist(), places[np.append(cut, len(places) - 1)].tolist(), strict=True))


RUN = "anchor long, digest binary, first int, last int"


def _batch(rows):
    import pyarrow as pa

    columns = zip(*rows, strict=True) if rows else ([], [], [], [])
    kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["anchor", "digest", "first", "last"])


def sorted_shards(distinct: DataFrame, shards: int) -> DataFrame:
    """Runs of repeated windows of distinct snippets, from one suffix order per shard."""

    def run(batches: Iterator) -> Iterator:
        names, cuts, sizes = [], [], []
        for batch in batches:
            names += zip(batch.column("anchor").to_pylist(), batch.column("digest").to_pylist(), strict=True)
            sizes += batch.column("n").to_pylist()
            cuts += batch.column("snippet").to_pylist()
        if not cuts:
            return
        rows = []
        for i, places in repeated_windows(cuts, sizes):
            rows += [(*names[i], a, b) for a, b in _runs(places)]
            if len(rows) >= 50_000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)

    dealt = distinct.select("anchor", "digest", "n", "snippet").repartition(shards, "anchor")
    return dealt.mapInArrow(run, RUN)


def counted_windows(distinct: DataFrame) -> DataFrame:
    """The same for snippets of hot anchors, by counting hashes of windows."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for anchor, digest, n, cut in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "n", "snippet")), strict=True):
                made = [xxhash.xxh3_128_digest(cut[i : i + WINDOW]) for i in range(n)]
                columns = [pa.array([anchor] * n, pa.int64()), pa.array([digest] * n, pa.binary()), pa.array(range(n), pa.int32()), pa.array(made, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "digest", "first", "w"])

    rows = distinct.select("anchor", "digest", "n", "snippet").mapInArrow(run, "anchor long, digest binary, first int, w binary")
    many = rows.groupBy("anchor", "w").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor", "w")
    return rows.join(many, ["anchor", "w"], "left_semi").select("anchor", "digest", "first", F.col("first").alias("last"))


def repeated_spans(keyed: DataFrame, shard_bytes: int = SHARD_BYTES, hot: int = HOT) -> DataFrame:
    """``key, spans``: the merged byte ranges [from, to) of repeated windows per text."""
    spark = keyed.sparkSession
    found = anchor_rows(keyed).where("anchor IS NOT NULL").repartition("anchor")
    # Reads every column behind the same filter, so both sides of the join share one exchange.
    twice = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.max(F.xxhash64("key", "start", "n")).alias("row"))
    twice = twice.where("c > 1 AND row IS NOT NULL").select("anchor")
    repeated = stored(found.join(twice, "anchor"), "dedup-anchors")
    cut = stored(snippets(keyed, repeated), "dedup-snippets")

    # Equal snippets are one; anchors with several distinct ones go to the sort.
    classes = cut.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("key", "start")).alias("at"), F.max("n").alias("n"))
    classes = stored(classes, "dedup-classes")
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("windows")).where("kinds > 1")
    several = stored(several, "dedup-several")
    ones = classes.join(several, "anchor").select("anchor", "digest", "kinds", F.col("at.key").alias("key"), F.col("at.start").alias("start"))
    distinct = cut.join(ones, ["anchor", "digest", "key", "start"]).dropDuplicates(["anchor", "digest"])
    distinct = stored(distinct.select("anchor", "digest", "kinds", "n", "snippet"), "dedup-distinct")
    load = several.where(F.col("kinds") <= hot).agg(F.sum(F.col("windows") + WINDOW * F.col("kinds"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-load // shard_bytes))
    runs = sorted_shards(distinct.where(F.col("kinds") <= hot), shards)
    if several.where(F.col("kinds") > hot).limit(1).count():
        runs = runs.union(counted_windows(distinct.where(F.col("kinds") > hot)))
    runs = stored(runs, "dedup-runs")

    occurrences = cut.select("key", "anchor", "digest", "start", "n")
    whole = occurrences.join(classes.where("c > 1").select("anchor", "digest"), ["anchor", "digest"], "left_semi")
    whole = whole.select("key", F.col("start").alias("a"), (F.col("start") + F.col("n") - 1).alias("b"))
    single = classes.where("c = 1").select("anchor", "digest", F.col("at.key").alias("key"), F.col("at.start").alias("start"))
    some = runs.join(single, ["anchor", "digest"]).select("key", (F.col("start") + F.col("first")).alias("a"), (F.col("start") + F.col("last")).alias("b"))

    def merge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = []
            for row in batch.column("runs").to_pylist():
                spans = []
                for a, b in sorted((r["a"], r["b"] + WINDOW) for r in row):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                made.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(made, pa.list_(pa.list_(pa.int32())))], names=["key", "spans"])

    per = whole.union(some).groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    return per.mapInArrow(merge, f"key {KEY}, spans array<array<int>>")


def _spans(keyed: DataFrame) -> DataFrame:
    """``key, spans`` of all rows, equal ones once."""
    long = keyed.where(F.octet_length("data") >= WINDOW)
    copies = long.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.max(F.octet_length("data")).alias("n")).where("c > 1")
    copies = stored(copies.select("key", "n"), "dedup-copies")
    many = copies.count()
    if not many:
        return repeated_spans(keyed)
    keys = copies.select("key")
    keys = F.broadcast(keys) if many <= BROADCAST_IDS else keys
    firsts = stored(long.join(keys, "key", "left_semi").select("key", "data").dropDuplicates(["key"]), "dedup-firsts")
    others = long.join(keys, "key", "left_anti").select("key", "data")
    found = repeated_spans(others.unionByName(firsts)).join(keys, "key", "left_anti")
    whole = F.array(F.array(F.lit(0), F.col("n"))).cast("array<array<int>>")
    return found.unionByName(copies.select("key", whole.alias("spans")))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` (binary) of every document."""
    keyed = _keyed(docs, doc_id, text)
    spans = stored(_spans(keyed), "dedup-spans")

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            data, spans, start, held, made = batch.column("data"), batch.column("spans"), 0, 0, []
            for i in range(batch.num_rows):
                value, own = data[i].as_py(), spans[i].as_py()
                ends = [0, *[x for s in own for x in s], len(value)]
                made.append(b"".join(value[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)))
                held += len(value)
                if held >= 8 << 20 or i == batch.num_rows - 1:
                    columns = [c.slice(start, len(made)) for c in (batch.column("doc_id"), batch.column("n_bytes"), spans)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])
                    start, held, made = i + 1, 0, []

    few = spans.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("spans")).alias("s")).first()
    small = few["n"] + (few["s"] or 0) <= BROADCAST_IDS
    joined = keyed.join(F.broadcast(spans) if small else spans, "key", "left")
    size = F.octet_length("data").cast("long").alias("n_bytes")
    plain = joined.where("spans IS NULL").select("doc_id", size, F.array().cast("array<array<int>>").alias("spans"), F.col("data").alias("kept"))
    rows = joined.where("spans IS NOT NULL").select("doc_id", size, "spans", "data")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return plain.union(rows.mapInArrow(cut, f"doc_id {kind}, n_bytes long, spans array<array<int>>, kept binary"))
