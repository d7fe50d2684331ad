"""Systematic sampling against a plain Python version, and its odd inputs."""

import math
import re
from collections import defaultdict
from hashlib import md5

from tests.conftest import SF001
from tidewater.llm import mixing
from tidewater.llm.catalog import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string"


def targets(sizes: dict, weights=(5, 2, 1), cap=3) -> dict:
    """Shares by weight, capped, the excess shared again until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    total, fixed, free = sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return fixed | share
        fixed |= {s: float(cap * sizes[s]) for s in over}
        free -= over
    return fixed


def plain(rows):
    sized = [(i, len(WORD.findall(t or "")), s) for i, t, s in rows]
    sizes = defaultdict(int)
    for _, n, s in sized:
        sizes[s] += n
    target, out = targets(sizes), []
    for s in sizes:
        u = int(md5(("mix-1" + ("" if s is None else f":{s}")).encode()).hexdigest()[:6], 16) / 2**24
        rate = target[s] / sizes[s] if sizes[s] else 0.0
        for k, (i, n, _) in enumerate(sorted((r for r in sized if r[2] == s), key=lambda r: (r[1], r[0])), 1):
            copies = min(3, math.floor(k * rate + u) - math.floor((k - 1) * rate + u))
            out.append((i, n, sizes[s], round(target[s], 6), copies * n))
    return sorted(out)


def got(df):
    return sorted((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect())


def test_whole_table(spark):
    import duckdb

    rows = duckdb.connect().execute(f"SELECT doc_id, text, source FROM '{SF001}/documents.parquet'").fetchall()
    found = got(QUERIES["op3_source_mix"](spark, SF001))
    assert found == plain(rows)
    assert found == got(QUERIES["op3_source_mix"](spark, SF001))
    assert all(taken <= 3 * size for _, size, _, _, taken in found)


def test_caps_nulls_ties_and_clashes(spark):
    rows = [(i, "w " * (i % 7), "a") for i in range(200)] + [(1000 + i, "x y", "b") for i in range(3)]
    rows += [(2000, None, None), (2001, "", "empty"), (2002, " \t\n", "empty"), (2003, "one two three", None)]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", size int, target string")
    assert got(mixing.mix(docs)) == plain(rows)


def test_taken_is_near_the_target(spark):
    rows = [(i, "w " * (1 + i * 37 % 400), "abc"[i % 3]) for i in range(3000)]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    for s in "abc":
        own = [r for r in mixed if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) < 1000


def test_one_hot_source_is_spread(spark):
    rows = [(i, "a b c", "hot") for i in range(500)]
    sizes = spark.createDataFrame([(i, "hot", 3) for i, _, _ in rows], "doc_id long, source string, size long")
    ranked = mixing.ranked(sizes, "source", "size", "doc_id").collect()
    assert [r.position for r in sorted(ranked, key=lambda r: r.doc_id)] == list(range(1, 501))


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(docs).count() == 0 and mixing.emit(docs, mixing.mix(docs)).count() == 0


def test_emit_counts_also_with_repeated_ids(spark):
    rows = [(i, "w " * (i + 1), "ab"[i % 2]) for i in range(40)] + [(7, "other text here", "a"), (None, "no id", "b"), (None, "no id two", "b")]
    docs = spark.createDataFrame(rows, SCHEMA)
    mixed = mixing.mix(docs)
    want = sorted((r.doc_id or -1, r["size"]) for r in mixed.collect() for _ in range(r.copies))
    out = mixing.emit(docs, mixed)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or -1, len(r.text.split())) for r in out.collect()) == want
