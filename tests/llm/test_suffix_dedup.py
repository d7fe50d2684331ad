"""Suffix sorting and the removal of repeated strings, against plain versions."""

import hashlib
import random

import numpy as np
import pytest

from tests.conftest import SF001
from tidewater.llm import induced, suffix_dedup
from tidewater.llm.catalog import QUERIES


def shared(t, a, b):
    n = 0
    while a + n < len(t) and b + n < len(t) and t[a + n] == t[b + n]:
        n += 1
    return n


@pytest.mark.parametrize("memory,buckets,block", [(64, 1, 1), (64, 1000, 3), (1 << 20, 3, 1000), (1 << 20, 1000, 2)])
def test_suffix_order_and_common_prefixes(monkeypatch, memory, buckets, block):
    """Small blocks, spilled queues, and both ends of the recursion."""
    monkeypatch.setattr(induced, "BLOCK", block)
    rng = random.Random(memory + buckets)
    for trial in range(120):
        t = [rng.randint(1, rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, 50))]
        t = t * (3 if trial % 5 == 0 else 1) + [0]
        blocks = list(induced.suffixes(np.array(t), 10**6, memory, buckets))
        order = np.concatenate([p for p, _ in blocks])[::-1].tolist()
        assert order == sorted(range(len(t)), key=lambda i: t[i:])
        after = np.concatenate([q for _, q in blocks])[::-1].tolist()
        assert after == [shared(t, a, b) for a, b in zip(order, order[1:], strict=False)] + [0]


def brute(rows, window=200):
    count = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        for s in range(len(b) - window + 1):
            count[b[s : s + window]] = count.get(b[s : s + window], 0) + 1
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - window + 1):
            if count[b[s : s + window]] > 1:
                gone[s : s + window] = True
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, key string, spans int")
    out = suffix_dedup.dedup(docs).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in out), key=str)


def test_query(spark):
    import duckdb

    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF001}/documents.parquet'").fetchall()
    assert sorted((tuple(r) for r in QUERIES["op4_suffix_dedup"](spark, SF001).collect()), key=str) == brute(rows)


def passages(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("etaoinsé", k=rng.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(60) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [text(rng.randint(1, 60)) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(shared)[rng.randint(0, 60) :])
        rows.append((i, " ".join(parts)))
    rows += [(100, rows[0][1]), (101, rows[1][1] * 2), (102, "a" * 199), (103, "a" * 200), (104, "b" * 201), (105, "ab" * 300), (106, None), (107, ""), (106, "other " * 80), (None, text(80))]
    return rows + [(200, rows[3][1]), (200, rows[3][1])]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_passages_overlaps_periods_and_repeated_rows(spark, monkeypatch, hot):
    """Also with every anchor treated as a hot one."""
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (suffix_dedup.SHARD_BYTES, hot))
    rows = passages(hot)
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_anchors_are_the_same_in_any_place_and_piece(monkeypatch):
    rng = random.Random(3)
    inner = bytes(rng.randrange(256) for _ in range(700))
    whole = suffix_dedup.anchors(np.frombuffer(inner, np.uint8))
    around = suffix_dedup.anchors(np.frombuffer(b"x" * 1000 + inner + b"y" * 300, np.uint8))

    def of_window(found):
        return {int(s) + k: int(h) for h, s, n in zip(*found, strict=True) for k in range(n)}

    inside = of_window(around)
    assert all(inside[1000 + s] == h for s, h in of_window(whole).items())
    monkeypatch.setattr(suffix_dedup, "PIECE", 128)
    assert of_window(suffix_dedup.anchors(np.frombuffer(inner, np.uint8))) == of_window(whole)


def test_equal_rows_are_cut_once(spark, monkeypatch):
    """Also without an id, and beside a row that shares a passage with them."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choices("etaoins ", k=n))
    same, other = text(2000), text(1500)
    rows = [(1, same)] * 15 + [(None, other)] * 10 + [(2, text(300) + same[500:900] + text(300)), (3, text(400) + other[100:350]), (4, text(500)), (5, "short")] + [(6, "short")] * 3
    snippets = []

    def stored(frame, name, f=suffix_dedup.stored):
        out = f(frame, name)
        snippets.extend([out.count()] if name == "dedup-snippets" else [])
        return out

    monkeypatch.setattr(suffix_dedup, "stored", stored)
    assert run(spark, rows) == brute(rows)
    assert len(snippets) == 1 and snippets[0] < 40
