"""Ball-tree search against brute force."""

import re

import numpy as np
from pyspark.sql import functions as F

from tidewater.llm import topk

SCHEMA = "vec_id long, embedding array<float>, vector string"


def brute(rows, ask, k):
    v = {}
    for i, e in rows:
        if e is not None and all(x is not None and np.isfinite(x) for x in e):
            v.setdefault((i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in e)), None)
    out = {}
    for i, q in v:
        if ask(i):
            out.setdefault(i, []).extend((-sum(a * b for a, b in zip(q, c, strict=True)), j) for j, c in v if j != i and len(c) == len(q))
    return {i: [(r, j, -s) for r, (s, j) in enumerate(sorted(x)[:k], 1)] for i, x in out.items() if x}


def run(spark, rows, k=5, **options):
    table = spark.createDataFrame([(i, e, "z") for i, e in rows], SCHEMA)
    usable = table.where(topk.usable(F.col("embedding"))).select("vec_id", topk.scaled(F.col("embedding")).alias("vector"))
    out = {}
    for r in topk.search(usable, F.col("vec_id") % 50 == 0, k, **options).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(x) for q, x in out.items()}


def test_many_shards_and_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(1500)]
    assert run(spark, rows, shard_rows=200, block_rows=7) == brute(rows, lambda i: i % 50 == 0, 5)


def test_ties_clusters_and_unusable_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(i % 3), 1.0, float(rng.integers(0, 3))]) for i in range(400)]
    rows += [(1000, None), (1050, [None, 1.0, 2.0]), (1100, [float("nan"), 1.0, 1.0]), (1101, [float("inf"), 0.0, 0.0]), (1150, [1.0, 1.0, 1.0]), (1150, [1.0, 1.0, 1.0])]
    assert run(spark, rows, shard_rows=64) == brute(rows, lambda i: i % 50 == 0, 5)


def test_few_rows_and_empty(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (50, [-1.0, 0.25])]
    assert run(spark, rows) == brute(rows, lambda i: i % 50 == 0, 5)
    assert run(spark, [(0, [1.0])]) == {}
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == {}
    assert run(spark, []) == {}


def test_large_components_are_exact():
    rng = np.random.default_rng(6)
    vectors = rng.integers(-(2**28), 2**28, (300, 4))
    tree = topk.BallTree.build(np.arange(300), vectors, 16)
    found = tree.search(np.array([-1]), vectors[:1], 5, [-np.inf])[0]
    exact = sorted(((sum(int(a) * int(b) for a, b in zip(vectors[0], v, strict=True)), -i) for i, v in enumerate(vectors)), reverse=True)[:5]
    assert found == [(s, -i) for s, i in exact]


def test_the_floor_prunes_but_keeps_ties():
    vectors = np.array([[1, 0], [2, 0], [3, 0], [3, 0]])
    tree = topk.BallTree.build(np.arange(4), vectors, 1)
    assert tree.search(np.array([9]), np.array([[1, 0]]), 2, [3.0]) == [[(3, 2), (3, 3)]]


def test_clusters_are_searched_in_few_shards(spark, monkeypatch):
    """Root bounds keep most (block, shard) pairs of clustered rows from being sent."""
    rng = np.random.default_rng(7)
    middles = rng.normal(size=(8, 12)) * 20
    rows = [(i, [float(x) for x in middles[i % 8] + rng.normal(size=12)]) for i in range(4000)]
    kept = {}
    plain = topk.stored
    monkeypatch.setattr(topk, "stored", lambda df, name: kept.setdefault(name, plain(df, name)))
    assert run(spark, rows, shard_rows=250, block_rows=10) == brute(rows, lambda i: i % 50 == 0, 5)
    blocks, shards = kept["topk-blocks"].count(), kept["topk-trees"].count()
    assert shards >= 8 and kept["topk-sent"].count() < blocks * (shards - 1) / 2


def test_other_lengths_and_one_hot_id(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=3 if i % 7 else 5)]) for i in range(300)]
    rows += [(100, [float(i), 1.0, -1.0]) for i in range(150)] + [(150, [1.0, 2.0, 3.0])] * 100 + [(2, [])]
    assert run(spark, rows, shard_rows=40, block_rows=9) == brute([r for r in rows if r[1]], lambda i: i % 50 == 0, 5)


def test_cancelling_bounds_keep_their_rounding():
    """A bound near zero that is a difference of large terms is still an upper bound."""
    rng = np.random.default_rng(9)
    vectors = rng.integers(-(2**20), 2**20, (500, 8)) + 2**26
    queries = rng.integers(-(2**24), 2**24, (20, 8))
    tree = topk.BallTree.build(np.arange(500), vectors, 4)
    bounds = topk._bounds(queries.astype(float), tree.centers, tree.radii)
    for node, (start, stop) in enumerate(tree.spans):
        assert ((queries @ tree.vectors[start:stop].T).max(1) <= bounds[:, node]).all()


def test_router_places_every_point():
    rng = np.random.default_rng(10)
    points = rng.normal(size=(500, 4))
    router = topk.Router(points, 16)
    counts = np.bincount(router.place(points), minlength=16)
    assert router.cells == 16 and counts.sum() == 500 and counts.min() > 0
    same = topk.Router(np.ones((50, 3)), 8)
    assert same.cells == 1 and not same.place(np.ones((5, 3))).any()


def test_trees_and_blocks_are_not_broadcast(spark, monkeypatch):
    """Their files are much smaller than they are."""
    plans, stored = [], topk.stored

    def seen(df, tag):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, tag)

    monkeypatch.setattr(topk, "stored", seen)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(600)]
    want = brute(rows, lambda i: i % 50 == 0, 5)
    assert run(spark, rows, shard_rows=200, block_rows=7) == want
    home = [p for p in plans if "t_vectors" in p]
    assert home and all(re.search(r"SortMergeJoin \[shard#\d+L?, part", p) for p in home)
    assert not [p for p in plans if re.search(r"BroadcastHashJoin \[(shard#\d+L?, part|block)", p)]
    monkeypatch.setattr(topk, "BROADCAST_BYTES", 0)  # as if all were many
    assert run(spark, rows, shard_rows=200, block_rows=7) == want
