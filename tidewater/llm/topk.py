"""Exact top-k inner-product search with a ball tree per shard.

The top of the tree is a router: splits at medians fitted on a sample of about
``ROUTER_ROWS`` rows, with at most ``CELLS`` cells of nearby vectors.  It places
every row; a cell's rows are dealt by hash to shards of about ``SHARD_ROWS``, its
queries to blocks of about ``BLOCK_ROWS``.  Every shard's vectors become a ball
tree (one stored row per shard).  A query walks a tree best first: nodes are
ordered by the upper bound  q.center + |q| * radius  of any inner product inside,
a leaf is scored as one product, and the walk ends when the best bound left is
below the current kth score.  The sample decides where rows lie, never the result.

The kth score is shared between shards: a first round lets each block search
one home shard of its cell.  Then the blocks and their kth scores meet the root
balls of all shards, in pages of about ``PAGE_BALLS``; only a query whose bound at a
root reaches its kth score is sent to that shard, and starts from that score.
Each shard returns at most k rows per query; the best k of them are the answer.

Queries meet shards by an equi-join on the shard, with a shard repeated for each
group of ``GROUP_BLOCKS`` blocks that asks for it: no task holds more than one
shard and one block.  Only the sample is collected; the router (a direction per
cell) goes to all tasks.  Trees and blocks are never broadcast; root balls and
tables of keys are if they take up to ``BROADCAST_BYTES``.

Defined results
  Vectors that are null, without components, or hold null or non-finite
  components take no part.
  Equal rows (id and vector) count once; rows with the query's id are its own.
  An id with several vectors is searched with each and answered by the best.
  Vectors of different lengths are not compared.  Ties go to the smaller id.
  Fewer than k candidates: all of them.  Empty table: no rows.  Scores are exact
  integers as long as they fit a long.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffled, stored

SHARD_ROWS, BLOCK_ROWS, GROUP_BLOCKS, LEAF_ROWS = 4096, 512, 64, 128
ROUTER_ROWS, CELLS, PAGE_BALLS, SENT_BYTES = 16_384, 512, 1024, 4 << 20
#: Bytes that may be broadcast; rows of fixed width, counted first.
BROADCAST_BYTES = 32 << 20
PACKED = "n long, dim int, ids binary, vectors binary"
BLOCK = f"block long, {PACKED}"
TREE = f"shard long, {PACKED}, centers binary, radii binary, spans binary, children binary"


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine


def _halves(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Direction between two far points, and the points' places along it."""
    a = points[((points - points.mean(0)) ** 2).sum(1).argmax()]
    b = points[((points - a) ** 2).sum(1).argmax()]
    return b - a, points @ (b - a)


def _bounds(queries: np.ndarray, centers: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products of queries with all in each ball, rounding included."""
    lengths = np.linalg.norm(queries, axis=1)[:, None]
    reach = np.linalg.norm(centers, axis=1) + radii
    return queries @ centers.T + lengths * radii + (1e-6 + 1e-9 * lengths * reach)


class Router:
    """Splits of a sample at the median along a direction, as many as make ``cells`` cells."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.dim = sample.shape[1]
        self.directions, self.places, self.children = [], [], []  # child: a node, or -1 - cell
        self.cells = 0
        waiting, made = [(sample, None)], 1
        while waiting:
            points, parent = waiting.pop(0)
            way, along = _halves(points) if made < cells and len(points) > 1 else (None, None)
            if along is None or along.min() == along.max():
                self.cells += 1
                name = -self.cells
            else:
                name, made = len(self.places), made + 1
                place = np.median(along)
                place = along[along < along.max()].max() if place == along.max() else place
                self.directions.append(way)
                self.places.append(place)
                self.children.append([None, None])
                waiting += [(points[along <= place], (name, 0)), (points[along > place], (name, 1))]
            if parent is not None:
                self.children[parent[0]][parent[1]] = name

    def place(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        cell = np.zeros(len(points), np.int32)
        waiting = [(0 if self.places else -1, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            if node < 0:
                cell[rows] = -1 - node
            elif len(rows):
                right = points[rows] @ self.directions[node] > self.places[node]
                waiting += [(self.children[node][0], rows[~right]), (self.children[node][1], rows[right])]
        return cell


class BallTree:
    """Nodes in arrays: ``spans`` rows of a node, ``children`` (0: leaf), center, radius."""

    def __init__(self, ids, vectors, centers, radii, spans, children):
        self.ids, self.vectors, self.centers, self.radii = ids, vectors, centers, radii
        self.spans, self.children = spans, children

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> BallTree:
        points = vectors.astype(np.float64)
        order = np.arange(len(ids))
        spans, children, centers, radii = [(0, len(ids))], [0], [], []
        at = 0
        while at < len(spans):
            start, stop = spans[at]
            rows = order[start:stop]
            own = points[rows]
            center = own.mean(0)
            away = ((own - center) ** 2).sum(1)
            centers.append(center)
            radii.append(np.sqrt(away.max()))
            if stop - start > leaf_rows and radii[-1] > 0:
                order[start:stop] = rows[np.argsort(_halves(own)[1], kind="stable")]
                middle = (start + stop) // 2
                children[at] = len(spans)
                spans += [(start, middle), (middle, stop)]
                children += [0, 0]
            at += 1
        return cls(ids[order], vectors[order], np.array(centers), np.array(radii), np.array(spans, np.int64), np.array(children, np.int64))

    def search(self, query_ids, queries, k: int, floors) -> list[list[tuple[int, int]]]:
        """For each query its best ``(score, id)`` not below its floor, best first."""
        wide = float(np.abs(self.vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, queries.shape[1])
        kind = np.float64 if wide < 2**53 else object  # products are exact integers either way
        vectors, points = self.vectors.astype(kind), queries.astype(kind)
        bounds = _bounds(queries.astype(np.float64), self.centers, self.radii)
        found = []
        for i, own in enumerate(query_ids):
            best: list[tuple[int, int]] = []  # a heap of (score, -id), the worst first
            kth = floors[i]
            waiting = [(-bounds[i, 0], 0)]
            while waiting and -waiting[0][0] >= kth:
                node = heapq.heappop(waiting)[1]
                if child := self.children[node]:
                    for c in (child, child + 1):
                        if bounds[i, c] >= kth:
                            heapq.heappush(waiting, (-bounds[i, c], c))
                    continue
                start, stop = self.spans[node]
                scores = vectors[start:stop] @ points[i]
                for j in np.flatnonzero(scores >= kth):
                    if self.ids[start + j] == own:
                        continue
                    item = (int(scores[j]), -int(self.ids[start + j]))
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                    if len(best) == k and best[0][0] > kth:
                        kth = best[0][0]
            found.append([(s, -v) for s, v in sorted(best, reverse=True)])
        return found


def _unpack(row) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"], np.int64).reshape(row["n"], row["dim"])


def _packed(rows: DataFrame, by: str, finish, schema: str) -> DataFrame:
    """One row per value of ``by`` and vector length, equal rows once."""

    def pack(key, table):
        import pyarrow as pa

        ids = table.column("vec_id").to_numpy()
        values = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        both = np.unique(np.column_stack([ids, values.reshape(len(ids), key[1].as_py())]), axis=0)
        return pa.Table.from_pylist([{by: key[0].as_py(), "n": len(both), "dim": key[1].as_py()} | finish(both[:, 0], both[:, 1:])], schema=None)

    keyed = rows.select(by, F.size("vector").alias("dim"), "vec_id", "vector")
    return keyed.groupBy(by, "dim").applyInArrow(_ordered(pack, schema), schema)


def _fields(schema: str):
    """An Arrow schema of int, long and binary columns."""
    import pyarrow as pa

    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, types[t]) for n, t in (f.strip().split(" ") for f in schema.split(","))])


def _ordered(pack, schema: str):
    """``pack`` with its columns in the order and types of ``schema``."""

    def run(key, table):
        fields = _fields(schema)
        return pack(key, table).select(fields.names).cast(fields)

    return run


def _tree(ids: np.ndarray, vectors: np.ndarray) -> dict:
    t = BallTree.build(np.ascontiguousarray(ids), np.ascontiguousarray(vectors))
    parts = ("ids", "vectors", "centers", "radii", "spans", "children")
    return {p: np.ascontiguousarray(getattr(t, p)).tobytes() for p in parts}


def _block(ids: np.ndarray, vectors: np.ndarray) -> dict:
    return {"ids": np.ascontiguousarray(ids).tobytes(), "vectors": np.ascontiguousarray(vectors).tobytes()}


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """Rows ``block, dim, query_id, vec_id, score`` of (block, shard) pairs."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, tree = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names if not n.startswith("t_")}
                if held != (row["shard"], row["dim"]):
                    t = {n[2:]: batch.column(n)[i].as_py() for n in batch.schema.names if n.startswith("t_")}
                    ids, vectors = _unpack(t | {"dim": row["dim"]})
                    centers = np.frombuffer(t["centers"]).reshape(-1, row["dim"])
                    spans = np.frombuffer(t["spans"], np.int64).reshape(-1, 2)
                    tree = BallTree(ids, vectors, centers, np.frombuffer(t["radii"]), spans, np.frombuffer(t["children"], np.int64))
                    held = (row["shard"], row["dim"])
                ids, queries = _unpack(row)
                floors = np.frombuffer(row["floors"]) if row["floors"] else np.full(len(ids), -np.inf)
                found = tree.search(ids, queries, k, floors)
                hits = [(int(q), v, s) for q, rows in zip(ids, found, strict=True) for s, v in rows]
                if hits:
                    q, v, s = (pa.array(c, pa.int64()) for c in zip(*hits, strict=True))
                    block, dim = pa.array([row["block"]] * len(hits), pa.int64()), pa.array([row["dim"]] * len(hits), pa.int32())
                    yield pa.RecordBatch.from_arrays([block, dim, q, v, s], names=["block", "dim", "query_id", "vec_id", "score"])

    return pairs.mapInArrow(run, "block long, dim int, query_id long, vec_id long, score long")


def _few(rows: DataFrame, n: int, width: int) -> DataFrame:
    """A table of at most ``n`` rows of ``width`` bytes, marked for broadcast if they are few."""
    return F.broadcast(rows) if n * width <= BROADCAST_BYTES else shuffled(rows)


def _floors(blocks: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """``blocks`` with the kth scores of the home round, in the order of their ids."""
    rank = Window.partitionBy("block", "dim", "query_id").orderBy(F.desc("score"), "vec_id")
    kth = hits.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") == k)
    per_block = kth.groupBy("block", "dim").agg(F.map_from_entries(F.collect_list(F.struct("query_id", "score"))).alias("kth"))
    schema = f"{BLOCK}, home long, floors binary"

    def fill(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = []
            for i in range(batch.num_rows):
                known = dict(batch.column("kth")[i].as_py() or [])
                ids = np.frombuffer(batch.column("ids")[i].as_py(), np.int64)
                made.append(np.array([known.get(int(q), -np.inf) for q in ids], np.float64).tobytes())
            names = [n for n in _fields(schema).names if n != "floors"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(made, pa.binary())], names=[*names, "floors"])

    joined = blocks.drop("floors").join(shuffled(per_block), ["block", "dim"], "left")
    return joined.mapInArrow(fill, schema)


def _sent(blocks: DataFrame, trees: DataFrame, pages: int, shards: int, dim: int) -> DataFrame:
    """For each shard the queries whose bound at its root reaches their floor, block by block."""
    root = F.struct("shard", F.expr("substring(centers, 1, 8 * dim)").alias("center"), F.expr("substring(radii, 1, 8)").alias("radius"))
    page = F.pmod(F.xxhash64("shard"), F.lit(pages)).cast("int")
    balls = trees.groupBy(page.alias("page"), "dim").agg(F.collect_list(root).alias("balls"))
    balls = _few(balls, shards, 8 * dim + 64)
    met = blocks.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1)))).join(balls, ["page", "dim"])
    schema = f"shard long, {BLOCK}, floors binary"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                ids, queries = _unpack(row)
                floors = np.frombuffer(row["floors"])
                centers = np.array([np.frombuffer(b["center"]) for b in row["balls"]])
                radii = np.array([np.frombuffer(b["radius"])[0] for b in row["balls"]])
                asks = _bounds(queries.astype(np.float64), centers, radii) >= floors[:, None]
                made, size = [], 0
                for j in np.flatnonzero(asks.any(0)):
                    if (shard := row["balls"][j]["shard"]) == row["home"]:
                        continue
                    own = asks[:, j]
                    part = {"ids": ids[own].tobytes(), "vectors": queries[own].tobytes(), "floors": floors[own].tobytes()}
                    made.append({"shard": shard, "block": row["block"], "n": int(own.sum()), "dim": row["dim"]} | part)
                    size += len(part["vectors"])
                    if size > SENT_BYTES:
                        yield pa.RecordBatch.from_pylist(made, _fields(schema))
                        made, size = [], 0
                if made:
                    yield pa.RecordBatch.from_pylist(made, _fields(schema))

    return met.mapInArrow(run, schema)


def _celled(rows: DataFrame, shards: int, n: int) -> DataFrame:
    """``rows`` with their ``cell``; vectors of another length than most of the sample's are in cell 0."""
    near = F.pmod(F.xxhash64("vec_id", "vector", F.lit(3)), F.lit(1 << 30)) <= int((1 << 30) * min(1.0, ROUTER_ROWS / max(n, 1)))
    sample = [r.vector for r in rows.where(near).select("vector").limit(2 * ROUTER_ROWS).collect()]
    if not sample:
        return rows.withColumn("cell", F.lit(0))
    lengths = [len(v) for v in sample]
    usual = max(set(lengths), key=lambda x: (lengths.count(x), -x))
    router = Router(np.array([v for v in sample if len(v) == usual], np.float64), min(shards, CELLS))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            fits = pc.equal(pc.list_value_length(batch.column("vector")), router.dim)
            cell = np.zeros(batch.num_rows, np.int32)
            own = batch.column("vector").filter(fits).flatten().to_numpy(zero_copy_only=False)
            cell[fits.to_numpy(zero_copy_only=False)] = router.place(own.reshape(-1, router.dim).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    return rows.mapInArrow(run, "vec_id long, vector array<long>, asked boolean, cell int")


def search(
    rows: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows for every query row.

    ``rows`` has ``vec_id`` (long) and ``vector`` (array of long, usable).
    """
    rows = rows.select("vec_id", "vector", F.coalesce(is_query, F.lit(False)).alias("asked")).where(F.size("vector") > 0)
    n = rows.count()
    rows = stored(_celled(rows, -(-n // shard_rows), n).withColumn("dim", F.size("vector")), "topk-rows")
    # Cells are few (at most CELLS for each length of vectors); shards and blocks count within theirs.
    held = rows.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("q"))
    pieces = F.ceil(F.col("n") / shard_rows).cast("long").alias("shards"), F.ceil(F.col("q") / block_rows).cast("long").alias("blocks")
    cells = stored(held.select("dim", "cell", *pieces), "topk-cells")
    total = cells.agg(F.sum("shards").alias("shards"), F.sum("blocks").alias("blocks"), F.max("dim").alias("dim"), F.count(F.lit(1)).alias("n")).first()
    shards, n_blocks = total["shards"] or 1, total["blocks"] or 1
    cells = _few(cells, total["n"], 64)
    groups, pages = -(-n_blocks // GROUP_BLOCKS), -(-shards // PAGE_BALLS)

    def deal(of: str, salt: int) -> Column:
        return F.shiftleft(F.col("cell").cast("long"), 32) + F.pmod(F.xxhash64("vec_id", "vector", F.lit(salt)), F.col(of))

    rows = rows.join(cells, ["dim", "cell"])
    trees = stored(_packed(rows.withColumn("shard", deal("shards", 1)), "shard", _tree, TREE), "topk-trees")
    blocks = _packed(rows.where("asked").withColumn("block", deal("blocks", 2)), "block", _block, BLOCK)
    piece = F.pmod(F.col("block").bitwiseAND(F.lit((1 << 32) - 1)), F.col("shards"))
    placed = blocks.withColumn("cell", F.shiftright("block", 32).cast("int")).join(cells, ["dim", "cell"])
    home = (F.shiftleft(F.col("cell").cast("long"), 32) + piece).alias("home")
    blocks = stored(placed.select("block", "n", "dim", "ids", "vectors", home), "topk-blocks")

    part = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")
    wide = trees.select("shard", "dim", *[F.col(c).alias(f"t_{c}") for c in trees.columns if c not in ("shard", "dim")])

    def pairs(asked: DataFrame) -> DataFrame:
        asked = asked.withColumn("part", part)
        needed = _few(asked.select("shard", "dim", "part").distinct(), shards * groups, 64)
        ways = max(1, min(shards * groups, 4096))
        met = wide.join(needed, ["shard", "dim"]).repartition(ways, "shard", "part")
        return asked.repartition(ways, "shard", "part").join(shuffled(met), ["shard", "part", "dim"])

    alone = blocks.withColumn("floors", F.lit(None).cast("binary")).withColumnRenamed("home", "shard")
    first = stored(_searched(pairs(alone), k), "topk-home")
    sent = stored(_sent(_floors(blocks, first, k), trees, pages, shards, total["dim"] or 1), "topk-sent")
    hits = first.unionByName(_searched(pairs(sent), k))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.select("query_id", F.row_number().over(rank).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
