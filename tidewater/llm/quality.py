"""Quality rules judged by an isolation forest on rule statistics.

``rule_statistics`` counts, per whole text, what the rules look at.  A document
fails the base rules by too few words or too much repetition; the others are
judged by an isolation forest over ratios of those counts.

The forest isolates documents from the population labelled good: each tree
holds ``TREE_ROWS`` of at most ``SAMPLE_ROWS`` good rows (the smallest hashes of
doc_id), and its random splits are drawn over the range of the node's own rows
and a fixed ``MARGIN`` beyond, all on log scales.  So no other document, however
extreme, changes a verdict.  A document in a region without good rows is isolated
after a few splits; one like the good rows needs many.  The score is the usual
``2 ** (-mean path length / c(n))``.

The threshold is calibrated on every labelled row: the score histogram by label
is one aggregate, and the threshold maximises (share of bad rows rejected) -
``GOOD_WEIGHT`` * (share of good rows rejected), in the middle of the best
stretch.  At the weight 1 (the Youden index) a few wrong labels cost their share
of the gain and no more.  Without labels of both kinds the forest rejects nothing.

Defined results
  null or blank text: all counts 0, base_failed.  Repeated rows and ids: judged
  each.  A doc_id with several labels counts as bad if any is.  Empty table: no
  rows.  Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
TREES, TREE_ROWS, SAMPLE_ROWS, MAX_DEPTH = 100, 256, 4096, 12
GOOD_WEIGHT = 1.0
BINS = 2000
#: How far beyond its rows a node's splits reach, for each of ``FEATURES``.
MARGIN = [1.0, 4.0, 4.0, 4.0, 4.0]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_adjacent"]
FEATURES = ["word_length", "symbols", "dup_lines", "repeats", "adjacent"]


def words_of(text: str) -> list[str]:
    """Runs of anything but ASCII white space."""
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words inside ``window``-word runs that occur at least twice in the text."""
    n = len(words)
    if n <= window:
        return 0
    table: dict[str, int] = {}
    ids = np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, n)
    width, runs = 1, ids
    while width < window:  # names of runs of twice the width, until they are all different
        step = min(width, window - width)
        pairs = runs[: len(runs) - step] * np.int64(n + 1) + runs[step:]
        values, runs = np.unique(pairs, return_inverse=True)
        if len(values) == len(pairs):
            return 0
        width += step
    again = np.bincount(runs)[runs] > 1
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def statistics_of(text: str | None) -> tuple[int, ...]:
    """``COUNTS`` and ``EXTRA`` of one text."""
    text = text or ""
    words = words_of(text)
    lines = text.split("\n")
    seen: set[str] = set()
    dup = filled = 0
    for line in lines:
        if line.strip(" \t\n\v\f\r"):
            filled += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    adjacent = sum(a == b for a, b in zip(words, words[1:], strict=False))
    symbols = sum(text.count(c) for c in SYMBOLS)
    return len(words), sum(map(len, words)), symbols, dup, repeated_words(words), filled, adjacent


def rule_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the counts of every whole text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = COUNTS + EXTRA

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text")
            made = [statistics_of(texts[i].as_py()) for i in range(len(texts))]
            columns = [pa.array(c, pa.int64()) for c in zip(*made, strict=True)] if made else [pa.array([], pa.int64())] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names))


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def ratios() -> list[Column]:
    """``FEATURES``, 0 or more; on a log scale, so that a little is already far from
    none and one long unbroken string is not far from everything."""
    words = F.greatest(F.col("n_words"), F.lit(1))

    def share(count: str, of: Column) -> Column:
        return F.log1p(100 * F.col(count) / of)

    return [
        F.log(F.greatest("word_chars", words) / words).alias("word_length"),
        share("n_symbols", words).alias("symbols"),
        share("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_lines"),
        share("n_repeat_words", words).alias("repeats"),
        share("n_adjacent", words).alias("adjacent"),
    ]


def mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


class IsolationForest:
    """Random axis-parallel splits inside the box ``low..high``, and no further than
    ``margin`` from a node's own rows; flat node arrays."""

    def __init__(self, rows: np.ndarray, low, high, trees=TREES, tree_rows=TREE_ROWS, max_depth=MAX_DEPTH, seed=1, margin=np.inf):
        rng = np.random.default_rng(seed)
        self.max_depth = max_depth
        self.feature: list[int] = []
        self.split: list[float] = []
        self.child: list[int] = []  # the left one; the right one follows it
        self.path: list[float] = []
        per = min(tree_rows, len(rows))
        self.roots = []
        for _ in range(trees):
            self.roots.append(self._new())
            own = rows[rng.choice(len(rows), per, replace=False)]
            waiting = [(self.roots[-1], own, np.array(low, float), np.array(high, float), 0)]
            while waiting:
                node, own, lo, hi, depth = waiting.pop()
                if depth >= max_depth or len(own) <= 1:
                    self.path[node] = depth + mean_path(len(own))
                    continue
                first, last = np.maximum(lo, own.min(0) - margin), np.minimum(hi, own.max(0) + margin)
                wide = np.flatnonzero(last > first)
                if not len(wide):
                    self.path[node] = depth + mean_path(len(own))
                    continue
                f = int(rng.choice(wide))
                cut = float(rng.uniform(first[f], last[f]))
                left, right = self._new(), self._new()
                self.feature[node], self.split[node], self.child[node] = f, cut, left
                below = own[:, f] < cut
                lower, upper = hi.copy(), lo.copy()
                lower[f] = upper[f] = cut
                waiting += [(left, own[below], lo, lower, depth + 1), (right, own[~below], upper, hi, depth + 1)]
        self.feature, self.child = np.array(self.feature), np.array(self.child)
        self.split, self.path = np.array(self.split), np.array(self.path)
        self.scale = max(mean_path(per), 1.0)

    def _new(self) -> int:
        self.feature.append(0)
        self.split.append(0.0)
        self.child.append(-1)
        self.path.append(0.0)
        return len(self.path) - 1

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1 for each row; higher is more anomalous."""
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for root in self.roots:
            node, live = np.full(len(x), root), every
            for _ in range(self.max_depth):
                live = live[self.child[node[live]] >= 0]
                if not len(live):
                    break
                at = node[live]
                node[live] = self.child[at] + (x[live, self.feature[at]] >= self.split[at])
            total += self.path[node]
        return 2.0 ** (-total / len(self.roots) / self.scale)


def fit(statistics: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> IsolationForest | None:
    """A forest over the good population."""
    judged = statistics.where(~base_failed())
    good = judged.join(labels.where("quality = 1"), "doc_id", "left_semi")
    sample = good.orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(sample_rows).select(*ratios()).collect()
    if not sample:
        return None
    edges = np.zeros(len(FEATURES))
    return IsolationForest(np.array(sample, float), edges, edges + np.inf, margin=np.array(MARGIN))


def scored(statistics: DataFrame, forest: IsolationForest) -> DataFrame:
    """``statistics`` with ``score`` (the forest is fixed size: trees x tree rows)."""
    rows = statistics.select(F.struct(*statistics.columns).alias("row"), F.array(*ratios()).alias("x"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(forest.score(x))], names=["row", "score"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, score double").select("row.*", "score")


def threshold(scores: DataFrame, labels: DataFrame, good_weight: float = GOOD_WEIGHT) -> float:
    """The score above which a document is rejected, from all labelled rows (else infinity)."""
    at = F.floor(F.col("score") * BINS).cast("int")
    found = (
        scores.where(~base_failed()).join(labels, "doc_id").groupBy("quality", at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    ).collect()
    counts = np.zeros((2, BINS + 2))
    for row in found:
        counts[int(row["quality"]), row["bin"]] += row["n"]
    if not counts.sum(1).all():
        return float("inf")
    above = 1 - np.cumsum(counts, 1) / counts.sum(1, keepdims=True)  # rejected if the bin is larger than b
    gain = above[0] - good_weight * above[1]
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    if gain.max() <= 0:
        return float("inf")
    return float((best[0] + best[-1] + 2) / 2 / BINS)


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, ``base_failed``, ``score`` and ``kept`` of every document."""
    statistics = stored(rule_statistics(docs, doc_id, text), "quality-statistics")
    known = labels.where("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    forest = fit(statistics, known)
    if forest is None:
        scores, limit = statistics.withColumn("score", F.lit(0.0)), float("inf")
    else:
        scores = stored(scored(statistics, forest), "quality-scores")
        limit = threshold(scores, known)
    kept = ~base_failed() & (F.col("score") <= F.lit(limit))
    return scores.select("doc_id", *COUNTS, base_failed().alias("base_failed"), kept.alias("kept"), "score")
