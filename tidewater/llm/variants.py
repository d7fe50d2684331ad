"""Spelling variants of the words of a corpus, found along a relational trie.

Two words are near when one inserted, deleted or replaced code point turns one
into the other.  The vocabulary is a trie in a table: one row per inner node with
its edges ``(label, child)``.  The frontier is a table of states: word, position,
node reached and the edit already spent.  A level is one equi-join of the frontier
with the nodes: states whose next character has no edge die, the others move on,
and those at the end of their word have found a neighbour.

A pair's edit lies in the first or in the second half of its longer word, so one
half is common.  States therefore start in the middle of their own path: in the trie
of the words for edits of the second half, and in the trie of the reversed words
for edits of the first.  Deletions are looked for from the longer word, and
replacements by smaller characters only; every pair is met, and few states live
beyond two or three levels.

A node's id is a hash of its path.  Equal ids of different paths would only add
states, since a finished state becomes a neighbour by an equality join of the spelled
word with the vocabulary.  A state carries the next ``WINDOW`` characters; a word
longer than that is compared whole by the same join, so the number of levels is
bounded and nothing is left out.

Joins are plain equi-joins, so a node that many words pass is split by the skew
handling of adaptive execution; the node side has one row per key.  Nothing is
collected or broadcast: the frontier of each level is a table in the shared folder.

Defined results
  null text: no words.  Null doc_id: counts as an empty id.  Repeated rows count
  each time.  Ties between forms: the smaller word in code-point order.  Words of
  any length and alphabet.  Empty table: no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffled, stored

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters after the edit that a state carries, and so the most levels.
WINDOW = 24
#: Runs whose checksum this divides lose one code point (spelling noise of the query).
NOISE = 97
_PRIME = (1 << 61) - 1
_BASE = 0x1B873593CC9E2D51 % _PRIME
_ROWS = 50_000


def noisy(word: Column, doc_id: Column, every: int = NOISE) -> Column:
    """The run with one code point left out where its checksum is a multiple of ``every``."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word)
    h = F.crc32(key.cast("binary"))
    at = (h % F.char_length(word)).cast("int")
    cut = F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + 2))
    return F.when(h % every == 0, cut).otherwise(word)


def word_counts(docs: DataFrame, min_length: int = 5, min_count: int = 3, noise: int = NOISE) -> DataFrame:
    """``word, n`` of all runs of letters in ``docs(doc_id, text)``, A-Z lowered."""
    lowered = F.translate("text", UPPER, LOWER)
    runs = docs.select(
        F.col("doc_id").alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run")
    )
    words = runs.select(noisy(F.col("run"), F.col("id"), noise).alias("word"))
    counts = words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= min_count)


def _nodes(path: str, root: int) -> list[int]:
    """Ids of the nodes on a path, the root first."""
    out, h = [root], root
    for c in path:
        h = (h * _BASE + ord(c) + 1) % _PRIME
        out.append(h)
    return out


def _ways(word: str) -> Iterator[tuple[bool, str, list[int]]]:
    """The word and the reversed word, each with its path in its own trie."""
    for back in (False, True):
        path = word[::-1] if back else word
        yield back, path, _nodes(path, 3 if back else 1)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= _ROWS:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)], schema=schema)


def trie(words: DataFrame, least: int) -> DataFrame:
    """``node, edges``: the inner nodes of both tries from depth ``least`` on."""
    schema = pa.schema([("node", pa.int64()), ("label", pa.string()), ("child", pa.int64())])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for word in batch.column("word").to_pylist():
                    for _, path, nodes in _ways(word):
                        for p in range(least, len(path)):
                            yield nodes[p], path[p], nodes[p + 1]

        yield from _batches(rows(), schema)

    found = words.select("word").mapInArrow(edges, "node long, label string, child long")
    edge = F.struct("label", "child")
    return found.groupBy("node").agg(F.collect_set(edge).alias("edges"))


def starts(words: DataFrame) -> DataFrame:
    """A state for every place of every word where its edit may lie, before the edit.

    ``at`` counts in the word itself.  ``cut`` marks one place of a run of equal
    characters, as leaving out any of them gives the same word.
    """
    schema = pa.schema(
        [("id", pa.int64()), ("at", pa.int32()), ("own", pa.string()), ("cut", pa.bool_()), ("node", pa.int64()), ("rest", pa.string())]
    )

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for i, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist(), strict=True):
                    n = len(word)
                    for back, path, nodes in _ways(word):
                        for p in range(n - n // 2 if back else n // 2, n):
                            last = p + 1 == n or path[p + 1] != path[p]
                            yield i, n - 1 - p if back else p, path[p], last, nodes[p], path[p + 1 : p + 1 + WINDOW]

        yield from _batches(rows(), schema)

    made = "id long, at int, own string, cut boolean, node long, rest string"
    return words.select("id", "word").mapInArrow(places, made)


def _edit(start: DataFrame, nodes: DataFrame) -> DataFrame:
    """The states behind the edit: ``id, at, by, node, rest``."""
    after = F.substring("rest", 2, WINDOW)
    replaced = F.transform(
        F.filter("edges", lambda e: e["label"] < F.col("own")),
        lambda e: F.struct(e["label"].alias("by"), e["child"].alias("node"), F.col("rest").alias("rest")),
    )
    deleted = F.transform(
        F.filter("edges", lambda e: F.col("cut") & (e["label"] == F.substring("rest", 1, 1))),
        lambda e: F.struct(F.lit("").alias("by"), e["child"].alias("node"), after.alias("rest")),
    )
    ended = F.array(F.struct(F.lit("").alias("by"), F.col("node").alias("node"), F.lit("").alias("rest")))
    deleted = F.when(F.col("rest") == "", ended).otherwise(deleted)
    return start.join(shuffled(nodes), "node").select("id", "at", F.inline(F.concat(replaced, deleted)))


def _match(states: DataFrame, nodes: DataFrame) -> DataFrame:
    """The states one level deeper: their next character has an edge."""
    to = F.get(F.filter("edges", lambda e: e["label"] == F.substring("rest", 1, 1)), F.lit(0))["child"]
    moved = states.join(shuffled(nodes), "node").select("id", "at", "by", to.alias("node"), F.substring("rest", 2, WINDOW).alias("rest"))
    return moved.where(F.col("node").isNotNull())


def neighbours(words: DataFrame) -> DataFrame:
    """``id, other``: ids of near words, both ways, of ``words(id, word)`` (distinct words)."""
    least = words.agg(F.min(F.char_length("word"))).first()[0]
    if least is None:
        return words.select("id", F.col("id").alias("other")).limit(0)
    nodes = stored(trie(words, least // 2), "trie")
    frontier = stored(_edit(starts(words), nodes), "frontier")
    ended = []
    while True:
        ended.append(frontier.where(F.col("rest") == "").select("id", "at", "by"))
        live = frontier.where(F.col("rest") != "")
        if live.isEmpty():
            break
        frontier = stored(_match(live, nodes), "frontier")
    found = ended[0]
    for more in ended[1:]:
        found = found.union(more)
    left = F.substr("word", F.lit(1), F.col("at"))
    spelled = F.concat(left, "by", F.substr("word", F.col("at") + 2))
    other = words.select(F.col("id").alias("other"), F.col("word").alias("spelled"))
    made = found.join(shuffled(words.select("id", "word")), "id").select("id", spelled.alias("spelled"))
    pairs = made.join(shuffled(other), "spelled")
    pairs = stored(pairs.select("id", "other").distinct(), "pairs")
    return pairs.union(pairs.select("other", "id"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms(word, form)``, which has no cycles: each root by pointer doubling."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        hop = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = now.join(shuffled(hop), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        then = stored(then, "roots")
        now = then.select("word", "root")
        if then.where("moved").isEmpty():
            return now


def variants(counts: DataFrame, ratio: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of ``counts(word, n)`` (distinct words).

    A word's form is its most frequent near word (ties: the smaller word) when that
    occurs at least ``ratio`` times as often; the root is the end of the chain of forms.
    """
    words = stored(counts.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    other = words.select(F.col("id").alias("other"), F.struct((-F.col("n")).alias("less"), F.col("word").alias("form")).alias("rank"))
    near = neighbours(words).join(shuffled(other), "other").groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min("rank").alias("best"))
    given = F.coalesce(-F.col("best.less") >= ratio * F.col("n"), F.lit(False))
    out = words.join(shuffled(near), "id", "left").select(
        "word",
        F.when(given, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(given, -F.col("best.less")).alias("form_n"),
    )
    out = stored(out, "forms")
    ends = roots(out.where(F.col("form").isNotNull()))
    return out.join(shuffled(ends), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
