"""Language identification by hierarchical discrimination.

A text becomes hashed counts of letter n-grams (1 to ``NGRAM`` letters, word
edges included), their square roots scaled to length one.  First a linear
support vector machine per family chooses the language family; then
one-versus-one machines decide between the languages inside it, by votes and,
on equal votes, by the sum of margins.  A family with one language needs none.

The machines are fitted on a bounded sample of labelled rows: at most
``SAMPLE_PER_LANGUAGE`` rows of each language, the smallest hashes of doc_id;
only their vectors (``BINS`` floats) reach the driver.  The number of languages
is read from the data.  Prediction is one scan without a shuffle; a text is read
in pieces of ``PIECE`` characters, so its length does not matter.

Defined results
  null text, or no letter in it: ``und``, score 0.  Nothing to learn from:
  every text is ``und``.  Repeated rows are predicted alike; equal margins go to
  the language that sorts first.  Null doc_id: not learned from, ``held_out``
  null.  Empty table: no rows.  Other columns are never inputs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS, NGRAM, PIECE = 4096, 4, 1 << 20
SAMPLE_PER_LANGUAGE = 300
ROUNDS, PENALTY = 100, 1e-4
UNKNOWN = "und"
# Families of common languages; any other language is its own family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr"),
}


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts of the letters of ``text``; None without letters."""
    total = None
    for start in range(0, len(text), PIECE):
        piece = text[start : start + PIECE].lower().encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(piece, np.uint32)
        letter = _letters()[np.minimum(codes, 0x10FFFF)]
        if not letter.any():
            continue
        codes = np.where(letter, codes, np.uint32(32))
        # One space between words and at both ends.
        keep = np.empty(len(codes), bool)
        keep[0] = True
        np.logical_or(letter[1:], letter[:-1], out=keep[1:])
        codes = np.concatenate(([np.uint32(32)], codes[keep], [np.uint32(32)])).astype(np.uint32)
        total = np.zeros(BINS, np.int64) if total is None else total
        gram = codes.copy()
        for n in range(1, NGRAM + 1):
            if n > 1:
                if len(gram) < 2:
                    break
                gram = gram[:-1] * np.uint32(0x9E3779B1) + codes[n - 1 :] * np.uint32(0x85EBCA6B) + np.uint32(n)
            mixed = gram ^ (gram >> np.uint32(15))
            total += np.bincount((mixed * np.uint32(0xC2B2AE35)) >> np.uint32(20), minlength=BINS)
    return total


def vector(text: str | None) -> np.ndarray | None:
    found = counts(text) if text else None
    if found is None:
        return None
    root = np.sqrt(found).astype(np.float32)
    return root / np.linalg.norm(root)


def held_out(doc_id: Column) -> Column:
    """Rows that are kept from learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def train_svm(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM with squared hinge loss for y of -1 and 1,
    both classes weighing the same, by accelerated gradient descent."""
    rows = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = ahead = np.zeros(rows.shape[1], np.float32)
    step, t = 1.0 / (4.0 + penalty), 1.0  # rows have norm sqrt(2), weights sum to 1
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (rows @ ahead))
        gradient = penalty * ahead - 2 * rows.T @ (weight * slack * y)
        after = ahead - step * gradient
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead = after + ((t - 1) / t_next) * (after - w)
        w, t = after, t_next
    return w[:-1].astype(np.float32), float(w[-1])


class Model:
    """The family machines and the pairwise machines of each family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        names = np.array(langs, dtype=object)
        self.families: list[list[str]] = []
        of = {lang: family for family, members in FAMILIES.items() for lang in members}
        groups: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            groups.setdefault(of.get(lang, f"_{lang}"), []).append(lang)
        self.families = [groups[k] for k in sorted(groups)]
        self.first, self.pairs = [], {}
        if len(self.families) > 1:
            self.first = [train_svm(x, np.where(np.isin(names, f), 1.0, -1.0).astype(np.float32)) for f in self.families]
        for family in self.families:
            for i, a in enumerate(family):
                for b in family[i + 1 :]:
                    rows = np.isin(names, [a, b])
                    y = np.where(names[rows] == a, 1.0, -1.0).astype(np.float32)
                    self.pairs[a, b] = train_svm(x[rows], y)

    def predict(self, v: np.ndarray) -> tuple[str, float]:
        """Language and score of one vector; the score is that of the weakest decision."""
        family, doubt = self.families[0], np.inf
        if self.first:
            margins = np.array([v @ w + b for w, b in self.first])
            order = np.argsort(-margins, kind="stable")
            family, doubt = self.families[order[0]], margins[order[0]] - margins[order[1]]
        votes, sums = dict.fromkeys(family, 0), dict.fromkeys(family, 0.0)
        for i, a in enumerate(family):
            for b in family[i + 1 :]:
                w, bias = self.pairs[a, b]
                margin = float(v @ w + bias)
                votes[a if margin >= 0 else b] += 1
                sums[a] += margin
                sums[b] -= margin
        best = max(family, key=lambda lang: (votes[lang], sums[lang]))
        if len(family) > 1:
            doubt = min(doubt, sums[best] / (len(family) - 1))
        return best, float(1 / (1 + np.exp(-2.0 * doubt))) if np.isfinite(doubt) else 1.0


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """The machines, learned from rows that are not held out and have a language."""
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = known.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    # Half as many again as wanted are drawn by hash, so that a language is short of
    # rows only if it has no more.
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, 1.5 * per_language / n)])
    drawn = known.where(spread < F.element_at(share, F.col("lang"))).select(F.xxhash64("doc_id").alias("h"), "text", "lang")

    def vectors(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            h, texts, langs = (batch.column(c) for c in ("h", "text", "lang"))
            for i in range(batch.num_rows):
                v = vector(texts[i].as_py())
                if v is not None:
                    made = pa.array([v.astype(np.float16).tobytes()])
                    yield pa.RecordBatch.from_arrays([h.slice(i, 1), langs.slice(i, 1), made], names=["h", "lang", "v"])

    rows: dict[str, list] = {}
    for r in drawn.mapInArrow(vectors, "h long, lang string, v binary").collect():
        rows.setdefault(r["lang"], []).append((r["h"], bytes(r["v"])))
    chosen = [(lang, v) for lang in sorted(rows) for _, v in sorted(rows[lang])[:per_language]]
    if not chosen:
        return None
    x = np.stack([np.frombuffer(v, np.float16).astype(np.float32) for _, v in chosen])
    return Model(x, [lang for lang, _ in chosen])


def predict(docs: DataFrame, model: Model | None, text: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and score (equally named columns are replaced)."""
    kept = [c for c in docs.columns if c not in into]
    carried = docs.select(F.struct(*kept).alias("row"), F.col(text).alias("given"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            given, found = batch.column("given"), []
            for i in range(batch.num_rows):
                v = vector(given[i].as_py())
                found.append((UNKNOWN, 0.0) if v is None or model is None else model.predict(v))
            langs, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), langs, scores], names=["row", "lang_pred", "score"])

    schema = f"row {carried.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    out = carried.mapInArrow(run, schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("lang_pred").alias(into[0]), F.col("score").alias(into[1]))
