"""Spelling variants against all pairs in plain Python, and their odd inputs."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tidewater.llm import variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {ord(a): b for a, b in zip(variants.UPPER, variants.LOWER, strict=True)}


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain(counts: dict) -> list:
    best, met = {}, {}
    for w in counts:
        others = [v for v in counts if near(w, v)]
        met[w] = len(others)
        top = min(others, key=lambda v: (-counts[v], v), default=None)
        best[w] = top if top is not None and counts[top] >= 2 * counts[w] else None

    def root(w):
        return w if best[w] is None else root(best[w])

    return sorted((w, best[w], root(w), n, met[w], best[w] and counts[best[w]]) for w, n in counts.items())


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def test_pairs_match_all_pairs(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(500)}
    counts = {w: rng.randint(1, 40) for w in words}
    assert got(variants.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == plain(counts)


def test_long_words_runs_and_astral_letters(spark):
    long = "ab" * 400 + "x" + "cd" * 400
    counts = {
        long: 50,
        long[:-1]: 5,
        long[1:]: 4,
        long.replace("x", "y"): 3,
        "a" * 3000: 9,
        "a" * 2999: 2,
        "𐐀𐐁𐐂𐐃𐐄": 8,
        "𐐀𐐁𐐃𐐄": 1,
        "alone": 7,
    }
    assert got(variants.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == plain(counts)


def test_chain_of_forms_leads_to_its_end(spark):
    counts = {"aaaaa": 1, "aaaab": 2, "aaabb": 4, "aabbb": 8, "abbbb": 16, "bbbbb": 32}
    rows = got(variants.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert rows == plain(counts) and rows[0][2] == "bbbbb"


def test_counts_of_documents(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["Hello", "hEllo", "ÉCOLE", "école", "worlds", "abc", "naïve_x"]) for _ in range(60)) for _ in range(60)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(1, texts[1], "x"), (None, "Hello worlds", None), (7, None, "y"), (8, "", "y"), (9, "12 !", "y")]
    want = Counter()
    for i, text, _ in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string").withColumn("n", F.lit(1))
    found = {r.word: r.n for r in variants.word_counts(docs).collect()}
    assert found == {w: n for w, n in want.items() if n >= 3 and len(w) >= 5}


def test_empty_and_no_neighbours(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert got(variants.variants(variants.word_counts(none))) == []
    one = spark.createDataFrame([("alone", 4)], "word string, n long")
    assert got(variants.variants(one)) == [("alone", None, "alone", 4, 0, None)]


def test_no_join_is_broadcast(spark, monkeypatch):
    """Spark takes the states for as small as the words they come from."""
    plans, stored = [], variants.stored

    def seen(df, tag):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, tag)

    monkeypatch.setattr(variants, "stored", seen)
    counts = spark.createDataFrame([("words", 9), ("word", 2), ("sword", 1), ("ward", 4)], "word string, n long")
    last = variants.variants(counts)
    plans.append(last._jdf.queryExecution().executedPlan().toString())
    assert last.count() == 4 and sum("SortMergeJoin" in p for p in plans) > 4
    assert not [p for p in plans if "BroadcastHashJoin" in p]
