"""Rule counts against a plain version; the forest on labelled rows; odd inputs."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF01
from tidewater.llm import quality
from tidewater.llm.catalog import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if runs[tuple(words[i : i + 8])] > 1:
            inside |= set(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


def test_counts_on_random_texts():
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b ", "c\n", "é", "#", "\t", "<x>", "\x1c", "  ", "\r\n", " "]) for _ in range(rng.randint(0, 120)))
        assert quality.statistics_of(text)[:5] == plain(text)
    assert quality.statistics_of("the same eight words are here again now " * 3)[4] == 24


def test_query_counts_and_verdicts(spark):
    import duckdb

    con = duckdb.connect()
    texts = dict(con.execute(f"SELECT doc_id, text FROM '{SF01}/documents.parquet'").fetchall())
    labels = dict(con.execute(f"SELECT doc_id, quality FROM '{SF01}/labels.parquet'").fetchall())
    rows = QUERIES["op1_quality_rules"](spark, SF01).collect()
    assert len(rows) == len(texts)
    good = bad = good_kept = bad_kept = 0
    for r in rows:
        want = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)
        if not failed and labels.get(r.doc_id) == 1:
            good, good_kept = good + 1, good_kept + r.kept
        if not failed and labels.get(r.doc_id) == 0:
            bad, bad_kept = bad + 1, bad_kept + r.kept
    assert good_kept >= 0.98 * good and bad_kept <= 0.1 * bad


def test_forest_isolates_what_is_unlike_its_rows():
    rng = np.random.default_rng(0)
    rows = rng.normal(0, 1, (1000, 3))
    forest = quality.IsolationForest(rows, [-10] * 3, [10] * 3)
    scores = forest.score(np.array([[0, 0, 0], [9, 9, 9], [0, 0, 9.0]]))
    assert scores[0] < scores[2] < scores[1]


def test_nulls_empty_and_unlabelled(spark):
    rows = [(1, None, 5), (2, "", 5), (2, "w " * 30, 5), (2, "w " * 30, 5), (3, " ".join(f"w{i}" for i in range(40)), 5), (None, "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = {(r.doc_id, r.n_words): r.kept for r in quality.judge(docs, labels).collect()}
    assert out == {(1, 0): False, (2, 0): False, (2, 30): False, (3, 40): True, (None, 1): False}
    assert quality.judge(docs.limit(0), labels).count() == 0
    some = spark.createDataFrame([(3, 1, 0), (3, None, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert quality.judge(docs, some).count() == len(rows)


def test_an_extreme_row_changes_no_verdict(spark):
    """Documents bad by word length only, with and without an unbroken string of a megabyte."""
    rng = random.Random(2)
    text = lambda a, b: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(a, b))) for _ in range(60))

    def uneven(i):
        """A good text; one in four has some symbols, one in four some words twice."""
        words = text(3, 7).split()
        some = rng.randrange(20)
        change = {1: lambda w: "#" + w, 2: lambda w: f"{w} {w}"}.get(i % 4, str)
        return " ".join([change(w) for w in words[:some]] + words[some:])

    rows = [(i, uneven(i)) for i in range(256)] + [(i, text(19, 21)) for i in range(256, 320)]
    words = text(3, 7).split()
    rows += [(400, "#" * 9 + " ".join("#" + w for w in words)), (401, " ".join(f"{w} {w}" for w in words))]
    rows += [(402, "\n".join(w + "\nand" for w in words)), (403, " ".join(words + words[:8]))]
    labels = spark.createDataFrame([(i, int(i < 256), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    odd = [(1000, " ".join(["a b c d e f g h i j k l m n o p q r s", "x" * 1_000_000]))]

    def kept(rows):
        return {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()}

    plain, stretched = kept(rows), kept(rows + odd)
    assert not stretched.pop(1000) and stretched == plain
    assert sum(plain[i] for i in range(256)) >= 250 and not any(plain[i] for i in range(256, 320))


@pytest.mark.parametrize("wrong", [1, 3])
def test_wrong_labels_do_not_switch_the_threshold_off(spark, wrong):
    """Bad rows labelled good score above all others."""
    scores = [0.3] * 60 + [0.9] * wrong + [0.7] * 40
    rows = spark.createDataFrame([(i, 30, 0, x) for i, x in enumerate(scores)], "doc_id long, n_words long, n_repeat_words long, score double")
    labels = spark.createDataFrame([(i, int(i < 60 + wrong)) for i in range(len(scores))], "doc_id long, quality int")
    assert 0.3 < quality.threshold(rows, labels) < 0.7
