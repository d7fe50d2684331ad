"""Held-out accuracy, the hierarchy, and odd inputs."""

import random
import zlib

from tests.conftest import SF01
from tidewater.llm import langid
from tidewater.llm.catalog import QUERIES


def test_held_out_accuracy(spark):
    import duckdb

    truth = dict(duckdb.connect().execute(f"SELECT doc_id, lang FROM '{SF01}/documents.parquet'").fetchall())
    rows = QUERIES["op6_language"](spark, SF01).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def synthetic(n=60):
    """Five made-up languages: two pairs in one family share most letters."""
    rng, rows = random.Random(2), []
    letters = {"en": "abcdefgh", "de": "abcdefgü", "nl": "abcdeijk", "fr": "mnopqrst", "zz": "uvwxyzäö"}
    for i in range(n * len(letters)):
        lang = list(letters)[i % len(letters)]
        rows.append((i, " ".join("".join(rng.choices(letters[lang], k=5)) for _ in range(40)), lang))
    return rows


def test_hierarchy_with_an_unknown_family(spark):
    rows = synthetic()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.families == [["zz"], ["de", "en", "nl"], ["fr"]]
    assert set(model.pairs) == {("de", "en"), ("de", "nl"), ("en", "nl")}
    out = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert sum(out[i] == lang for i, _, lang in rows) >= 0.98 * len(rows)


def test_odd_inputs(spark):
    rows = [(i, t, "en" if i % 2 else "fr", "x") for i, t, _ in synthetic(20)]
    rows += [(900, None, "en", "x"), (901, "", "en", "x"), (902, "123 !! ☃", "fr", "x"), (903, "abc", None, "x"), (None, "abc", "en", "x")]
    rows += [(904, "hello wörld " * 200_000, "en", "x"), (904, "hello wörld " * 200_000, "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = langid.predict(docs, langid.fit(docs))
    assert sorted(out.columns) == ["doc_id", "lang", "lang_pred", "score", "text"] and out.count() == len(rows)
    found = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert all(found[i] == ("und", 0.0) for i in (900, 901, 902))
    assert found[903][0] in ("en", "fr")


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.fit(docs) is None
    assert langid.predict(docs, None).first().lang_pred == "und"
    assert langid.fit(docs.limit(0)) is None and langid.predict(docs.limit(0), None).count() == 0
    one = spark.createDataFrame([(i, "abc def", "en") for i in range(9)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in langid.predict(one, langid.fit(one)).collect()} == {("en", 1.0)}
