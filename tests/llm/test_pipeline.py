"""The stages one after the other, each on odd rows, and the guard around the subpackage."""

import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF001
from tests.llm.test_jaccard import brute
from tidewater.llm.catalog import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, ids string, component string, _row string"
TEXT = "the quick brown fox jumps over the lazy dog near the river bank today"
ROWS = [
    (1, TEXT, "en", "a", 68, 1, "x", "y", "z"),
    (2, TEXT + " again", "en", "a", 74, None, None, None, None),
    (2, TEXT + " again", "en", "a", 74, None, None, None, None),
    (3, None, "en", "b", None, 1, "x", "y", "z"),
    (4, "", None, None, 0, 1, "x", "y", "z"),
    (5, "12345 !!", "de", "b", 8, 1, "x", "y", "z"),
    (None, "ein kurzer Text ohne Nummer", "de", None, 27, 1, "x", "y", "z"),
    (7, "call +1 (017) 555-7713 or 97.51.17.173 please now", "en", "c", 50, 1, "x", "y", "z"),
    (8, "word " * 30_000, "en", "c", 150_000, 1, "x", "y", "z"),
]


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows(spark, stage):
    name, function = stage
    docs = spark.createDataFrame(ROWS, SCHEMA)
    out = function(spark, docs, SF001)
    if name != "BPE":
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = out.collect()
    ids = [r.doc_id for r in rows]
    if name == "language ID":
        assert sorted(i or 0 for i in ids) == [0, 1, 2, 2, 7, 8]
    elif name == "n-gram Jaccard join":
        assert sorted(i or 0 for i in ids) == [0, 1, 3, 4, 5, 7, 8]
    elif name == "PII":
        changed = next(r for r in rows if r.doc_id == 7)
        assert len(rows) == len(ROWS) and "555-7713" not in changed.text and changed.n_chars == len(changed.text)
    elif name == "BPE":
        assert len(rows) == len(ROWS) and set(COLUMNS) <= set(out.columns)
        assert next(r for r in rows if r.doc_id == 3).n_tokens == 0
    empty = function(spark, docs.limit(0), SF001)
    assert empty.count() == 0


def test_whole_pipeline(spark, tmp_path):
    docs, before = spark.read.parquet(f"{SF001}/documents.parquet"), None
    kept = {}
    for name, function in corpus_pipeline.STAGES:
        function(spark, docs, SF001).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = (before.collect(), docs.collect())
    before, after = kept["n-gram Jaccard join"]
    groups = brute([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in groups})
    before, after = kept["mixing sources"]
    size = sum(len(r.text.split()) for r in before)
    assert abs(sum(len(r.text.split()) for r in after) - size) < 0.35 * size
    public = Tokenizer.from_file(tokenizer_path())
    for r in kept["BPE"][1]:
        ids = public.encode(r.text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(public.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_run_is_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF001)
    assert {"doc_id", "text", "n_tokens", "ids"} <= set(out.columns) and out.count() > 0
