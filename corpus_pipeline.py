"""The training-data pipeline: five operators over ``documents``, one after the other.

Each stage takes ``(spark, docs, sf_dir)`` and returns the rows it keeps; all but
the last return the columns of its input.  ``run`` writes every stage's rows to
the shared scratch folder and reads them again, so a stage that scans its input
several times, or a retry after a lost executor, starts from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, jaccard, langid, mixing, pii
from tidewater.llm.catalog import pii_key, tokenizer_path
from tidewater.llm.common import read, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be identified; a missing ``lang`` is filled in."""
    model = langid.fit(docs)
    found = langid.predict(docs, model, into=("_lang_pred", "_lang_score")).where(F.col("_lang_pred") != langid.UNKNOWN)
    filled = F.coalesce("lang", "_lang_pred")
    return found.select(*[filled.alias(c) if c == "lang" else F.col(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.one_per_group(docs)


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms; ``n_chars`` follows a changed text."""
    done = pii.pseudonymize(docs, pii_key(spark), found="_pii_found")
    length = F.when(F.col("_pii_found") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    kinds = dict(docs.dtypes)
    return done.select(*[length.cast(kinds[c]).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents dropped or repeated so that the sources meet their target weights."""
    return mixing.emit(docs, mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and the digests of both directions."""
    back = bpe.encode_and_decode(docs, tokenizer_path(), into=("ids", "_decoded"))
    made = {
        "n_tokens": (F.octet_length("ids") / 4).cast("long"),
        "ids_sha256": F.sha2("ids", 256),
        "decoded_sha256": F.sha2(F.col("_decoded").cast("binary"), 256),
    }
    kept = [c for c in back.columns if c not in made and c != "_decoded"]
    return back.select(*kept, *[column.alias(name) for name, column in made.items()])


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("PII", pseudonymize),
    ("mixing sources", mix_sources),
    ("BPE", encode),
]

#: Learned classification, near-duplicate search and BPE are beyond SQL; the tests check each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
