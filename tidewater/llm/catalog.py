"""Queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, collocations, html_text, jaccard, langid, mixing, oracles, pii, quality, suffix_dedup, topk, variants, warc
from .common import read


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Systematic sampling of all documents to the source weights 5, 2, 1."""
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as dictionary-compressed WARC archives and read back."""
    pages = read(spark, sf_dir, "pages")
    return warc.read_archives(warc.write_archives(pages)).drop("html", "url")


def tokenizer_path() -> str:
    """The tokenizer file of op7 (the public files' own module knows where they are)."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded, then decoded, with the digests of both."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    back = bpe.encode_and_decode(docs, tokenizer_path()).drop("text")
    return back.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts, base verdict and the forest's verdict of every document."""
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(read(spark, sf_dir, "pages"))


#: Where a session names the secret key of the pseudonyms.
PII_KEY_CONF = "spark.tidewater.pii.key"
#: For synthetic tables only: anybody who reads this can restore what it hides.
EXAMPLE_PII_KEY = "replace-this-key"


def pii_key(spark: SparkSession) -> str:
    """The session's key; without one that of the examples, with a warning."""
    key = spark.conf.get(PII_KEY_CONF, None)
    if not key:
        warnings.warn(f"{PII_KEY_CONF} is not set: pseudonyms use the public example key", stacklevel=2)
    return key or EXAMPLE_PII_KEY


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text with its personal data pseudonymized."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, pii_key(spark), found="n_found")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from the rows that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every fiftieth vector, over all vectors."""
    rows = read(spark, sf_dir, "embeddings").where(topk.usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = rows.select("vec_id", topk.scaled(F.col("embedding")).alias("vector"))
    return topk.search(rows, F.col("vec_id") % 50 == 0)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that occur more than once."""
    cut = suffix_dedup.dedup(read(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, forms and roots of the vocabulary of all documents."""
    return variants.variants(variants.word_counts(read(spark, sf_dir, "documents")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two and three words of each language over all documents."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


#: A conversation whose texts look like the template's own marks.
LOOKALIKE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted with a loss mask, and what reading them back gives."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(LOOKALIKE, "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_chats(rows.unionByName(extra)))


QUERIES = {
    "op12_chat_format": op12_chat_format,
    "op13_collocations": op13_collocations,
    "op11_spelling_variants": op11_spelling_variants,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op2_exact_topk": op2_exact_topk,
    "op6_language": op6_language,
    "op9_pii": op9_pii,
    "op8_html_text": op8_html_text,
    "op1_quality_rules": op1_quality_rules,
    "op7_bpe": op7_bpe,
    "op10_warc": op10_warc,
    "op3_source_mix": op3_source_mix,
}

ORACLES = oracles.ORACLES
