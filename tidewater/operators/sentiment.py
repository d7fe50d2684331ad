"""Lexicon sentiment with the lexicon as a table of any size.

Each text becomes its tokens, every one with what the three tokens before it do to
its valence (packed in the row, before any join).  Tokens are then joined
with the lexicon by word; those without a match drop out, and the rest are summed
per text.  The plan does not grow with the lexicon.  A lexicon within the broadcast limits
is broadcast after it was measured; a larger one is joined on (word, salt), its rows
repeated ``SALT`` times, so a very common word is spread over that many tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    BOOSTER_DECAY,
    BOOSTER_INCREMENT,
    BOOSTERS_DOWN,
    BOOSTERS_UP,
    NEGATION_FACTOR,
    NEGATIONS,
    SQUASH_ALPHA,
    tokens,
)
from ..session import staged
from .joins import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, measured

SALT = 16


def token_effects(
    text: Column | str,
    boosters_up: tuple[str, ...] = BOOSTERS_UP,
    boosters_down: tuple[str, ...] = BOOSTERS_DOWN,
    negations: tuple[str, ...] = NEGATIONS,
) -> tuple[Column, Callable[[Column, Column], Column]]:
    """The tokens of a text, and the function that gives each (of a column ``_words`` of
    them) as struct<word, boost, negated>: the effect of the three tokens before it."""
    words = tokens(text)

    def at(i: Column, back: int) -> Column:
        return F.get(F.col("_words"), i - back)

    def effect(word: Column, i: Column) -> Column:
        boost, negated = F.lit(0.0), F.lit(False)
        for back, decay in enumerate(BOOSTER_DECAY, 1):
            before = F.when(i >= back, at(i, back))
            step = F.lit(BOOSTER_INCREMENT * decay)
            boost = boost + F.when(before.isin(*boosters_up), step).when(before.isin(*boosters_down), -step).otherwise(F.lit(0.0))
            negated = negated | F.coalesce(before.isin(*negations), F.lit(False))
        return F.struct(word.alias("word"), boost.alias("boost"), negated.alias("negated"))

    return words, effect


def lexicon_scores(
    texts: DataFrame,
    lexicon: DataFrame,
    key: str = "id",
    text: str = "text",
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
    **effects: tuple[str, ...],
) -> DataFrame:
    """``key, sentiment`` of every row of ``texts``; ``lexicon(word, valence)`` has one row per word.

    The same score as ``functions.text.sentiment_score`` with these valences; 0
    without a lexicon word or without text.  ``key`` must be unique.
    """
    words, effect = token_effects(F.col(text), **effects)
    rows = texts.select(F.col(key), words.alias("_words"))
    found = rows.select(key, F.inline(F.transform("_words", effect)))
    lexicon = lexicon.select(F.col("word"), F.col("valence").cast("double").alias("valence"))
    n, size = measured(lexicon)
    if n <= max_rows and size <= max_bytes:
        hits = found.join(F.broadcast(lexicon), "word")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")
        hits = found.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALT)).cast("int")).join(lexicon.select("*", salts), ["word", "salt"])
    moved = F.col("valence") + F.signum("valence") * F.col("boost")
    value = F.when(F.col("negated"), moved * F.lit(NEGATION_FACTOR)).otherwise(moved)
    sums = staged(hits.groupBy(key).agg(F.sum(value).alias("_sum")), "hits")
    total = F.coalesce(F.col("_sum"), F.lit(0.0))
    return texts.select(key).join(sums, key, "left").select(key, (total / F.sqrt(total * total + F.lit(SQUASH_ALPHA))).alias("sentiment"))
