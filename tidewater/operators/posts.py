"""Post, metric and author tables from nested pages.

All functions are DataFrame -> DataFrame and lazy.  Nested fields are read
by path so Catalyst prunes the nested schema (Parquet reads only the
leaves used; JSON parses only the needed top-level fields).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import first_element


def explode_posts(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per element of ``data``; NULL or empty ``data`` yields no rows.

    ``keep`` names page-level columns carried next to the ``post`` struct.
    """
    return pages.select(*keep, F.explode("data").alias("post"))


def posts(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exploded posts with the post struct flattened to top-level columns."""
    return explode_posts(pages, keep).select(*keep, "post.*")


def eligible_posts(post_df: DataFrame) -> DataFrame:
    """Posts that carry entities and an annotation array (an empty array passes)."""
    return post_df.filter(F.col("entities").isNotNull() & F.col("context_annotations").isNotNull())


def project_posts(post_df: DataFrame, text: bool = True) -> DataFrame:
    """The nine fields the feature table is built from (eight for posts that come without their text)."""
    return post_df.select(
        *([F.col("text").alias("tweet_text")] if text else []),
        F.col("created_at").alias("tweet_date"),
        F.col("entities.hashtags").alias("tweet_hashtags"),
        F.col("entities.mentions").alias("tweet_mentions"),
        F.col("entities.urls").alias("tweet_urls"),
        F.col("author_id").alias("user_id"),
        F.col("id").alias("tweet_id"),
        F.col("context_annotations"),
        F.col("public_metrics.impression_count").alias("impression_count"),
    )


METRIC_COLUMNS = ("retweet_count", "reply_count", "like_count", "quote_count", "impression_count")
AUTHOR_COLUMNS = ("followers_count", "following_count", "tweet_count", "listed_count")


def project_metrics(post_df: DataFrame) -> DataFrame:
    """id, author, time and the five public counters of each post."""
    return post_df.select(
        "id", "author_id", "created_at",
        *[F.col(f"public_metrics.{c}").alias(c) for c in METRIC_COLUMNS],
    )


def first_user(pages: DataFrame) -> DataFrame:
    """The first user of each page (the page's author); pages without users dropped."""
    return pages.select(first_element(F.col("includes.users")).alias("user")).filter(F.col("user").isNotNull())


def all_users(pages: DataFrame) -> DataFrame:
    """Every user of every page."""
    return pages.select(F.explode("includes.users").alias("user"))


def project_authors(users: DataFrame) -> DataFrame:
    """author_id and the four public counters from a ``user`` struct column."""
    return users.select(
        F.col("user.id").alias("author_id"),
        *[F.col(f"user.public_metrics.{c}").alias(c) for c in AUTHOR_COLUMNS],
    )


def page_users(pages: DataFrame, users: str = "first") -> DataFrame:
    """(user_id, followers_count, retrieved_at) per page; ``users`` = "first" | "all".

    Only pages that hold posts count, as in the source pipeline.
    """
    base = pages.filter(F.size("data") > 0)
    if users == "first":
        u = base.select(F.col("__twarc.retrieved_at").alias("retrieved_at"), first_element(F.col("includes.users")).alias("user"))
    elif users == "all":
        u = base.select(F.col("__twarc.retrieved_at").alias("retrieved_at"), F.explode("includes.users").alias("user"))
    else:
        raise ValueError(f"users must be 'first' or 'all', not {users!r}")
    return u.filter(F.col("user").isNotNull()).select(
        F.col("user.id").alias("user_id"),
        F.col("user.public_metrics.followers_count").alias("followers_count"),
        "retrieved_at",
    )


def dedup_users(users: DataFrame, key: str = "user_id", value: str = "followers_count", order: str = "retrieved_at") -> DataFrame:
    """One row per user: the value of the latest page (ties: the larger value).

    ``max_by`` is a partial/final aggregate, so each map task combines its
    own rows before the shuffle; a hot user costs one row per task.
    """
    return users.groupBy(key).agg(F.max_by(F.col(value), F.struct(F.col(order), F.col(value))).alias(value))


def attach_followers(features: DataFrame, followers: DataFrame, on: str = "user_id") -> DataFrame:
    """Inner equi join of post features with deduplicated followers (broadcast when their measured size allows)."""
    from .joins import sized_join

    return sized_join(features, followers, on)


def posts_with_authors(pages: DataFrame, dedup: bool = True) -> DataFrame:
    """Flat post + author table: post counters left-joined to the page author.

    One row per author (latest page).  ``dedup=False`` fans out instead: a row
    for every page of an author, as the exploration notebook does, so the output
    grows with posts times pages of an author.
    """
    metrics = project_metrics(posts(pages))
    if dedup:
        authors = project_authors(
            pages.select(F.col("__twarc.retrieved_at").alias("retrieved_at"), first_element(F.col("includes.users")).alias("user"))
            .filter(F.col("user").isNotNull())
            .groupBy(F.col("user.id").alias("uid"))
            .agg(F.max_by("user", F.struct("retrieved_at", "user")).alias("user"))
        )
    else:
        authors = project_authors(first_user(pages))
    return metrics.join(authors, on="author_id", how="left")


def sample_posts(lines: DataFrame, lang: str | None = None) -> DataFrame:
    """Single-post lines (``data`` is one struct): nine flat fields incl. first user's followers."""
    base = lines.filter(F.col("includes").isNotNull() & F.col("data").isNotNull())
    if lang is not None:
        base = base.filter(F.col("data.lang") == lang)
    return base.select(
        F.col("data.id").alias("id"),
        F.col("data.author_id").alias("author_id"),
        F.col("data.created_at").alias("created_at"),
        *[F.col(f"data.public_metrics.{c}").alias(c) for c in METRIC_COLUMNS[:4]],
        F.col("data.public_metrics.impression_count").alias("impression_count"),
        first_element(F.col("includes.users"))["public_metrics"]["followers_count"].alias("followers_count"),
    )


def by_language(df: DataFrame, lang: str, column: str = "lang") -> DataFrame:
    """Rows of one language."""
    return df.filter(F.col(column) == lang)


def threshold(df: DataFrame, column: str, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Keep rows with ``lo <= column`` and ``column < hi`` (either bound optional)."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(column) >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(column) < F.lit(hi))
    return df.filter(cond)


def select_terms(df: DataFrame, terms: list[str], response: str | None = None) -> DataFrame:
    """Keep the given columns (and the response)."""
    cols = list(terms) + ([response] if response and response not in terms else [])
    return df.select(*cols)


def cast_columns(df: DataFrame, columns: list[str], to: str) -> DataFrame:
    """Cast columns, NULL where a value does not convert."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in columns})


def rename(df: DataFrame, names: list[str]) -> DataFrame:
    """Positional rename."""
    return df.toDF(*names)
