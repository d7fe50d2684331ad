"""Schemas used by the readers.

``PAGE_DDL`` is the superset page schema (one JSON line = one API response
page holding an array of posts and side tables).  It is read as an explicit
schema so that fields missing from one file come back as NULL instead of
breaking nested access.  Parsed lazily because DDL parsing needs a session.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql.types import (
    DoubleType,
    StringType,
    StructField,
    StructType,
)

# The page layout of the source API (field names and types as
# they appear in the source data; must match for the reader to find fields).
PAGE_DDL = """
__twarc struct<
  retrieved_at: string,
  url: string,
  version: string>,
data array<struct<
  attachments: struct<
    media_keys: array<string>,
    poll_ids: array<string>>,
  author_id: string,
  context_annotations: array<struct<
    domain: struct<
      description: string,
      id: string,
      name: string>,
    entity: struct<
      description: string,
      id: string,
      name: string>>>,
  conversation_id: string,
  created_at: string,
  edit_controls: struct<
    editable_until: string,
    edits_remaining: bigint,
    is_edit_eligible: boolean>,
  edit_history_tweet_ids: array<string>,
  entities: struct<
    annotations: array<struct<
      end: bigint,
      normalized_text: string,
      probability: double,
      start: bigint,
      type: string>>,
    cashtags: array<struct<
      end: bigint,
      start: bigint,
      tag: string>>,
    hashtags: array<struct<
      end: bigint,
      start: bigint,
      tag: string>>,
    mentions: array<struct<
      end: bigint,
      id: string,
      start: bigint,
      username: string>>,
    urls: array<struct<
      description: string,
      display_url: string,
      end: bigint,
      expanded_url: string,
      images: array<struct<
        height: bigint,
        url: string,
        width: bigint>>,
      media_key: string,
      start: bigint,
      status: bigint,
      title: string,
      unwound_url: string,
      url: string>>>,
  geo: struct<
    coordinates: struct<
      coordinates: array<double>,
      type: string>,
    place_id: string>,
  id: string,
  in_reply_to_user_id: string,
  lang: string,
  possibly_sensitive: boolean,
  public_metrics: struct<
    impression_count: bigint,
    like_count: bigint,
    quote_count: bigint,
    reply_count: bigint,
    retweet_count: bigint>,
  referenced_tweets: array<struct<
    id: string,
    type: string>>,
  reply_settings: string,
  text: string,
  withheld: struct<
    copyright: boolean,
    country_codes: array<string>>>>,
errors array<struct<
  detail: string,
  parameter: string,
  resource_id: string,
  resource_type: string,
  section: string,
  title: string,
  type: string,
  value: string>>,
includes struct<
  media: array<struct<
    alt_text: string,
    duration_ms: bigint,
    height: bigint,
    media_key: string,
    preview_image_url: string,
    public_metrics: struct<
      view_count: bigint>,
    type: string,
    url: string,
    variants: array<struct<
      bit_rate: bigint,
      content_type: string,
      url: string>>,
    width: bigint>>,
  places: array<struct<
    country: string,
    country_code: string,
    full_name: string,
    geo: struct<
      bbox: array<double>,
      type: string>,
    id: string,
    name: string,
    place_type: string>>,
  polls: array<struct<
    duration_minutes: bigint,
    end_datetime: string,
    id: string,
    options: array<struct<
      label: string,
      position: bigint,
      votes: bigint>>,
    voting_status: string>>,
  tweets: array<struct<
    attachments: struct<
      media_keys: array<string>,
      poll_ids: array<string>>,
    author_id: string,
    context_annotations: array<struct<
      domain: struct<
        description: string,
        id: string,
        name: string>,
      entity: struct<
        description: string,
        id: string,
        name: string>>>,
    conversation_id: string,
    created_at: string,
    edit_controls: struct<
      editable_until: string,
      edits_remaining: bigint,
      is_edit_eligible: boolean>,
    edit_history_tweet_ids: array<string>,
    entities: struct<
      annotations: array<struct<
        end: bigint,
        normalized_text: string,
        probability: double,
        start: bigint,
        type: string>>,
      cashtags: array<struct<
        end: bigint,
        start: bigint,
        tag: string>>,
      hashtags: array<struct<
        end: bigint,
        start: bigint,
        tag: string>>,
      mentions: array<struct<
        end: bigint,
        id: string,
        start: bigint,
        username: string>>,
      urls: array<struct<
        description: string,
        display_url: string,
        end: bigint,
        expanded_url: string,
        images: array<struct<
          height: bigint,
          url: string,
          width: bigint>>,
        media_key: string,
        start: bigint,
        status: bigint,
        title: string,
        unwound_url: string,
        url: string>>>,
    geo: struct<
      coordinates: struct<
        coordinates: array<double>,
        type: string>,
      place_id: string>,
    id: string,
    in_reply_to_user_id: string,
    lang: string,
    possibly_sensitive: boolean,
    public_metrics: struct<
      impression_count: bigint,
      like_count: bigint,
      quote_count: bigint,
      reply_count: bigint,
      retweet_count: bigint>,
    referenced_tweets: array<struct<
      id: string,
      type: string>>,
    reply_settings: string,
    text: string,
    withheld: struct<
      copyright: boolean,
      country_codes: array<string>,
      scope: string>>>,
  users: array<struct<
    created_at: string,
    description: string,
    entities: struct<
      description: struct<
        cashtags: array<struct<
          end: bigint,
          start: bigint,
          tag: string>>,
        hashtags: array<struct<
          end: bigint,
          start: bigint,
          tag: string>>,
        mentions: array<struct<
          end: bigint,
          start: bigint,
          username: string>>,
        urls: array<struct<
          display_url: string,
          end: bigint,
          expanded_url: string,
          start: bigint,
          url: string>>>,
      url: struct<
        urls: array<struct<
          display_url: string,
          end: bigint,
          expanded_url: string,
          start: bigint,
          url: string>>>>,
    id: string,
    location: string,
    name: string,
    pinned_tweet_id: string,
    profile_image_url: string,
    protected: boolean,
    public_metrics: struct<
      followers_count: bigint,
      following_count: bigint,
      listed_count: bigint,
      tweet_count: bigint>,
    url: string,
    username: string,
    verified: boolean,
    withheld: struct<
      country_codes: array<string>>>>>,
meta struct<
  newest_id: string,
  next_token: string,
  oldest_id: string,
  result_count: bigint>
"""


@lru_cache(maxsize=1)
def page_schema() -> StructType:
    """The page schema as a ``StructType`` (needs an active session)."""
    return StructType.fromDDL(PAGE_DDL)


def post_schema() -> StructType:
    """Schema of one element of ``data`` (a post)."""
    return page_schema()["data"].dataType.elementType


def single_post_schema() -> StructType:
    """Sample-stream line: ``data`` is one post struct, not an array."""
    fields = [
        StructField(f.name, post_schema() if f.name == "data" else f.dataType, True)
        for f in page_schema().fields
    ]
    return StructType(fields)


# Tick inputs (column names as the tick files carry them).
TRADE_SCHEMA = StructType(
    [
        StructField("xltime", DoubleType()),
        StructField("trade-price", DoubleType()),
        StructField("trade-volume", DoubleType()),
        StructField("trade-rawflag", StringType()),
        StructField("trade-stringflag", StringType()),
    ]
)

QUOTE_SCHEMA = StructType(
    [
        StructField("xltime", DoubleType()),
        StructField("bid-price", DoubleType()),
        StructField("bid-volume", DoubleType()),
        StructField("ask-price", DoubleType()),
        StructField("ask-volume", DoubleType()),
    ]
)
