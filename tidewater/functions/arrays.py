"""Array-valued post fields as Column expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def array_count(c: Column | str) -> Column:
    """Number of elements; a NULL array counts as 0."""
    c = _col(c)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c)).cast("long")


def media_keys(urls: Column | str) -> Column:
    """Media keys of a url array, keeping only non-null, non-empty keys."""
    keys = F.transform(_col(urls), lambda u: u["media_key"])
    return F.filter(keys, lambda k: k.isNotNull() & (k != F.lit("")))


def media_count(urls: Column | str) -> Column:
    """Number of media urls (not distinct); 0 when the array is NULL."""
    return array_count(media_keys(urls))


def external_url_count(urls: Column | str) -> Column:
    """Urls that are not media: all urls minus media urls."""
    return array_count(urls) - media_count(urls)


def names_of(annotations: Column | str, field: str = "entity") -> Column:
    """Distinct non-null ``<field>.name`` of an annotation array (each label once per post)."""
    names = F.transform(_col(annotations), lambda a: a[field]["name"])
    return F.array_distinct(F.filter(names, lambda n: n.isNotNull()))


def first_element(c: Column | str) -> Column:
    """First array element, NULL for a NULL or empty array."""
    return F.try_element_at(_col(c), F.lit(1))
