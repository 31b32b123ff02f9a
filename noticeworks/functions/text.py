"""Text, key and cast expressions shared by all feeds."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_INSTANT = r"^\d{4}-\d{2}-\d{2}([T ]\d{1,2}:\d{2}.*)?$"
# Java's \s is ASCII only under plain matching; (?U) makes it cover every Unicode blank.
EDGE_BLANKS = r"(?U)^\s+|\s+$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Empty string becomes NULL, so that ``coalesce`` moves on to the next candidate."""
    return F.nullif(col(c), F.lit(""))


def first_non_blank(*cs: Column | str) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cs])


def strip(c: Column | str) -> Column:
    """Remove every kind of white space at both ends (Spark's ``trim`` removes spaces only)."""
    return F.regexp_replace(col(c), EDGE_BLANKS, "")


def last_segment(path: Column | str) -> Column:
    """Last path segment once trailing slashes are gone; NULL when nothing is left."""
    return blank_to_null(F.substring_index(F.rtrim(col(path), F.lit("/")), "/", -1))


def alias_key(name: Column | str) -> Column:
    return F.lower(F.trim(col(name)))


def text_key(text: Column | str, length: int | None = None) -> Column:
    """Lower-case letters and digits only, optionally the first ``length`` of them."""
    key = F.regexp_replace(F.lower(F.trim(col(text))), "[^a-z0-9]", "")
    return key if length is None else F.substring(key, 1, length)


def iso_day(text: Column | str) -> Column:
    """First ten characters of a timestamp text; NULL when empty."""
    return blank_to_null(F.substring(col(text), 1, 10))


def to_day(text: Column | str) -> Column:
    """DATE from ``YYYY-MM-DD`` text; anything else is NULL instead of an error."""
    c = col(text)
    return F.when(c.rlike(ISO_DATE), c.try_cast("date"))


def to_number(text: Column | str) -> Column:
    return F.trim(col(text)).try_cast("double")


def to_instant(text: Column | str) -> Column:
    """TIMESTAMP from an ISO date, alone or with a time; a bare time or year is NULL, not part of today."""
    c = F.trim(col(text))
    return F.when(c.rlike(ISO_INSTANT), c.try_cast("timestamp"))


def month_of(day: Column | str) -> Column:
    """First instant of the month, without a time zone."""
    return F.date_trunc("month", col(day)).cast("timestamp_ntz")


def version_label(version: Column | str) -> Column:
    """``v``-prefixed version; NULL reads ``unknown``."""
    c = F.coalesce(col(version), F.lit("unknown"))
    bare = F.ltrim(c, F.lit("v"))
    return F.when(bare == "unknown", bare).otherwise(F.concat(F.lit("v"), bare))


def java_quote(literal: str) -> str:
    """Quote ``literal`` for a Java regular expression."""
    return re.sub(r"([^\w\s])", r"\\\1", literal)
