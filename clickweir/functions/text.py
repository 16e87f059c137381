"""String, hash and codec column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickweir import schemas


def not_blank(c: Column) -> Column:
    """True when the text holds a non-whitespace character; null counts as blank."""
    return F.coalesce(c.rlike(r"\P{javaWhitespace}"), F.lit(False))


def is_blank(c: Column) -> Column:
    return ~not_blank(c)


def blank_to_null(c: Column) -> Column:
    return F.when(not_blank(c), c)


def major_version(c: Column) -> Column:
    """Text before the first dot, or the whole text without one."""
    return F.substring_index(c, ".", 1)


def crc32_of(*parts: Column) -> Column:
    """Unsigned CRC32 of the concatenated UTF-8 bytes; null parts are left out."""
    return F.crc32(F.concat_ws("", *parts).cast("binary"))


def url_decoded(c: Column) -> Column:
    """URL-decoded UTF-8 text, null when malformed; plain text is passed through."""
    encoded = c.contains("%") | c.contains("+")
    return F.when(encoded, F.try_url_decode(c)).otherwise(c)


def drop_trailing(c: Column, literal: str) -> Column:
    """Remove every trailing repetition of ``literal``."""
    pattern = "(?:" + "".join("\\" + ch if not ch.isalnum() else ch for ch in literal) + ")+$"
    # Most values do not end with it, so the regular expression is rarely run.
    return F.when(c.endswith(literal), F.regexp_replace(c, pattern, "")).otherwise(c)


def event_id(alias: Column) -> Column:
    """Numeric id of an event alias, null when the alias is unknown."""
    return _event_attribute(alias, 0)


def event_name(alias: Column) -> Column:
    """Description of an event alias, null when the alias is unknown."""
    return _event_attribute(alias, 1)


def _event_attribute(alias: Column, position: int) -> Column:
    chain = None
    for key, attributes in schemas.EVENTS.items():
        value = F.lit(attributes[position])
        chain = F.when(alias == key, value) if chain is None else chain.when(alias == key, value)
    return chain
