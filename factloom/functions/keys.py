"""Deterministic identifiers: prefixes of SHA-256 over ``|``-joined parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip

ROW_KEY_LENGTH = 32
ENTITY_KEY_LENGTH = 24


def _text(part: Column | str) -> Column:
    if isinstance(part, str):
        return F.lit(part)
    return F.coalesce(part.cast("string"), F.lit(""))


def row_key(*parts: Column | str) -> Column:
    """Id of a document, table, header, cell or observation. Plain strings are literals."""
    joined = F.concat_ws("|", *[_text(p) for p in parts])
    return F.substring(F.sha2(joined, 256), 1, ROW_KEY_LENGTH)


def entity_key(kind: str, value: Column | str) -> Column:
    """Id of a dimension entity; NULL for a NULL value."""
    value = F.lit(value) if isinstance(value, str) else value
    joined = F.concat(F.lit(kind + "|"), strip(F.lower(value)))
    return F.substring(F.sha2(joined, 256), 1, ENTITY_KEY_LENGTH)


def checksum(content: Column) -> Column:
    return F.sha2(content, 256)


def document_id(source_url: Column, content_checksum: Column) -> Column:
    return row_key(source_url, content_checksum)
