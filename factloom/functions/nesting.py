"""Tags labelled with the depth they stand at, so that a pattern can find the tag that closes another.

Labelled, ``<td>`` reads ``<td ~2>`` and ``</td>`` reads ``</td ~2>``. A pattern
that keeps the label in a group asks for it again at the end and so takes whole
elements, also those that hold others of their name. ``LABEL`` matches nothing
in text that was not labelled, so the same patterns read both.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

LABEL = r"(?: ~\d+)?+"
_CHUNK = 512

_TABLE_PIECE = r"(?is)</?table\b[^>]*+>[^<]*+(?:<(?!/?table\b)[^<]*+)*+"
_TABLE_TAG = r"(?i)<(/?(?:table|t[rhd]))\b"
_ELEMENT_PIECE = re.compile(r"<(?=[/A-Za-z_])(/?)([\w:.-]*)([^>]*)(>[^<]*(?:<[^/A-Za-z_][^<]*)*)", re.ASCII)


def _scan(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    last = lambda done: F.try_element_at(done, F.lit(-1))
    return F.aggregate(
        values, F.array().cast("array<int>"),
        lambda done, v: F.concat(done, F.array(F.when(F.size(done) > 0, combine(last(done), v)).otherwise(v))),
    )


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running results of an associative ``combine`` over an array of integers.

    Worked out in chunks of 512 values and over the chunks, as an array is copied
    for each value that is added to it.
    """
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _CHUNK).cast("int")),
        lambda c: _scan(F.slice(values, c * _CHUNK + 1, F.lit(_CHUNK)), combine),
    )

    def joined(scans: Column) -> Column:
        totals = _scan(F.transform(scans, lambda s: F.element_at(s, -1)), combine)
        before = F.concat(F.array(F.lit(None).cast("int")), F.slice(totals, F.lit(1), F.size(totals) - 1))
        return F.flatten(F.zip_with(
            scans, before, lambda scan, b: F.transform(scan, lambda v: F.when(b.isNull(), v).otherwise(combine(b, v)))
        ))

    # a list of one, so that the scans are worked out once and used twice
    once = F.element_at(F.transform(F.array(chunks), joined), 1)
    return F.when(F.size(values) > 0, once).otherwise(F.array().cast("array<int>"))


def _labelled(pieces: Column, steps: Column, label: Callable[[Column, Column, Column], Column]) -> Column:
    """The pieces joined again, each labelled by its step and the depth after it; no depth is below zero."""
    sums = running(steps, lambda a, b: a + b)

    def clamped(done: Column) -> Column:
        lowest = running(done, lambda a, b: F.least(a, b))
        return F.zip_with(done, lowest, lambda s, low: s - F.least(F.lit(0), low))

    depths = F.element_at(F.transform(F.array(sums), clamped), 1)
    placed = F.zip_with(pieces, depths, lambda p, d: F.struct(p.alias("piece"), d.alias("depth")))
    return F.array_join(F.zip_with(placed, steps, lambda p, s: label(p["piece"], s, p["depth"])), "")


def nested_tables(html: Column) -> Column:
    """HTML with the depth of their table at ``table``, ``tr``, ``th`` and ``td`` tags; text without nested tables stays.

    A closing tag without a table is passed over; tables that are not closed end with the text.
    """
    pieces = F.regexp_extract_all(html, F.lit(_TABLE_PIECE), F.lit(0))
    steps = lambda found: F.transform(found, lambda p: F.when(p.startswith("</"), -1).otherwise(1))

    def label(piece: Column, step: Column, depth: Column) -> Column:
        inside = F.regexp_replace(piece, F.lit(_TABLE_TAG), F.concat(F.lit("<$1 ~"), depth))
        tag = F.concat(F.lit("</table ~"), depth + 1, F.lit(">"))
        return F.when(step == 1, inside).when(depth == 0, tag).otherwise(
            F.concat(tag, F.regexp_replace(F.regexp_replace(piece, "^[^>]*>", ""), F.lit(_TABLE_TAG), F.concat(F.lit("<$1 ~"), depth)))
        )

    def rewritten(found: Column) -> Column:
        opens = steps(found)
        twice = F.exists(F.zip_with(opens, F.slice(opens, F.lit(2), F.size(opens)), lambda a, b: (a == 1) & (b == 1)), lambda x: x)
        return F.when(F.coalesce(twice, F.lit(False)), _labelled(found, opens, label)).otherwise(html)

    return F.element_at(F.transform(F.array(pieces), rewritten), 1)


def _shape(text: str) -> tuple[bool, bool, str | None]:
    held, within, good, nested = [], Counter(), True, False
    pieces, total, lowest = [], 0, 0
    for tag in _ELEMENT_PIECE.finditer(text):
        slash, name, rest, after = tag.groups()
        alone = rest.endswith("/") or not (name or rest)
        if not alone:
            local = name.rpartition(":")[2]
            if not slash:
                nested = nested or within[local] > 0
                held.append(name)
                within[local] += 1
            elif held and held[-1] == name:
                within[local] -= 1
                held.pop()
            else:
                good = False
        step = -1 if slash else 0 if alone else 1
        total += step
        lowest = min(lowest, total)
        level = total - lowest + (step != 1)
        pieces.append(f"<{slash}{name} ~{level}{rest}{after}" if name else f" ~{level}{tag.group()}")
    balanced = good and not held
    return balanced, nested, "".join(pieces) if balanced and nested else None


def _shapes(texts: pa.Array) -> pa.Array:
    found = [(None, None, None) if t is None else _shape(t) for t in texts.to_pylist()]
    columns = zip(*found, strict=True) if found else ((), (), ())
    kinds = (pa.bool_(), pa.bool_(), pa.string())
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["balanced", "nested", "text"])


def element_shape(text: Column) -> Column:
    """``balanced``: every element of ``plain_xml`` text, from its root on, is closed in its turn;
    ``nested``: an element stands in another of the same local name; ``text``: if both hold, with the depth at every tag.

    One scan over the tags with a list of the open ones, which functions over
    arrays would copy for every tag.
    """
    fields = T.StructType([T.StructField("balanced", T.BooleanType()), T.StructField("nested", T.BooleanType()), T.StructField("text", T.StringType())])
    return F.arrow_udf(_shapes, fields)(text)
