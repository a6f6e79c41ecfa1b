"""Documents in, rectangular tables out.

A table is one row with ``headers array<string>`` and
``rows array<array<string>>``. Everything here works inside the row of its
document, with array functions only, so no reader shuffles; the size of a
document is bounded by the ingest size limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import row_key
from ..functions.markup import HTML_NAMES, references
from ..functions.nesting import LABEL, nested_tables
from ..functions.text import WS, not_blank, strip

TABLE_FIELDS = [
    "department_id", "document_id", "table_id", "table_index", "extraction_method",
    "table_title_raw", "sheet_name", "headers", "rows",
]

# A CSV field: quoted when it starts with a quote, else anything up to a comma or line end.
# Possessive quantifiers keep the matching iterative, whatever the field length.
_FIELD = r'(?:"(?:[^"]++|"")*+"?+)?+[^,\r\n]*+'
CSV_RECORD = rf"(?:{_FIELD},)*+{_FIELD}(?:\r\n|\r|\n|\z)"
CSV_FIELD = rf"({_FIELD}),"
OPEN_QUOTE = r'^(?:(?:"(?:[^"]++|"")*+"(?!"))?+[^,"\r\n][^,\r\n]*+,|(?:"(?:[^"]++|"")*+"(?!"))?+,)*+"(?:[^"]++|"")*+\z'


def _unquote(field: Column) -> Column:
    quoted = F.regexp_extract(field, r'(?s)^"((?:[^"]++|"")*+)"?', 1)
    tail = F.regexp_extract(field, r'(?s)^"(?:[^"]++|"")*+"?(.*)$', 1)
    return F.when(
        field.startswith('"'), F.concat(F.replace(quoted, F.lit('""'), F.lit('"')), tail)
    ).otherwise(field)


def csv_grid(text: Column) -> Column:
    """All records of a CSV text as ``array<array<string>>``, first record included."""
    records = F.regexp_extract_all(text, F.lit(CSV_RECORD), F.lit(0))
    records = F.filter(records, lambda r: r != "")

    def fields(record: Column) -> Column:
        closed = F.when(record.contains('"') & record.rlike(OPEN_QUOTE), F.concat(record, F.lit('"'))).otherwise(
            F.regexp_replace(record, r"(?:\r\n|\r|\n)\z", "")
        )
        found = F.regexp_extract_all(F.concat(closed, F.lit(",")), F.lit(CSV_FIELD), F.lit(1))
        return F.transform(found, _unquote)

    return F.transform(records, fields)


def named_columns(headers: Column) -> Column:
    """Positions of the headers that are not blank."""
    positions = F.transform(headers, lambda h, i: F.when(not_blank(h), i))
    return F.array_compact(positions)


def pick(values: Column, positions: Column) -> Column:
    """Values at the given positions; NULL beyond the end."""
    return F.transform(positions, lambda i: F.get(values, i))


def has_content(row: Column) -> Column:
    return F.exists(row, not_blank)


def _fit(row: Column, width: Column) -> Column:
    """Cut a long row, pad a short one with NULL."""
    return F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.get(row, i))


def rectangularise(grids: DataFrame, style: str) -> DataFrame:
    """Turn ``grid`` into ``headers`` and ``rows`` and drop the documents that give no table.

    ``style`` names the order of the rules. ``csv``: drop unnamed columns, drop
    blank rows, cut or pad to the header. ``html``: drop blank rows, pad to the
    widest row, drop unnamed columns. ``sheet``: drop unnamed columns, drop
    blank rows.
    """
    kept = [c for c in grids.columns if c != "grid"]
    staged = (
        grids.select(*kept, F.element_at("grid", 1).alias("_head"), F.slice("grid", 2, F.size("grid")).alias("_body"))
        .withColumn("_named", named_columns(F.col("_head")))
    )
    head, body, named = F.col("_head"), F.col("_body"), F.col("_named")
    if style == "html":
        rows = F.transform(F.filter(body, has_content), lambda r: pick(r, named))
    else:
        all_named = F.size(named) == F.size(head)
        picked = F.when(all_named, body).otherwise(F.transform(body, lambda r: pick(r, named)))
        rows = F.filter(picked, has_content)
        if style == "csv":
            rows = F.transform(rows, lambda r: _fit(r, F.size(named)))
    tables = staged.select(
        *kept, F.when(F.size(named) > 0, pick(head, named)).alias("_headers"), F.when(F.size(named) > 0, rows).alias("_rows")
    )
    # Empty tables are dropped by the generator: a filter would be pushed below
    # the projections and read every document a second time.
    table = F.array(F.struct(F.col("_headers").alias("headers"), F.col("_rows").alias("rows")))
    return tables.select(*kept, F.inline(F.when(F.size("_rows") > 0, table)))


def csv_tables(documents: DataFrame, offset: int = 0) -> DataFrame:
    """``documents(department_id, document_id, title, text)`` to at most one table per document."""
    grids = documents.filter(not_blank(F.col("text"))).select(
        "department_id", "document_id", F.nullif("title", F.lit("")).alias("table_title_raw"), "text"
    ).withColumn("grid", csv_grid(F.col("text"))).drop("text")
    return rectangularise(grids, "csv").select(
        "department_id", "document_id",
        row_key(F.col("document_id"), "csv", F.lit(offset)).alias("table_id"),
        F.lit(offset).cast("long").alias("table_index"),
        F.lit("csv_parser").alias("extraction_method"),
        "table_title_raw", F.lit(None).cast("string").alias("sheet_name"), "headers", "rows",
    )


HTML_DROPPED = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# Looking ahead, a pattern finds elements inside elements too; see functions.nesting for the label.
# The tags that end an element are looked for at "<" only; where none comes, it goes on to the end of the text.
_UNTIL = r"[^<]*+(?:<(?!{})[^<]*+)*+"
HTML_TABLE = rf"(?i)<(?=table({LABEL})\b([^>]*+>{_UNTIL.format(r'/table\1\b')}))"
HTML_ROW = rf"(?i)<(?=tr({LABEL})\b[^>]*+>({_UNTIL.format(r'/?tr\1\b|/table\1\b')}))"
HTML_CELL = rf"(?i)<(?=t[hd]({LABEL})\b[^>]*+>({_UNTIL.format(r'/?t(?:[hd]|r)\1\b|/table\1\b')}))"


def markup_texts(fragments: Column) -> Column:
    """Text of each fragment: every text node stripped, then joined without separator.

    One step after the other over the whole array, as a text would be made again for each use of it.
    """
    spaced = F.transform(fragments, lambda m: F.when(m.contains("&"), F.regexp_replace(m, r"&nbsp;|&#160;|&#[xX][aA]0;", " ")).otherwise(m))
    bare = F.transform(spaced, lambda m: strip(F.when(m.contains("<"), F.regexp_replace(m, f"{WS}*+<[^>]*>{WS}*+", "")).otherwise(m)))
    return F.transform(bare, lambda m: references(m, HTML_NAMES))


def html_tables(documents: DataFrame) -> DataFrame:
    """One table per ``<table>`` element; ``table_index`` counts all of them, kept or not, in the order of their first tags.

    A table inside another is a table of its own, and its rows and cells count in
    the outer one too: a row there has the cells of all tables that it holds.
    """
    clean = nested_tables(F.regexp_replace("text", HTML_DROPPED, ""))
    tables = documents.select(
        "department_id", "document_id", F.nullif("title", F.lit("")).alias("table_title_raw"),
        F.posexplode(F.regexp_extract_all(clean, F.lit(HTML_TABLE), F.lit(2))).alias("table_index", "markup"),
    )
    rows = F.regexp_extract_all(F.col("markup"), F.lit(HTML_ROW), F.lit(2))
    cells = lambda row: markup_texts(F.regexp_extract_all(row, F.lit(HTML_CELL), F.lit(2)))
    grids = tables.select(
        "department_id", "document_id", "table_title_raw", F.col("table_index").cast("long"),
        F.transform(rows, cells).alias("grid"),
    )
    return rectangularise(grids, "html").select(
        "department_id", "document_id",
        row_key(F.col("document_id"), "html", F.col("table_index")).alias("table_id"),
        "table_index", F.lit("html_parser").alias("extraction_method"),
        "table_title_raw", F.lit(None).cast("string").alias("sheet_name"), "headers", "rows",
    )
