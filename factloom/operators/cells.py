"""Tables to header records and to one row per cell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, Window

from ..functions.keys import row_key
from ..functions.numeric import parse_numeric
from ..functions.text import blank_to_null, detect_language, normalize_header, not_blank, strip
from .ordinals import block_of, spread, with_ordinal
from .tables import has_content, named_columns, pick


def guarded_tables(
    tables: DataFrame, max_tables: int | None = None, max_columns: int | None = None, min_rows: int | None = None,
    rows: Column | None = None, columns: Column | None = None, once: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Add ``guard``: ``kept``, ``beyond_table_limit``, ``too_many_columns`` or ``too_few_rows``.

    A rule applies only where its bound is given; without any, all tables are
    kept. The position inside the document counts every table found and is
    computed by blocks; it is only needed for its own rule. It reads the tables
    three times: ``once`` writes them and reads them back, so that documents are
    not read again for each.
    """
    rows = F.size("rows") if rows is None else rows
    columns = F.size("headers") if columns is None else columns
    if max_tables is None:
        ranked = tables.withColumn("_position", F.lit(0))
    else:
        tables = tables if once is None else once(tables, "found_tables")
        ranked = with_ordinal(tables, "document_id", "table_index", ["table_index", "table_id"], "_position")
    broken = lambda bound, rule: F.lit(False) if bound is None else rule
    guard = (
        F.when(broken(max_tables, F.col("_position") > max_tables), "beyond_table_limit")
        .when(broken(max_columns, columns > max_columns), "too_many_columns")
        .when(broken(min_rows, rows < min_rows), "too_few_rows")
        .otherwise("kept")
    )
    return ranked.withColumn("guard", guard).drop("_position")


def rejected_tables(guarded: DataFrame) -> DataFrame:
    """Reject records of the tables that a guard leaves out."""
    return guarded.filter("guard != 'kept'").select(
        F.lit("extracted_tables").alias("layer"), F.col("table_id").alias("record_id"), "document_id", "table_id",
        F.col("guard").alias("reason"),
    )


def header_records(tables: DataFrame) -> DataFrame:
    """One row per column of each table."""
    exploded = tables.select(
        "department_id", "document_id", "table_id",
        F.posexplode("headers").alias("column_number", "header_raw"),
    )
    return exploded.select(
        row_key(F.col("table_id"), F.col("header_raw")).alias("header_id"),
        "department_id", "document_id", "table_id", F.col("column_number").cast("long"), "header_raw",
        normalize_header(F.col("header_raw")).alias("header_normalized"),
        detect_language(F.col("header_raw")).alias("header_language"),
    )


def row_values_long(tables: DataFrame) -> DataFrame:
    """One row per cell; positions come from the arrays, so nothing is sorted or shuffled."""
    rows = tables.select(
        "department_id", "document_id", "table_id", "headers",
        F.posexplode("rows").alias("source_row_number", "_row"),
    )
    cells = rows.select(
        "department_id", "document_id", "table_id", "headers", "source_row_number",
        F.nullif(F.get("_row", F.lit(0)), F.lit("")).alias("row_label_raw"),
        F.posexplode(F.slice("_row", F.lit(1), F.size("headers"))).alias("source_column_number", "_cell"),
    )
    header = F.get("headers", F.col("source_column_number"))
    staged = cells.withColumn("value_raw", blank_to_null(F.col("_cell"))).withColumn("header_raw", header)
    return with_staging_columns(staged)


def with_staging_columns(cells: DataFrame) -> DataFrame:
    """Add ids and the numeric guess to ``(…, table_id, source_row_number, source_column_number, …)``."""
    return cells.select(
        row_key(F.col("table_id"), F.col("source_row_number"), F.col("source_column_number")).alias("staging_value_id"),
        "department_id", "document_id", "table_id",
        F.col("source_row_number").cast("long"), F.col("source_column_number").cast("long"),
        "row_label_raw",
        row_key(F.col("table_id"), F.col("header_raw")).alias("header_id"),
        "header_raw", "value_raw",
        parse_numeric(F.col("value_raw")).alias("value_numeric_guess"),
    )


# Shapes of dates and percentages, and the notes that replace a value.
DATE_PATTERN = r"^\d{4}-\d{2}(?:-\d{2})?$|^\d{1,2}/\d{1,2}/\d{4}$"
PERCENT_PATTERN = r"^[+-]?[\d,]*\.?\d+\s*%$"
NOTE_PATTERN = r"^(?i)(?:\(?(?:note|source)s?\b.*|\*+.*|\[\w{1,3}\]|\(\d{1,2}\))$"


def extracted_cells(cells: DataFrame) -> DataFrame:
    """Debug view of cells with a guessed type and a flag for footnotes."""
    value = F.col("value_raw")
    guess = (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(value.rlike(DATE_PATTERN), "date")
        .when(value.rlike(PERCENT_PATTERN), "percent")
        .when(parse_numeric(value).isNotNull(), "numeric")
        .otherwise("text")
    )
    return cells.select(
        row_key(F.col("table_id"), F.col("source_row_number"), F.col("source_column_number")).alias("cell_id"),
        "table_id", F.col("source_row_number").alias("row_number"),
        F.col("source_column_number").alias("column_number"), "header_raw", "value_raw",
        guess.alias("value_type_guess"),
        F.lit(None).cast("string").alias("unit_raw"),
        F.coalesce(value.rlike(NOTE_PATTERN), F.lit(False)).alias("note_flag"),
    )


def sheet_rows(grid_rows: DataFrame, group: str = "table_id") -> DataFrame:
    """Decoded worksheet rows to data rows under their headers.

    Input has a row per sheet row: ``(document_id, sheet_index, sheet_name,
    row_number, cells array<string>)`` plus ``department_id`` and, unless all are
    ``xlsx``, ``file_format``; row 0 is the header row. A sheet may be of any
    length: headers are spread over the blocks of its rows and rows are
    renumbered by blocks.
    """
    if "file_format" not in grid_rows.columns:
        grid_rows = grid_rows.withColumn("file_format", F.lit("xlsx"))
    keyed = grid_rows.withColumn(
        group, row_key(F.col("document_id"), F.lower("file_format"), F.col("sheet_index"), F.col("sheet_name"))
    ).withColumn("_block", block_of("row_number"))
    heads = keyed.filter("row_number = 0").select(group, F.col("cells").alias("_head"))
    heads = heads.withColumn("_named", named_columns(F.col("_head"))).filter(F.size("_named") > 0)
    body = keyed.filter("row_number > 0")
    named = F.col("_named")
    picked = body.join(spread(heads, body, group), [group, "_block"]).select(
        "department_id", "document_id", group, F.col("sheet_index").cast("long").alias("table_index"), "sheet_name",
        F.concat(F.lower("file_format"), F.lit("_parser")).alias("extraction_method"), "row_number", pick(F.col("_head"), named).alias("headers"), pick(F.col("cells"), named).alias("_row"),
    ).filter(has_content(F.col("_row")))
    return with_ordinal(picked, group, "row_number", ["row_number"], "_ordinal").select(
        "department_id", "document_id", group, "table_index", "sheet_name", "extraction_method", "headers",
        (F.col("_ordinal") - 1).alias("source_row_number"), "_row",
    )


def sheet_tables(rows: DataFrame) -> DataFrame:
    """One record per sheet that has data rows, from :func:`sheet_rows`; rows are only counted."""
    keys = ["department_id", "document_id", "table_id", "table_index", "sheet_name", "extraction_method"]
    return rows.groupBy(*keys).agg(F.any_value("headers").alias("headers"), F.count(F.lit(1)).alias("row_count"))


def sheet_row_values(grid_rows: DataFrame) -> DataFrame:
    """Decoded worksheet rows to cells, in the layout of :func:`row_values_long`."""
    return sheet_cells(sheet_rows(grid_rows))


def sheet_cells(rows: DataFrame) -> DataFrame:
    """Cells of :func:`sheet_rows`."""
    cells = rows.select(
        "department_id", "document_id", "table_id", "headers", "source_row_number",
        F.nullif(F.get("_row", F.lit(0)), F.lit("")).alias("row_label_raw"),
        F.posexplode("_row").alias("source_column_number", "_cell"),
    )
    return with_staging_columns(
        cells.withColumn("value_raw", blank_to_null(F.col("_cell")))
        .withColumn("header_raw", F.get("headers", F.col("source_column_number")))
    )


def find_column(headers: DataFrame, candidates: list[str], out: str = "column_number") -> DataFrame:
    """Per table, the column whose lowered name comes first among ``candidates``."""
    rank = F.array_position(F.array(*[F.lit(c) for c in candidates]), strip(F.lower("header_raw")))
    best = F.min(F.struct(rank.alias("rank"), F.col("column_number").alias("n")))
    return headers.filter(rank > 0).groupBy("table_id").agg(best["n"].alias(out))


def table_dimensions(cells: DataFrame) -> DataFrame:
    return cells.groupBy("table_id").agg(
        (F.max("source_row_number") + 1).alias("n_rows"), (F.max("source_column_number") + 1).alias("n_columns")
    )


def pivot_grid(cells: DataFrame, columns: list[int]) -> DataFrame:
    """Long cells back to a wide grid, for the given column numbers."""
    picks = [
        F.max(F.when(F.col("source_column_number") == c, F.col("value_raw"))).alias(f"c{c}") for c in columns
    ]
    return cells.groupBy("table_id", "source_row_number").agg(*picks)


def column_inventory(cells_or_headers: DataFrame) -> DataFrame:
    """How many documents carry each normalised column name."""
    return (
        cells_or_headers.filter(not_blank(F.col("header_raw")))
        .groupBy(normalize_header(F.col("header_raw")).alias("column_name"))
        .agg(F.countDistinct("document_id").alias("documents"), F.count(F.lit(1)).alias("occurrences"))
    )


def garbage_headers(headers: DataFrame) -> DataFrame:
    """Headers that show an extraction fault: blank, or the start of a packed file."""
    text = F.coalesce("header_raw", F.lit(""))
    return (
        headers.filter(~not_blank(F.col("header_raw")) | text.startswith("PK"))
        .groupBy(text.alias("header_raw")).agg(F.count(F.lit(1)).alias("occurrences"))
    )
