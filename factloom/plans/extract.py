"""Documents that were not read yet to tables, header records and cells."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import row_key
from ..operators.cells import guarded_tables, header_records, rejected_tables, row_values_long, sheet_cells, sheet_rows, sheet_tables
from ..operators.large_csv import csv_file_rows, csv_lines, csv_records
from ..operators.tables import csv_tables, html_tables
from ..operators.xml import xml_tables
from ..sources.files import decode_text, is_binary
from ..sources.warehouse import Warehouse

READERS = {"csv": csv_tables, "html": html_tables, "xml": xml_tables}


def pending_documents(documents: DataFrame, done: DataFrame, department: str | None = None, limit: int | None = None) -> DataFrame:
    """Documents taken in with success and not worked on yet, optionally a bounded batch in id order.

    With a department in ``done``, each department's own record of a document counts.
    """
    pending = documents.filter("ingestion_status = 'success'")
    if department is not None:
        pending = pending.filter(F.col("department_id") == department)
    own = [c for c in ("document_id", "department_id") if c in done.columns]
    pending = pending.join(done.select(*own).distinct(), own, "left_anti")
    return pending if limit is None else pending.orderBy("document_id").limit(limit)


def route(documents: DataFrame) -> DataFrame:
    """Add ``reader``: the reader of a document, ``binary`` or ``unsupported``."""
    fmt = F.lower("file_format")
    return documents.withColumn(
        "reader",
        F.when(is_binary(F.col("content"), F.col("file_format")), "binary")
        .when(fmt.isin(list(READERS)), fmt)
        .when(fmt.isin("xlsx", "xls"), "sheet")
        .otherwise("unsupported"),
    )


def extract_tables(documents: DataFrame) -> DataFrame:
    """``documents(department_id, document_id, title, file_format, content)`` to tables of all text formats.

    The format test comes first in each branch, so on storage partitioned by
    format every branch reads its own files only.
    """
    branches = []
    for reader, read in READERS.items():
        own = documents.filter(F.lower("file_format") == reader).filter(~is_binary(F.col("content"), F.col("file_format")))
        branches.append(read(own.select(
            "department_id", "document_id", F.coalesce("title", F.lit("")).alias("title"),
            decode_text(F.col("content")).alias("text"),
        )))
    return reduce(DataFrame.unionByName, branches)


def _sizes(headers: Column, cells: Column) -> list[Column]:
    return [headers.alias("_headers"), cells.cast("long").alias("_cells")]


def _per_document(every: DataFrame) -> DataFrame:
    """Tables kept and skipped, headers and cells of each document in each department."""
    own = lambda c: F.sum(F.when(F.col("guard") == "kept", F.col(c)).otherwise(0)).alias(c)
    return every.groupBy("document_id", "department_id").agg(
        F.count_if(F.col("guard") == "kept").alias("kept"), F.count_if(F.col("guard") != "kept").alias("skipped"),
        own("_headers"), own("_cells"),
    )


def _per_department(documents: DataFrame, per_document: DataFrame) -> DataFrame:
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    return documents.select("document_id", "department_id").join(per_document, ["document_id", "department_id"], "left").groupBy("department_id").agg(
        F.count(F.lit(1)).alias("documents"), total("kept", "tables_kept"), total("skipped", "tables_skipped"),
        total("_headers", "headers"), total("_cells", "cells"),
    )


def extract_stats(documents: DataFrame, guarded: DataFrame) -> DataFrame:
    """Documents, tables kept and skipped, headers and cells per department."""
    cells = F.aggregate("rows", F.lit(0).cast("long"), lambda n, r: n + F.least(F.size(r), F.size("headers")))
    return _per_department(documents, _per_document(guarded.select("document_id", "department_id", "guard", *_sizes(F.size("headers"), cells))))


def with_owners(pending: DataFrame, done: DataFrame) -> DataFrame:
    """One row for each document, its ``department_id`` an array of all departments that wait for it.

    Columns are those of the first department's record. ``again`` marks the
    departments that do not keep the plain ids of tables, as these belong to the
    first department, or to one that was served before.
    """
    taken = done.select("document_id").distinct().withColumn("_taken", F.lit(True))
    rest = [c for c in pending.columns if c != "document_id"]
    folded = pending.groupBy("document_id").agg(
        F.min_by(F.struct(*rest), "department_id").alias("d"), F.array_sort(F.collect_set("department_id")).alias("_departments")
    ).join(taken, "document_id", "left")
    again = lambda d: F.coalesce("_taken", F.lit(False)) | (d != F.col("d.department_id"))
    return folded.select(
        "document_id", *[F.col(f"d.{c}") for c in rest if c != "department_id"], F.col("d.department_id").alias("read_for"),
        F.transform("_departments", lambda d: F.struct(d.alias("department_id"), again(d).alias("again"))).alias("department_id"),
    )


def served_before(warehouse: Warehouse, done: DataFrame, batch: str) -> DataFrame:
    """``done`` without the documents whose plain table ids are this batch's own, from an earlier try.

    Another batch that came later has ids made of these and its department.
    """
    own = warehouse.read("extracted_tables", batch=batch).select("document_id", "table_index", F.col("table_id").alias("_own"))
    if own.isEmpty():
        return done
    other = warehouse.read("extracted_tables", but_batch=batch).select("document_id", "table_index", "table_id", "department_id")
    mine = own.join(other, ["document_id", "table_index"]).filter(F.col("table_id") == row_key(F.col("_own"), F.col("department_id")))
    return done.join(warehouse.staged(mine.select("document_id").distinct(), "plain", batch), "document_id", "left_anti")


def for_owners(tables: DataFrame) -> DataFrame:
    """Tables, or their rows, of ``with_owners`` for each department; ids are told apart by the department."""
    return tables.withColumn("_owner", F.explode("department_id")).withColumns({
        "department_id": F.col("_owner.department_id"),
        "table_id": F.when(F.col("_owner.again"), row_key(F.col("table_id"), F.col("_owner.department_id"))).otherwise(F.col("table_id")),
    }).drop("_owner")


AWAITING_GRID = "awaiting_grid"
#: What is derived from a document, in the order in which it is made.
DERIVED = [
    "extracted_tables", "headers", "row_values_long", "rejects", "fact_observation", "observation_quality",
    "bridge_observation_attribute", "mapping_candidates", "document_status",
]


def extract(
    warehouse: Warehouse, contents: DataFrame, batch: str, department: str | None = None, grids: DataFrame | None = None,
    limit: int | None = None, max_tables: int | None = None, max_columns: int | None = None, min_rows: int | None = None,
    only_batch: bool = False, large_files: tuple[str, DataFrame] | None = None,
) -> DataFrame:
    """Read pending documents and store tables, headers and cells; returns statistics.

    ``contents(document_id, content)`` holds the bytes of the stored documents,
    ``grids(document_id, sheet_index, sheet_name, row_number, cells)`` the decoded
    rows of workbooks; a workbook without its grid stays pending. Tables are left
    out only where a bound is given, and are then recorded as rejects.
    ``large_files`` is a folder of CSV files with ``files(uri, document_id)``;
    these need no row in ``contents`` and are read by many tasks each. A document
    that several departments hold is read once, and each of them gets its tables;
    ``contents`` has one row for it, or one for each ``department_id``. With
    ``only_batch`` just the documents that this batch took in are looked at.
    """
    known = warehouse.read("raw_documents", batch=batch if only_batch else None)
    done = warehouse.read("document_status", but_batch=batch).filter((F.col("stage") == "extract") & (F.col("status") != AWAITING_GRID))
    pending = pending_documents(known, done, department, limit)
    shared = with_owners(pending, served_before(warehouse, done, batch))
    on = ["document_id"]
    if "department_id" in contents.columns:
        contents, on = contents.withColumnRenamed("department_id", "read_for"), ["document_id", "read_for"]
    once = lambda df, name: warehouse.staged(df, name, batch)
    # every reader and the status look at the documents, so they are brought together with their contents once
    documents = once(route(shared.join(contents.select(*on, "content"), on)), "documents")
    bounds = {"max_tables": max_tables, "max_columns": max_columns, "min_rows": min_rows}
    guarded = for_owners(warehouse.staged(guarded_tables(extract_tables(documents), **bounds, once=once), "tables", batch))
    kept = guarded.filter("guard = 'kept'")
    tables, headers, cells, rejected = kept, header_records(kept), row_values_long(kept), rejected_tables(guarded)
    every = guarded.select("document_id", "department_id", "guard", *_sizes(F.size("headers"), F.aggregate(
        "rows", F.lit(0).cast("long"), lambda n, r: n + F.least(F.size(r), F.size("headers"))
    )))
    seen = None

    def add_rows(rows: DataFrame, name: str) -> None:
        nonlocal tables, headers, cells, rejected, every
        rows = for_owners(rows)
        sheets = warehouse.staged(
            guarded_tables(sheet_tables(rows), **bounds, rows=F.col("row_count"), columns=F.size("headers")), name, batch
        )
        good = sheets.filter("guard = 'kept'")
        tables = tables.unionByName(good, allowMissingColumns=True)
        headers = headers.unionByName(header_records(good))
        cells = cells.unionByName(sheet_cells(rows.join(good.select("table_id"), "table_id", "left_semi")), allowMissingColumns=True)
        rejected = rejected.unionByName(rejected_tables(sheets))
        every = every.unionByName(sheets.select("document_id", "department_id", "guard", *_sizes(F.size("headers"), F.col("row_count") * F.size("headers"))))

    if large_files is not None:
        path, named = large_files
        # one address for a document: copies of a file are read once
        named = named.groupBy("document_id").agg(F.min("uri").alias("uri"))
        unread = shared.join(contents.select("document_id"), "document_id", "left_anti").filter(F.lower("file_format") == "csv")
        large = warehouse.staged(unread.select("document_id", "department_id").join(named, "document_id"), "large_files", batch)
        records = csv_records(csv_lines(warehouse.spark, path).join(large.select("uri"), "uri", "left_semi"), once)
        add_rows(once(csv_file_rows(records, large, once), "csv_rows"), "large_tables")
        documents = documents.select("document_id", "department_id", "file_format", "reader").unionByName(
            large.select("document_id", "department_id", F.lit("csv").alias("file_format"), F.lit("csv").alias("reader"))
        )
    if grids is not None:
        workbooks = documents.filter("reader = 'sheet'").select("document_id", "department_id", "file_format")
        own = grids.join(workbooks, "document_id")
        rows = warehouse.staged(sheet_rows(own), "sheet_rows", batch)
        add_rows(rows, "sheets")
        seen = own.select("document_id").distinct().withColumn("_grid", F.lit(True))
    warehouse.append("extracted_tables", tables, batch)
    warehouse.append("headers", headers, batch)
    warehouse.append("row_values_long", cells, batch)
    warehouse.append("rejects", rejected, batch)
    per_document = _per_document(every)
    owners = documents.select("document_id", "reader", F.explode("department_id").alias("_owner")).select("document_id", "reader", "_owner.department_id")
    status = owners.join(per_document, ["document_id", "department_id"], "left")
    status = status.withColumn("_grid", F.lit(None).cast("boolean")) if seen is None else status.join(seen, "document_id", "left")
    warehouse.append("document_status", status.select(
        "document_id", "department_id", F.lit("extract").alias("stage"),
        F.when(F.col("reader") == "binary", "binary_content")
        .when(F.col("reader") == "unsupported", "unsupported_format")
        .when((F.col("reader") == "sheet") & F.col("_grid").isNull(), AWAITING_GRID)
        .when(F.col("kept") > 0, "extracted").otherwise("no_tables").alias("status"),
        F.coalesce("kept", F.lit(0)).alias("tables_kept"), F.coalesce("skipped", F.lit(0)).alias("tables_skipped"),
    ), batch)
    return _per_department(pending, per_document)


def chosen_documents(warehouse: Warehouse, department: str | None = None) -> DataFrame:
    """Ids of all stored documents, or of those of one department."""
    stored = warehouse.read("raw_documents")
    return (stored if department is None else stored.filter(F.col("department_id") == department)).select("document_id").distinct()


def reprocess(warehouse: Warehouse, contents: DataFrame, documents: DataFrame, batch: str, grids: DataFrame | None = None) -> DataFrame:
    """Forget what was made from ``documents(document_id)`` and read them again.

    Every derived layer is cleared, those without a document column through the
    observations and headers that they belong to; batches without such rows are
    not touched.
    """
    ids = warehouse.staged(documents.select("document_id").distinct(), "forgotten", batch)
    facts = warehouse.read("fact_observation").join(ids, "document_id", "left_semi")
    heads = warehouse.read("headers").join(ids, "document_id", "left_semi")
    keys = {
        "observation_quality": warehouse.staged(facts.select("observation_id").distinct(), "forgotten_facts", batch),
        "mapping_candidates": warehouse.staged(heads.select("header_id").distinct(), "forgotten_headers", batch),
    }
    keys["bridge_observation_attribute"] = keys["observation_quality"]
    for layer in DERIVED:
        warehouse.forget(layer, keys.get(layer, ids), batch)
    return extract(warehouse, contents, batch, grids=grids)
