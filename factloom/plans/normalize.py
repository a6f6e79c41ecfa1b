"""Cells that were not normalised yet to facts, quality records and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..dictionaries import Dictionaries
from ..operators import dimensions as dims
from ..operators.candidates import decisions_by_text, header_candidates, reviewed_texts
from ..operators.quality import with_scores
from ..operators.reshape import beyond_cap, capped, observations, parted
from ..sources.warehouse import Warehouse


def pending_tables(tables: DataFrame, documents: DataFrame, facts: DataFrame, department: str | None = None) -> DataFrame:
    """Tables of known documents without any observation; a table of one department is no other's."""
    own = documents.select("document_id", F.col("department_id").alias("department_id"))
    if department is not None:
        own = own.filter(F.col("department_id") == department)
    on = [c for c in ("document_id", "department_id") if c in tables.columns]
    return (
        tables.select("table_id", *on).join(own, on)
        .join(facts.select("table_id").distinct(), "table_id", "left_anti")
        .select("table_id", "document_id", "department_id").distinct()
    )


def table_yield(tables: DataFrame, facts: DataFrame) -> DataFrame:
    """Tables and tables with observations per department."""
    filled = facts.groupBy("table_id").agg(F.count(F.lit(1)).alias("_n"))
    return (
        tables.select("table_id", "department_id").distinct().join(filled, "table_id", "left")
        .groupBy("department_id").agg(
            F.count(F.lit(1)).alias("tables"), F.count("_n").alias("tables_with_observations"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("observations"),
        )
        .withColumn("share", F.round(F.col("tables_with_observations") / F.col("tables"), 6))
    )


DIMENSIONS = {"time_id": "dim_time", "metric_id": "dim_metric", "geography_id": "dim_geography", "scenario_id": "dim_scenario"}


def normalize(
    warehouse: Warehouse, dictionaries: Dictionaries, batch: str, department: str | None = None,
    limit: int | None = None, max_tables: int | None = None, rules: DataFrame | None = None,
    reviews: DataFrame | None = None, only_batch: bool = False,
) -> DataFrame:
    """Make facts of pending tables, score them, keep the dimensions; returns statistics.

    ``max_tables`` bounds the batch; ``limit`` bounds the observations of a
    table, and those beyond it are recorded as rejects. A table that cannot be
    read is recorded there with its reason and does not hold up the others.
    ``rules`` (as for ``scoped_candidates``) and ``reviews`` (decisions on
    headers, as for ``apply_reviews``) come before the dictionaries. With
    ``only_batch`` just the tables that this batch extracted are looked at.
    """
    own = batch if only_batch else None
    tables = warehouse.read("extracted_tables", batch=own)
    documents = warehouse.read("raw_documents", batch=own)
    known = warehouse.read("fact_observation", but_batch=batch)
    tried = warehouse.read("document_status", but_batch=f"{batch}.normalize").filter("stage = 'normalize'").select("document_id", "department_id")
    if only_batch:
        known, tried = known.limit(0), tried.limit(0)  # what this batch extracted, no other has normalised
    pending = pending_tables(tables, documents, known, department).join(tried, ["document_id", "department_id"], "left_anti")
    if max_tables is not None:
        pending = pending.orderBy("document_id", "table_id").limit(max_tables)
    pending = warehouse.staged(pending, "pending", batch)
    if pending.isEmpty() and warehouse.read("document_status", batch=f"{batch}.normalize").isEmpty():
        return table_yield(pending, known.limit(0)).withColumn("tables_failed", F.lit(0).cast("long"))
    cells = warehouse.read("row_values_long", batch=own).join(pending.select("table_id"), "table_id", "left_semi")
    headers = warehouse.read("headers", batch=own).join(pending.select("table_id"), "table_id", "left_semi")
    if rules is not None or reviews is not None:
        dictionaries = decided(warehouse, dictionaries, rules, reviews, batch)
        kinds = documents.groupBy("document_id").agg(F.min("document_type").alias("document_type"))
        cells, headers = (df.join(kinds, "document_id", "left") for df in (cells, headers))
    found = warehouse.staged(observations(cells, dictionaries, headers, errors=True), "observations", batch)
    once = lambda df, name: warehouse.staged(df, name, batch)
    good, bad = parted(found, once)
    facts = with_scores(capped(good, limit), F.col("mapping_confidence"))
    facts = facts if limit is None else warehouse.staged(facts, "facts", batch)
    rejected = bad.select(
        F.lit("fact_observation").alias("layer"), F.col("table_id").alias("record_id"), "document_id", "table_id", F.col("error").alias("reason")
    )
    warehouse.append("rejects", rejected if limit is None else rejected.unionByName(beyond_cap(good, limit)), f"{batch}.normalize")
    warehouse.append("observation_quality", facts, batch)
    warehouse.append(
        "fact_observation", facts.withColumn("quality_score", F.col("quality_confidence")), batch
    )
    warehouse.append("mapping_candidates", header_candidates(headers, dictionaries, once), batch)

    for key, rows in dims.resolved_dimensions(good, dictionaries, once).items():
        warehouse.merge(DIMENSIONS[key], rows, batch)
    warehouse.merge("dim_document", dims.build_dim_document(documents, warehouse.read("fact_observation", batch=batch)), batch)
    bridge, values = dims.attribute_bridge(cells, facts)
    warehouse.append("bridge_observation_attribute", bridge, batch)
    warehouse.merge("dim_attribute_value", values, batch)

    own_document = ["document_id", "department_id"]
    failed = bad.select(*own_document).distinct().withColumn("_failed", F.lit(True))
    status = pending.select(*own_document).distinct().join(failed, own_document, "left").select(
        *own_document, F.lit("normalize").alias("stage"), F.when(F.col("_failed"), "with_errors").otherwise("normalized").alias("status")
    )
    warehouse.append("document_status", status, f"{batch}.normalize")
    lost = bad.groupBy("department_id").agg(F.count(F.lit(1)).alias("tables_failed"))
    return table_yield(pending, facts).join(lost, "department_id", "left").fillna(0, ["tables_failed"])


def decided(warehouse: Warehouse, dictionaries: Dictionaries, rules: DataFrame | None, reviews: DataFrame | None, batch: str) -> Dictionaries:
    """``dictionaries`` with what rules, and reviews of stored candidates, decide by text; written once."""
    if reviews is not None:
        reviews = reviewed_texts(warehouse.read("mapping_candidates"), warehouse.read("headers"), reviews)
    return dictionaries.with_decisions(warehouse.staged(decisions_by_text(rules, reviews), "decided", batch))


def seed(warehouse: Warehouse, dictionaries: Dictionaries) -> None:
    """Store the dimension rows of the dictionaries."""
    for layer, rows in dims.seed_dimensions(dictionaries).items():
        warehouse.merge(layer, rows, "seed")
