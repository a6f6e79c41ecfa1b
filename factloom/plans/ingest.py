"""Landed catalogue resources to document records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.catalogue import document_records, ingest_counts, with_eligibility
from ..sources.warehouse import Warehouse


def ingest(warehouse: Warehouse, landed: DataFrame, batch: str, incremental: bool = True) -> DataFrame:
    """Judge landed resources, store the new documents, and return the counts per department.

    ``landed`` has the columns of a resource plus ``department_id`` and
    ``content``. Equal address and equal content give one document in a
    department; of equal records the one with the least file address stays.
    """
    stored = warehouse.read("raw_documents", but_batch=batch)
    judged = with_eligibility(landed, stored if incremental else None)
    key = ["department_id", "document_id"]
    records = document_records(judged)
    fields = F.struct("gcs_uri", *[c for c in records.columns if c not in (*key, "gcs_uri")])
    one = records.groupBy(*key).agg(F.min(fields).alias("r")).select(*key, "r.*")
    fresh = one.join(stored.select(*key), key, "left_anti")
    warehouse.append("raw_documents", fresh, batch)
    return ingest_counts(judged)
