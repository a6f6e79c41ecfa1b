"""Incremental ingest, extraction and fact maintenance with Structured Streaming.

A trigger works through what is new and stops. Deduplication against everything
seen so far is an anti-join with the stored layer, not stream state, so nothing
grows without bound. A micro-batch is named by its query's own id, which the
checkpoint keeps, and its number: two streams into one store never share a
name, and a batch that is repeated after a failure writes its own partitions
anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from ..dictionaries import Dictionaries
from ..plans.extract import extract
from ..plans.ingest import ingest
from ..plans.normalize import normalize
from ..sources.catalogue import source_address
from ..sources.warehouse import Warehouse

#: The local property in which Spark tells a micro-batch the id of its query.
QUERY_ID = "sql.streaming.queryId"


def landed_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """Landed resources (parquet) as a stream of files."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def file_stream(spark: SparkSession, path: str) -> DataFrame:
    """Raw files as a stream of ``(path, modificationTime, length, content)``."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.schema(schema).format("binaryFile").option("recursiveFileLookup", "true").load(path)


def for_each_batch(stream: DataFrame, work: Callable[[DataFrame, str], None], checkpoint: str) -> StreamingQuery:
    """Run ``work(batch, batch_name)`` on everything new, then stop."""
    def run(df: DataFrame, number: int) -> None:
        query = df.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        if query is None:
            raise RuntimeError(f"{QUERY_ID} is not set: a batch could not be told from those of other streams")
        work(df, f"{query}-{number:08d}")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_stream(warehouse: Warehouse, stream: DataFrame, checkpoint: str) -> StreamingQuery:
    """Document records for every new landed resource; known addresses and contents are left out."""
    return for_each_batch(stream, lambda df, batch: ingest(warehouse, df, batch), checkpoint)


def fact_batch(warehouse: Warehouse, dictionaries: Dictionaries, landed: DataFrame, batch: str, **bounds) -> None:
    """One micro-batch of landed resources through ingest, extraction and normalisation.

    Only the batch's own partitions are read, beside the known addresses, and
    only buckets of dimensions with a new row are written. The commit comes
    last: a batch that is repeated before it does its work anew into the same
    partitions, one that is repeated after it does nothing.
    """
    if warehouse.committed(batch):
        return
    ingest(warehouse, landed, batch)
    contents = landed.select("department_id", source_address().alias("source_url"), "content").filter("content is not null")
    held = warehouse.read("raw_documents", batch=batch).select("document_id", "department_id", "source_url", "checksum")
    own = held.join(contents, ["department_id", "source_url"]).filter(F.sha2("content", 256) == F.col("checksum"))
    extract(warehouse, own.groupBy("document_id").agg(F.any_value("content").alias("content")), batch, only_batch=True)
    normalize(warehouse, dictionaries, batch, only_batch=True, **bounds)
    warehouse.commit(batch)


def facts_stream(warehouse: Warehouse, dictionaries: Dictionaries, stream: DataFrame, checkpoint: str, **bounds) -> StreamingQuery:
    """Documents, tables, facts and dimensions for every new landed resource, one commit per micro-batch."""
    return for_each_batch(stream, lambda df, batch: fact_batch(warehouse, dictionaries, df, batch, **bounds), checkpoint)
