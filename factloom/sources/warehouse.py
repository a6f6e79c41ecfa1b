"""The layers as parquet below one root, partitioned so that a repeated job changes nothing.

Appended layers are partitioned by ``batch_id``: a batch that runs again writes
its own partition anew and touches no other. Dimensions are partitioned by
``bucket``, a hash of the key: a merge writes anew just the buckets in which a
row changes. Replacing partitions is Spark's own dynamic partition overwrite;
what is written anew from a layer's own rows is staged first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.dimensions import changed_rows, one_per_key, upsert
from ..schemas import LAYERS

#: Partitions of a dimension; a merge reads and writes those it has to.
BUCKETS = 16


def conform(df: DataFrame, layer: str) -> DataFrame:
    """Bring a DataFrame to the layout of a layer: order, types, defaults for absent columns."""
    spec = LAYERS[layer]
    columns = []
    for field in T.StructType.fromDDL(spec.ddl):
        if field.name in df.columns:
            value = F.col(field.name)
            if field.name in spec.defaults:
                value = F.coalesce(value, F.expr(spec.defaults[field.name]))
        else:
            value = F.expr(spec.defaults.get(field.name, "NULL"))
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def ndjson(df: DataFrame, out: str = "line") -> DataFrame:
    """Rows as JSON text, one object per row."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(out))


def create_tables(spark: SparkSession, database: str) -> None:
    """Declare every layer as a catalogue table, if absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, spec in LAYERS.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromDDL(spec.ddl))
        partition = f" PARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{partition}")


def table_exists(spark: SparkSession, database: str, name: str) -> bool:
    return spark.catalog.tableExists(f"{database}.{name}")


def run_sql(spark: SparkSession, text: str, **params: str) -> DataFrame:
    """A query with named parameters, all bound as strings."""
    return spark.sql(text, args={k: str(v) for k, v in params.items()})


def bucket_of(key: str, buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass
class Warehouse:
    spark: SparkSession
    root: str

    def _path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def _stored(self, layer: str, partition: str, kind: T.DataType = T.StringType()) -> DataFrame | None:
        """All rows of a layer with the column of its partition; null if it was never written."""
        schema = T.StructType.fromDDL(LAYERS[layer].ddl).add(partition, kind)
        try:
            return self.spark.read.schema(schema).parquet(self._path(layer))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def exists(self, layer: str) -> bool:
        return self._stored(layer, "batch_id") is not None

    def read(self, layer: str, but_batch: str | None = None, batch: str | None = None) -> DataFrame:
        """A layer; an absent one is empty.

        ``but_batch`` leaves out what that batch wrote, ``batch`` reads nothing
        else; both choose partitions, not rows.
        """
        schema = T.StructType.fromDDL(LAYERS[layer].ddl)
        df = self._stored(layer, "batch_id")
        if df is None:
            return self.spark.createDataFrame([], schema)
        if but_batch is not None:
            df = df.filter(F.col("batch_id") != but_batch)
        if batch is not None:
            df = df.filter(F.col("batch_id") == batch)
        return df.select(schema.fieldNames())

    def _sorted(self, df: DataFrame, layer: str, *first: str) -> DataFrame:
        spec = LAYERS[layer]
        order = [*first, *spec.partition_by, *spec.sort_by]
        return df.sortWithinPartitions(*order) if order else df

    def staged(self, df: DataFrame, name: str, batch: str) -> DataFrame:
        """``df`` written once below the root and read back, for a job that uses it several times."""
        path = self._path("_work", batch, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def append(self, layer: str, df: DataFrame, batch: str) -> None:
        """Write a batch; its partition is replaced as a whole, also by no rows."""
        rows = self._sorted(conform(df, layer), layer)
        rows.write.mode("overwrite").parquet(self._path(layer, f"batch_id={batch}"))

    def _overwrite(self, layer: str, rows: DataFrame, partition: str) -> None:
        """Replace the partitions that ``rows`` have, in one write."""
        self._sorted(rows, layer, partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(self._path(layer))

    def merge(self, layer: str, incoming: DataFrame, batch: str) -> None:
        """Bring rows into a dimension by its key; see ``upsert``.

        Both sides count once for a key, so the result is a function of the key
        whatever a layer or a batch repeats. Buckets without a changed row are
        not written; with none, nothing is.
        """
        (key,) = LAYERS[layer].key
        brought = [F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(LAYERS[layer].ddl) if f.name in incoming.columns]
        fresh = self.staged(one_per_key(incoming.select(*brought), key).withColumn("bucket", bucket_of(key)), f"{layer}_incoming", batch)
        if fresh.isEmpty():
            return
        stored = self._stored(layer, "bucket", T.IntegerType())
        if stored is None:
            self._overwrite(layer, conform(fresh, layer).withColumn("bucket", bucket_of(key)), "bucket")
            return
        touched = changed_rows(stored.drop("bucket"), fresh.drop("bucket"), key).select(bucket_of(key).alias("bucket")).distinct()
        touched = self.staged(touched, f"{layer}_buckets", batch)  # a number for a bucket, BUCKETS rows at most
        if touched.isEmpty():
            return
        old, new = (df.join(touched, "bucket", "left_semi").drop("bucket") for df in (stored, fresh))
        merged = self.staged(conform(upsert(old, new, key), layer).withColumn("bucket", bucket_of(key)), f"{layer}_merged", batch)
        self._overwrite(layer, merged, "bucket")

    def forget(self, layer: str, keys: DataFrame, batch: str) -> None:
        """Drop the rows of an appended layer whose key is in ``keys``; other rows can then be made again.

        One join finds the batches with such rows; what is left of them is staged
        and replaces them in one write. Batches without such rows are left alone;
        one that has no other rows becomes an empty partition.
        """
        key = keys.columns[0]
        rows = self._stored(layer, "batch_id")
        if rows is None:
            return
        hit = self.staged(rows.join(keys, key, "left_semi").select("batch_id").distinct(), f"{layer}_hit", batch)
        left = self.staged(rows.join(hit, "batch_id", "left_semi").join(keys, key, "left_anti"), f"{layer}_left", batch)
        self._overwrite(layer, left.select(*rows.columns), "batch_id")
        for r in hit.join(left.select("batch_id").distinct(), "batch_id", "left_anti").collect():  # names of batches
            self.append(layer, self.spark.createDataFrame([], T.StructType.fromDDL(LAYERS[layer].ddl)), r.batch_id)

    def commit(self, batch: str) -> None:
        """Note that a batch has gone through all of its jobs."""
        self.append("batch_commits", self.spark.createDataFrame([(batch,)], "batch string"), batch)

    def committed(self, batch: str) -> bool:
        return not self.read("batch_commits", batch=batch).isEmpty()
