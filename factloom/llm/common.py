"""What the operators share: the shared folder, written tables, small array helpers."""

from __future__ import annotations

import ctypes
import gc
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

LOCAL_SHARED = "/tmp/checkpoints"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share (``spark.checkpoint.dir``).

    Only where that is unset and the session is local is a folder of this
    machine used; a cluster without the setting is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = LOCAL_SHARED
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def python_batches(spark: SparkSession, rows: int = 500, megabytes: int = 4) -> None:
    """Bound the Arrow batches by rows and bytes, so that long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))


def give_back() -> None:
    """Return memory that is free to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` that gives its memory back now and then and when a task's rows are through: workers are used again, by other stages too."""
    def wrapped(batches: Iterator) -> Iterator:
        last = time.monotonic()
        try:
            for out in run(batches):
                yield out
                if time.monotonic() - last > 0.5:
                    del out
                    give_back()
                    last = time.monotonic()
        finally:
            gc.collect()
            give_back()

    return wrapped


def texts_of(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow text column; null is empty."""
    return [b"" if v is None else v for v in column.cast("binary").to_pylist()]


def lowest_labels(n: int, left: np.ndarray, right: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Label of every one of ``n`` nodes: the lowest node its links reach."""
    labels = np.arange(n) if labels is None else labels
    while True:
        low = np.minimum(labels[left], labels[right])
        new = labels.copy()
        np.minimum.at(new, labels[left], low)
        np.minimum.at(new, labels[right], low)
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        if np.array_equal(new, labels):
            return labels
        labels = new
