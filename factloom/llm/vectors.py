"""Near-duplicate embeddings: int8 tile products with error bounds, full precision where needed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import lowest_labels, python_batches, stored
from factloom.llm.components import components

THRESHOLD = 0.95
#: Distinct vectors of a block; a tile is the product of two blocks.
BLOCK_ROWS = 4096
_STRIP = 512
#: Products of int8 codes add up exactly in single precision up to this many components at once.
_EXACT_DIMS = (1 << 24) // (127 * 127)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at unit length, in double precision; scaled first, so squares neither vanish nor overflow."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, scale, and a bound on the length of what a unit vector loses by them."""
    scale = np.abs(units).max(axis=1) / 127
    codes = np.rint(units / scale[:, None]).astype(np.int8)
    lost = units - codes * scale[:, None]
    return codes, scale, np.sqrt(np.einsum("ij,ij->i", lost, lost)) * (1 + 1e-9) + 1e-12


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes: whole numbers held in floating point."""
    if left.shape[1] <= _EXACT_DIMS:
        return left.astype(np.float32) @ right.astype(np.float32).T
    return left.astype(np.float64) @ right.astype(np.float64).T


def tile_links(a: tuple, b: tuple, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of linked pairs between two blocks of (codes, scale, bound, unit vectors).

    With codes ``s c`` that miss a unit vector by a vector of length ``e`` at
    most, the cosine is at most ``s s' (c . c') + (1 + e) e' + e``. A strip of
    products is compared with the smallest product that could still do, by the
    largest scale and bound of the other block; what is left is held against the
    pair's own bound, and what then remains is computed in double precision.
    """
    (ca, sa, ea, ua), (cb, sb, eb, ub) = a, b
    slack = threshold - 1e-9
    need = (slack - ea - (1 + ea) * eb.max()) / (sa * sb.max())
    need = np.where(need > 0, need, -np.inf)  # a bound that says nothing
    for lo in range(0, len(ca), _STRIP):
        dots = products(ca[lo : lo + _STRIP], cb)
        i, j = np.nonzero(dots >= need[lo : lo + _STRIP, None].astype(dots.dtype) * (1 - 1e-6))
        dot = dots[i, j].astype(np.float64)
        i += lo
        if same:
            keep = i < j
            i, j, dot = i[keep], j[keep], dot[keep]
        keep = sa[i] * sb[j] * dot + (1 + ea[i]) * eb[j] + ea[i] >= slack
        i, j = i[keep], j[keep]
        linked = [np.zeros(0, dtype=bool)]
        for k in range(0, len(i), 1 << 16):
            linked.append(np.einsum("ij,ij->i", ua[i[k : k + (1 << 16)]], ub[j[k : k + (1 << 16)]]) >= threshold)
        keep = np.concatenate(linked)
        if keep.any():
            yield i[keep], j[keep]


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``id, n_links, component_id, kept`` of every row, by cosine of at least ``threshold``.

    Equal vectors are one class, folded before any tile; a class counts as many
    links as it has members. Classes are dealt to blocks by a hash, and each
    pair of blocks is one tile and one task's group, so no group grows with the
    data and copies cost nothing. A tile returns link counts and a spanning
    forest of what it found, never all pairs. The work is quadratic in distinct
    vectors. Vectors of another length are not compared. Vectors that are null,
    empty, zero or hold a null, NaN or infinite component link with nothing, nor
    do rows without id (component null, not kept). Rows that share an id are one
    vector for the components; repeated rows count as links of each other. Other
    columns are not read. No rows: no rows.
    """
    spark = vectors.sparkSession
    python_batches(spark)
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    dtype = np.dtype(np.float32 if kind == "float" else np.float64)
    store = "float" if kind == "float" else "double"
    plus_zero = F.transform(F.col(vector_col).cast(f"array<{store}>"), lambda x: x + F.lit(0).cast(store))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), plus_zero.alias("vec"))
    valid = rows.where("id is not null").where(F.coalesce(fine, F.lit(False))).withColumn("hash", F.xxhash64("vec"))
    classes = stored(
        valid.groupBy("hash", "vec").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("members")).withColumn("dim", F.size("vec")),
        "vector-classes",
    )
    blocks = stored(classes.groupBy("dim").count().select("dim", F.ceil(F.col("count") / block_rows).cast("int").alias("blocks")), "vector-blocks")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                raw = part.column(4).flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, dim)
                codes, scale, bound = quantised(unit(raw))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], pa.array([c.tobytes() for c in codes]), pa.array(scale), pa.array(bound), pa.array([r.tobytes() for r in raw])],
                    ["node", "members", "dim", "blocks", "codes", "scale", "bound", "raw"],
                )

    coded = classes.join(blocks, "dim").select("node", "members", "dim", "blocks", "vec").mapInArrow(
        code, "node long, members long, dim int, blocks int, codes binary, scale double, bound double, raw binary"
    )
    tiles = coded.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.expr("sequence(0, blocks - 1)"))
    ).select("dim", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "members", "codes", "scale", "bound", "raw")

    def tile(group: pa.Table) -> pa.Table:
        own, node, members = (group.column(c).to_numpy() for c in ("own", "node", "members"))
        first = own == group.column("i")[0].as_py()
        codes = np.frombuffer(b"".join(group.column("codes").to_pylist()), dtype=np.int8).reshape(len(own), -1)
        units = unit(np.frombuffer(b"".join(group.column("raw").to_pylist()), dtype=dtype).reshape(len(own), -1))
        scale, bound = group.column("scale").to_numpy(), group.column("bound").to_numpy()
        places = [np.flatnonzero(first), np.flatnonzero(~first)]
        same = not len(places[1]) and group.column("i")[0] == group.column("j")[0]
        if same:
            places[1] = places[0]
        links, labels = np.zeros(len(own), dtype=np.int64), np.arange(len(own))
        if len(places[0]) and len(places[1]):
            left, right = ((codes[p], scale[p], bound[p], units[p]) for p in places)
            for i, j in tile_links(left, right, threshold, same):
                i, j = places[0][i], places[1][j]
                links += np.bincount(i, members[j], len(own)).astype(np.int64) + np.bincount(j, members[i], len(own)).astype(np.int64)
                labels = lowest_labels(len(own), i, j, labels)
        found = np.flatnonzero(links)
        return pa.table({"node": node[found], "links": links[found], "root": node[labels[found]]})

    found = stored(tiles.groupBy("dim", "i", "j").applyInArrow(tile, "node long, links long, root long"), "vector-links")
    joined = components(found, "node", "root")
    lowest = joined.withColumnRenamed("component", "component_id")
    by_class = (
        classes.select("hash", "vec", "node", "members")
        .join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(lowest, "node", "left")
        .select("hash", "vec", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "node").alias("component_id"))
    )
    linked = valid.join(by_class, ["hash", "vec"]).select("id", "n_links", "component_id")
    alone = rows.where(F.col("id").isNull() | ~F.coalesce(fine, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all rows of ``embeddings`` at cosine 0.95."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


OP5_SQL = """
with recursive v as (select vec_id, cast(embedding as double[]) as e from embeddings),
ok as (select vec_id, e from v where len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from ok a join ok b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.95),
r as (select vec_id as id, vec_id as low from v union select l.b, r.low from r join l on l.a = r.id and r.low < l.b),
c as (select id, min(low) as low from r group by id), n as (select a, count(*) as n from l group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, low as component_id, vec_id = low as kept from v join c on id = vec_id left join n on a = vec_id
"""
