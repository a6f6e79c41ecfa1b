"""Nearest neighbours by learned partitions: a balanced cut of a neighbour graph, and a small classifier that routes.

1. A bounded sample of the distinct vectors is linked with its nearest
   neighbours; the graph is cut into balanced parts with few links between them.
2. A small network learns the part of a vector's neighbours from the vector.
   Every row of the table is indexed under its most probable part.
3. Bounded trial queries are held against all rows by brute force. The least
   number of parts that holds the wanted share of their true neighbours is what
   every query visits, most probable first.
4. Rows of the visited parts are reranked by distance in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import python_batches, stored

K = 10
#: Distinct vectors that the graph and the classifier are fitted on, at most, and their bytes in single precision, at most.
SAMPLE, SAMPLE_BYTES = 16_384, 32 << 20
#: Parts, at most; each has this many vectors of the sample at least.
PARTS, LEAST = 64, 64
#: Links of a vector in the graph; how far a part may outgrow its share.
LINKS, LOOSE = 16, 1.05
HIDDEN, EPOCHS, BATCH, RATE, SEED = 128, 12, 256, 4e-3, 11
#: Trial queries, and the share of their true neighbours that the visited parts must hold.
TRIALS, RECALL = 256, 0.96
#: Distinct vectors and queries that meet in one task's group, and the bytes of either in double precision.
TILE_ROWS, TILE_QUERIES, TILE_BYTES, _STRIP = 16_384, 8_192, 64 << 20, 128


def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances by products: fast, and right up to ``slack``."""
    return np.einsum("ij,ij->i", left, left)[:, None] + np.einsum("ij,ij->i", right, right) - 2 * (left @ right.T)


def slack(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A bound on what ``squared`` may be off, for each row of ``left``."""
    most = np.einsum("ij,ij->i", right, right).max(initial=0.0)
    return 8 * (left.shape[1] + 8) * np.finfo(np.float64).eps * (np.einsum("ij,ij->i", left, left) + most)


def nearest(queries: np.ndarray, rows: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``query, row, distance`` of the ``k`` nearest rows of every query and all that tie with them; distances from differences."""
    queries, rows = queries.astype(np.float64), rows.astype(np.float64)
    for lo in range(0, len(queries), _STRIP):
        part = queries[lo : lo + _STRIP]
        with np.errstate(all="ignore"):
            near = squared(part, rows)
            edge = np.partition(near, k - 1, axis=1)[:, k - 1] if len(rows) > k else np.full(len(part), np.inf)
            i, j = np.nonzero(~(near > (edge + 2 * slack(part, rows))[:, None]))  # what overflows is not a number and stays
            found = [np.zeros(0)]
            for at in range(0, len(i), 1 << 15):
                away = part[i[at : at + (1 << 15)]] - rows[j[at : at + (1 << 15)]]
                found.append(np.sqrt(np.einsum("ij,ij->i", away, away)))
        yield i + lo, j, np.concatenate(found)


def first_of(groups: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of every group by score, then id."""
    order = np.lexsort((ids, score, groups))
    groups = groups[order]
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if len(groups) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(groups)) - np.repeat(starts, np.diff(np.append(starts, len(groups))))
    return order[rank < k]


def balanced_start(points: np.ndarray, parts: int) -> np.ndarray:
    """Parts of nearly equal size: halves along the direction of largest spread, again and again."""
    label, todo = np.zeros(len(points), dtype=np.int64), [(np.arange(len(points)), 0, parts)]
    while todo:
        rows, first, n = todo.pop()
        if n == 1:
            label[rows] = first
            continue
        centred = points[rows] - points[rows].mean(axis=0)
        axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = rows[np.lexsort((rows, np.round(centred @ axis, 9)))]
        cut = len(rows) * (n // 2) // n
        todo += [(order[:cut], first, n // 2), (order[cut:], first + n // 2, n - n // 2)]
    return label


def cut_graph(links: np.ndarray, label: np.ndarray, parts: int, rounds: int = 20) -> np.ndarray:
    """Move vertices to the part most of their neighbours are in, best gains first, while no part outgrows its share.

    ``links`` has a row of neighbours for every vertex; links count both ways.
    """
    n, label = len(label), label.copy()
    ends = np.repeat(np.arange(n), links.shape[1]), links.ravel()
    a, b = np.concatenate(ends), np.concatenate(ends[::-1])
    room = int(np.ceil(LOOSE * n / parts))
    for _ in range(rounds):
        pulls = np.bincount(a * parts + label[b], minlength=n * parts).reshape(n, parts)
        best = pulls.argmax(axis=1)
        gain = pulls[np.arange(n), best] - pulls[np.arange(n), label]
        sizes, moved = np.bincount(label, minlength=parts), 0
        for v in np.lexsort((np.arange(n), -gain)):
            if gain[v] <= 0:
                break
            if sizes[best[v]] < room:
                sizes[label[v]] -= 1
                sizes[best[v]] += 1
                label[v], moved = best[v], moved + 1
        if moved < n // 1000 + 1:
            break
    return label


@dataclass
class Router:
    """A network with one hidden layer; scores every part for a vector."""

    mean: np.ndarray
    scale: float
    weights: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        with np.errstate(all="ignore"):
            inner = np.maximum(np.nan_to_num((rows.astype(np.float64) - self.mean) * self.scale) @ w1 + b1, 0)
            return np.nan_to_num(inner @ w2 + b2)

    def ranked(self, rows: np.ndarray) -> np.ndarray:
        """Parts of every row, most probable first, ties by number."""
        return np.argsort(-self.scores(rows), axis=1, kind="stable")


def fit_router(points: np.ndarray, wanted: np.ndarray) -> Router:
    """Learn, by Adam in a fixed order, for every point the shares of its neighbours' parts (``wanted``)."""
    rng = np.random.default_rng(SEED)
    mean = points.mean(axis=0)
    spread = np.sqrt(np.mean((points - mean) ** 2))
    router = Router(mean, 1.0 / spread if spread > 0 else 1.0, (
        rng.normal(size=(points.shape[1], HIDDEN)) * np.sqrt(2 / points.shape[1]), np.zeros(HIDDEN),
        rng.normal(size=(HIDDEN, wanted.shape[1])) * np.sqrt(1 / HIDDEN), np.zeros(wanted.shape[1]),
    ))
    x, first, second, step = (points - mean) * router.scale, [0.0] * 4, [0.0] * 4, 0
    every = max(1, -(-len(points) // BATCH)) * EPOCHS
    for _ in range(EPOCHS):
        order = rng.permutation(len(points))
        for lo in range(0, len(points), BATCH):
            rows, y = x[order[lo : lo + BATCH]], wanted[order[lo : lo + BATCH]]
            w1, b1, w2, b2 = router.weights
            inner = np.maximum(rows @ w1 + b1, 0)
            out = inner @ w2 + b2
            out = np.exp(out - out.max(axis=1, keepdims=True))
            back = (out / out.sum(axis=1, keepdims=True) - y) / len(rows)
            inward = (back @ w2.T) * (inner > 0)
            step += 1
            for k, g in enumerate((rows.T @ inward, inward.sum(axis=0), inner.T @ back, back.sum(axis=0))):
                first[k], second[k] = 0.9 * first[k] + 0.1 * g, 0.999 * second[k] + 0.001 * g * g
                router.weights[k][...] -= RATE * (1 - step / (every + 1)) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return router


def valid_rows(vectors: DataFrame, id_col: str, vector_col: str, store: str) -> DataFrame:
    """``hash, vec, id`` of the rows that take part, repeated rows once."""
    plus_zero = F.transform(F.col(vector_col).cast(f"array<{store}>"), lambda x: x + F.lit(0).cast(store))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), plus_zero.alias("vec"))
    return rows.where("id is not null").where(F.coalesce(fine, F.lit(False))).select(F.xxhash64("vec").alias("hash"), "vec", "id").distinct()


def distinct_vectors(rows: DataFrame, k: int, name: str) -> DataFrame:
    """``cls, dim, hash, vec, ids`` of every distinct vector, written; ``ids`` are its ``k + 1`` smallest.

    More of a vector's copies can never be among ``k`` neighbours. Copies are cut
    down before they are brought together.
    """
    place = F.row_number().over(Window.partitionBy("hash", "vec").orderBy("id"))
    few = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    classes = few.groupBy("hash", "vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return stored(classes.select(F.monotonically_increasing_id().alias("cls"), F.size("vec").alias("dim"), "hash", "vec", "ids"), name)


def matrix(column) -> np.ndarray:
    """Rows from an Arrow column of lists of one length."""
    held = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return held.flatten().to_numpy(zero_copy_only=False).reshape(len(held), -1)


def picked(classes: DataFrame, dim: int, most: int, of: int, salt: str) -> np.ndarray:
    """About ``most`` of the ``of`` distinct vectors of length ``dim``, never more, chosen by a hash; the same on every run."""
    draw = F.pmod(F.xxhash64(F.lit(salt), "hash"), F.lit(1 << 40))
    rows = classes.where((F.col("dim") == dim) & (draw < int(min(1.0, 0.95 * most / of if of > most else 1.0) * (1 << 40))))
    table = rows.select(draw.alias("draw"), "vec").orderBy("draw", "vec").limit(most).select("vec").toArrow()
    return matrix(table.column("vec")).astype(np.float64)


def sample_links(spark: SparkSession, points: np.ndarray, links: int) -> np.ndarray:
    """The nearest others of every point of the (bounded) sample, found by tasks that take a slice each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy()
            for lo in range(0, len(at), _STRIP):
                rows = at[lo : lo + _STRIP]
                near = squared(points[rows], points)
                near[np.arange(len(rows)), rows] = np.inf
                best = np.sort(np.argpartition(near, links - 1, axis=1)[:, :links], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(list(best), pa.list_(pa.int64()))], ["at", "near"])

    found = spark.range(len(points)).mapInArrow(run, "at long, near array<long>").collect()
    return np.array([r.near for r in sorted(found)], dtype=np.int64)


def learn_partitions(points: np.ndarray, spark: SparkSession, parts: int) -> Router | None:
    """The router, fitted on the sample ``points``; null if that is too small for two parts, then all rows are one part."""
    if np.abs(points).max(initial=0) > 1e100 or (n := min(parts, len(points) // LEAST)) < 2:
        return None
    links = sample_links(spark, points, min(LINKS, len(points) - 1))
    label = cut_graph(links, balanced_start(points, n), n)
    wanted = np.zeros((len(points), n))
    np.add.at(wanted, (np.repeat(np.arange(len(points)), links.shape[1]), label[links].ravel()), 1.0)
    wanted[np.arange(len(points)), label] += links.shape[1] / 4
    return fit_router(points, wanted / wanted.sum(axis=1, keepdims=True))


def visits(indexed: DataFrame, queries: np.ndarray, router: Router, dim: int, k: int, recall: float) -> int:
    """The least number of parts whose rows hold ``recall`` of the true neighbours of the trial queries, by brute force over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, dtype=t) for t in (np.int64, np.float64, np.int64, np.int64)]
        for batch in batches:
            rows, cls, part = matrix(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for i, j, away in nearest(queries, rows, k + 1):
                keep = away > 0  # a trial is not its own neighbour
                held = [np.concatenate([h, x[keep]]) for h, x in zip(held, (i, away, cls[j], part[j].astype(np.int64)))]
            best = first_of(held[0], held[1], held[2], k)
            held = [h[best] for h in held]
        yield pa.RecordBatch.from_arrays([pa.array(h) for h in held], ["trial", "away", "cls", "part"])

    near = indexed.where(F.col("dim") == dim).select("vec", "cls", "part").mapInArrow(run, "trial long, away double, cls long, part long")
    order = F.row_number().over(Window.partitionBy("trial").orderBy("away", "cls"))
    true = near.withColumn("rank", order).where(F.col("rank") <= k).select("trial", "part").collect()  # TRIALS times k rows at most
    if not true:
        return 1
    ranked = router.ranked(queries)
    place = np.array([np.flatnonzero(ranked[r.trial] == r.part)[0] for r in true])
    share = np.cumsum(np.bincount(place, minlength=ranked.shape[1])) / len(place)
    return int(np.flatnonzero(share >= recall)[0]) + 1


def search(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
    parts: int = PARTS, sample: int = SAMPLE, recall: float = RECALL, tile_rows: int = TILE_ROWS, tile_queries: int = TILE_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found of every query, by Euclidean distance; ties to the smaller id.

    ``queries`` are rows like those of ``vectors``; the row that is the query
    itself (same id, same vector) is not among its neighbours. Equal vectors are
    indexed and sought once.
    Vectors that are null, empty, zero or hold a null, NaN or infinite component,
    and rows without id, take no part on either side. Only vectors of one length
    are compared; those of another length than the most frequent are searched
    in full. Repeated rows count once; an id with several vectors is a candidate
    and a query with each. Fewer candidates than ``k``: all of them. Other columns are not read. No rows, or
    no queries: no rows. Distances that overflow are infinite.

    A part is dealt to groups of at most about ``tile_rows`` vectors and
    ``tile_queries`` queries by a hash, so a part that has outgrown the others
    is many groups. A group returns ``k + 1`` rows for a query at most.
    """
    spark = vectors.sparkSession
    python_batches(spark, 4096, 8)
    store = "float" if vectors.schema[vector_col].dataType.elementType.simpleString() == "float" else "double"
    classes = distinct_vectors(valid_rows(vectors, id_col, vector_col, store), k, "ann-classes")
    asked = stored(valid_rows(queries, id_col, vector_col, store), "ann-queries")
    sought = distinct_vectors(asked, 0, "ann-sought").drop("ids")
    usual = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim, of = (usual[0].dim, usual[0]["count"]) if usual else (0, 0)
    router = learn_partitions(picked(classes, dim, min(sample, SAMPLE_BYTES // (4 * dim)), of, "sample"), spark, parts) if usual else None

    def routed(df: DataFrame, most: int) -> DataFrame:
        """``df`` (with ``dim`` and ``vec``) and ``part``: a row for each of the ``most`` first parts."""
        if router is None:
            return df.withColumn("part", F.lit(0))
        names = df.columns
        length, vec = names.index("dim"), names.index("vec")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places = np.flatnonzero(batch.column(length).to_numpy() == dim)
                found = [[0]] * batch.num_rows
                if len(places):
                    ranked = router.ranked(matrix(batch.column(vec).take(pa.array(places))))[:, :most].tolist()
                    for p, r in zip(places, ranked):
                        found[p] = r
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], [*names, "parts"])

        schema = df.withColumn("parts", F.lit(None).cast("array<int>")).schema
        return df.mapInArrow(run, schema).withColumn("part", F.explode("parts")).drop("parts")

    indexed = stored(routed(classes, 1), "ann-index")
    most = visits(indexed, picked(classes, dim, TRIALS, of, "trial"), router, dim, k, recall) if router else 1
    routes = stored(routed(sought, most), "ann-routes")
    rows, asks = (df.groupBy("dim", "part").agg(F.count("*").alias(n)) for df, n in ((indexed, "n"), (routes, "q")))
    tiles = stored(rows.join(asks, ["dim", "part"]).select(
        "dim", "part", F.ceil(F.col("n") / F.least(F.lit(tile_rows), F.ceil(TILE_BYTES / (F.col("dim") * 8)))).cast("int").alias("chunks"),
        F.ceil(F.col("q") / F.least(F.lit(tile_queries), F.ceil(TILE_BYTES / (F.col("dim") * 8)))).cast("int").alias("blocks"),
    ), "ann-tiles")
    own = lambda n: F.pmod(F.xxhash64("cls"), n).cast("int")
    every = lambda n: F.explode(F.expr(f"sequence(0, {n} - 1)"))
    left = indexed.join(tiles, ["dim", "part"]).select("dim", "part", own("chunks").alias("chunk"), every("blocks").alias("block"), "cls", "vec", "ids", F.lit(False).alias("asks"))
    right = routes.join(tiles, ["dim", "part"]).select(
        "dim", "part", every("chunks").alias("chunk"), own("blocks").alias("block"), "cls", "vec", F.lit(None).cast("array<long>").alias("ids"), F.lit(True).alias("asks"),
    )

    def rerank(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy()
        ask, rows = group.filter(pa.array(asks)), group.filter(pa.array(~asks))
        out = [[np.zeros(0, dtype=t)] for t in (np.int64, np.float64, np.int64)]
        if ask.num_rows and rows.num_rows:
            lists = rows.column("ids").combine_chunks()
            sizes, ids, of = lists.value_lengths().to_numpy(), lists.flatten().to_numpy(), ask.column("cls").to_numpy()
            starts = np.cumsum(sizes) - sizes
            for i, j, away in nearest(matrix(ask.column("vec")), matrix(rows.column("vec")), k + 1):
                each = np.repeat(np.arange(len(i)), sizes[j])
                inside = np.arange(len(each)) - np.repeat(np.cumsum(sizes[j]) - sizes[j], sizes[j])
                query, score, vec = of[i][each], away[each], ids[starts[j][each] + inside]
                best = first_of(query, score, vec, k + 1)
                for o, x in zip(out, (query, score, vec)):
                    o.append(x[best])
        return pa.table(dict(zip(["cls", "score", "vec_id"], map(np.concatenate, out))))

    found = left.unionByName(right).groupBy("dim", "part", "chunk", "block").applyInArrow(rerank, "cls long, score double, vec_id long")
    by_class = Window.partitionBy("cls").orderBy("score", "vec_id")
    first = found.withColumn("place", F.row_number().over(by_class)).where(F.col("place") <= k + 1).drop("place")
    named = asked.join(sought.select("hash", "vec", "cls"), ["hash", "vec"]).select(F.col("id").alias("query_id"), "cls")
    by_query = Window.partitionBy("query_id", "cls").orderBy("score", "vec_id")
    return (
        named.join(first, "cls").where("vec_id <> query_id or score > 0")
        .withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def op11_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector of ``embeddings``, sought among all."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, vectors.where("vec_id % 100 = 0"))
