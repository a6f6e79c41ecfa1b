"""Mixing sources to target weights: block quotas split down a tree of output shards."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import python_batches, stored, tidied

#: Weights of the sources in code-point order (null last), repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Words of the mix as a share of all words, and of a source as a share of its own.
SHARE, MOST = 1.5, 2.0
#: Words of a block, the unit that quotas and draws count, and of a shard.
BLOCK_WORDS, SHARD_WORDS = 1 << 17, 1 << 22
_GROUP = 1024


@dataclass
class Quota:
    """What the mix takes of one source: whole rounds, then blocks in permuted order, then part of one block."""

    source: str | None
    size: int
    target: float = 0.0
    blocks: int = 1
    rounds: int = 0
    last: int = -1  # rank of the block of the last round that is taken in part; ranks below it are taken whole
    cut: int | None = None  # of that block, documents up to this hash are taken
    steps: tuple[int, ...] = ()
    shifts: tuple[int, ...] = ()

    @property
    def draws(self) -> int:
        """Blocks drawn, the one taken in part included."""
        return self.rounds * self.blocks + max(0, self.last + (self.cut is not None))


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """``share`` of all sizes by weight; what lies above ``most`` times a size is shared out anew by weight."""
    capped: set[int] = set()
    left = share * sum(sizes)
    while True:
        free = [k for k in range(len(sizes)) if k not in capped]
        total = sum(weights[k] for k in free)
        over = [k for k in free if left * weights[k] / total > most * sizes[k]]
        if not over:
            return [most * sizes[k] if k in capped else left * weights[k] / total for k in range(len(sizes))]
        capped.update(over)
        left -= sum(most * sizes[k] for k in over)


def permutation(blocks: int, seed: str) -> tuple[int, int]:
    """Step and shift of ``rank = (block * step + shift) mod blocks``."""
    draw = random.Random(seed)
    step = next(s for s in iter(lambda: draw.randrange(1, blocks + 1), None) if math.gcd(s, blocks) == 1)
    return step, draw.randrange(blocks)


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``id, source, size, draw_hash``; size counts words between ASCII white space (null: 0)."""
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), size_of(text_col).alias("size"),
        hash_of(id_col, text_col).alias("draw_hash"),
    )


def size_of(text_col: str):
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_of(id_col: str, text_col: str):
    return F.xxhash64(F.lit("mix"), F.col(id_col), F.col(text_col))


def _plan_frame(spark: SparkSession, quotas: list[Quota]) -> DataFrame:
    rows = [(k, q.source, q.size, q.target, q.blocks, q.rounds, q.last, q.cut, list(q.steps), list(q.shifts)) for k, q in enumerate(quotas)]
    return spark.createDataFrame(
        rows, "source_no int, source string, source_size long, target double, blocks long, rounds int, last long, cut long,"
        " steps array<long>, shifts array<long>",
    )


def _rank(epoch):
    return F.pmod(F.col("block") * F.element_at("steps", epoch + 1) + F.element_at("shifts", epoch + 1), F.col("blocks"))


def quotas_of(
    words: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block_words: int = BLOCK_WORDS, seed: int = 0
) -> list[Quota]:
    """Exact quotas of every source, from ``sized`` rows.

    One row for a source comes to the driver: the sources are the settings of a
    mix. The sums behind it are folded before they are shuffled; running sums
    over the blocks of a large source go through groups of ranks.
    """
    spark = words.sparkSession
    sums = words.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows = sorted(sums, key=lambda r: (r.source is None, r.source or ""))
    quotas = [Quota(r.source, r["size"]) for r in rows]
    wanted = targets([q.size for q in quotas], [weights[k % len(weights)] for k in range(len(quotas))], share, most)
    for q, target in zip(quotas, wanted):
        q.target, q.blocks = target, max(1, math.ceil(q.size / block_words))
        q.rounds = int(target // q.size) if q.size else 0
        pairs = [permutation(q.blocks, f"{seed}/{q.source!r}/{epoch}") for epoch in range(q.rounds + 1)]
        q.steps, q.shifts = zip(*pairs)
    plan = _plan_frame(spark, quotas).withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size")).where("rest > 0")
    placed = (
        words.where("size > 0").withColumnRenamed("source", "own").join(plan, F.col("own").eqNullSafe(F.col("source")))
    ).withColumn("block", F.pmod("draw_hash", "blocks")).withColumn("rank", _rank(F.col("rounds")))
    blocks = placed.groupBy("source_no", "rank", "rest").agg(F.sum("size").alias("held")).withColumn("part", F.floor(F.col("rank") / _GROUP))
    blocks = stored(blocks, "mix-blocks")
    parts = blocks.groupBy("source_no", "part").agg(F.sum("held").alias("part_held"))
    before = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("source_no", "part", F.coalesce(F.sum("part_held").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_no", "part").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    running = blocks.join(parts, ["source_no", "part"]).withColumn(
        "before", F.col("base") + F.coalesce(F.sum("held").over(inside), F.lit(0))
    )
    edge = running.where("before < rest and before + held >= rest").select("source_no", "rank", (F.col("rest") - F.col("before")).alias("need")).collect()
    by_no = {r.source_no: r for r in edge}
    for k, q in enumerate(quotas):
        if k in by_no:
            q.last = by_no[k]["rank"]
        elif q.target > q.rounds * q.size:  # rounding: all blocks
            q.last = q.blocks
    if edge:
        needs = spark.createDataFrame([tuple(r) for r in edge], "edge_no int, edge_rank long, need double")
        order = Window.partitionBy("source_no").orderBy("draw_hash").rowsBetween(Window.unboundedPreceding, -1)
        cuts = (
            placed.join(needs, (F.col("source_no") == F.col("edge_no")) & (F.col("rank") == F.col("edge_rank")))
            .withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
            .where("before + size / 2 <= need").groupBy("source_no").agg(F.max("draw_hash").alias("cut")).collect()
        )
        for r in cuts:
            quotas[r.source_no].cut = r.cut
    return quotas


def shard_quotas(spark: SparkSession, quotas: list[Quota], shards: int, seed: int = 0) -> DataFrame:
    """``shard, source_no, first, n``: which draws of a source an output shard gets.

    The root of the tree holds all draws of all sources. A node gives its left
    half as many draws as that half has places, source by source as a
    multivariate-hypergeometric draw; the generator is seeded by the node, so
    each shard walks its own path without the others. First draws of the right
    half follow those of the left, so shards get disjoint runs of the permuted
    blocks.
    """
    counts = np.array([q.draws for q in quotas], dtype=np.int64)
    total = int(counts.sum())

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                low, high, held, first = 0, shards, counts.copy(), np.zeros(len(counts), dtype=np.int64)
                while high - low > 1:
                    mid = (low + high) // 2
                    places = total * mid // shards - total * low // shards
                    left = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(held, places, method="marginals")
                    if shard < mid:
                        high, held = mid, left
                    else:
                        low, held, first = mid, held - left, first + left
                has = np.flatnonzero(held)
                yield pd.DataFrame({"shard": shard, "source_no": has, "first": first[has], "n": held[has]})

    if not total:
        return spark.createDataFrame([], "shard long, source_no int, first long, n long")
    return spark.range(shards).mapInPandas(tidied(walk), "shard long, source_no int, first long, n long")


def draws_of(rows: DataFrame, quotas: list[Quota], shards: int, seed: int = 0) -> DataFrame:
    """A row for every time a row of ``rows`` (``source, size, draw_hash`` and others) is taken, with ``epoch`` and ``shard``."""
    spark = rows.sparkSession
    plan = _plan_frame(spark, quotas).withColumnRenamed("source", "plan_source")
    dealt = stored(
        shard_quotas(spark, quotas, shards, seed).select("shard", "source_no", F.explode(F.expr("sequence(first, first + n - 1)")).alias("draw")),
        "mix-draws",
    )
    extra = (F.col("last_rank") < F.col("last")) | ((F.col("last_rank") == F.col("last")) & (F.col("draw_hash") <= F.col("cut")))
    times = F.col("rounds") + F.when(F.coalesce(extra, F.lit(False)), 1).otherwise(0)
    taken = (
        rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
        .withColumn("block", F.pmod("draw_hash", "blocks")).withColumn("last_rank", _rank(F.col("rounds")))
        .withColumn("times", times).where("times > 0 and size > 0")
        .withColumn("epoch", F.explode(F.expr("sequence(0, times - 1)")))
        .withColumn("draw", F.col("epoch") * F.col("blocks") + _rank(F.col("epoch")))
    )
    return taken.join(dealt, ["source_no", "draw"]).select(*rows.columns, "epoch", "shard")


def plan_mix(docs: DataFrame, id_col: str, text_col: str, source_col: str, block_words: int, shard_words: int, seed: int, **rules):
    """Sized rows (written, with a row number), quotas and the number of shards."""
    words = stored(sized(docs, id_col, text_col, source_col).withColumn("row", F.monotonically_increasing_id()), "mix-words")
    quotas = quotas_of(words, block_words=block_words, seed=seed, **rules)
    return words, quotas, max(1, round(sum(q.target for q in quotas) / shard_words))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = 0, **rules,
) -> DataFrame:
    """The mixed rows with all columns of ``docs``, in ``shard`` order, shuffled inside shards.

    A row comes once for each time it is taken, at most twice. Sources are
    ranked by code point, null is a source of its own and last. The documents of
    a source lie in blocks by a hash of id and text; whole rounds are taken,
    then blocks in permuted order, then documents of one block up to the one
    that comes nearest to the target. Rows without words (null and empty texts)
    hold nothing of a target and are not taken. Equal rows are taken together;
    null ids are hashed like others. No rows: no rows. Extra columns are carried
    along, whatever their names; the column of the shard is added as
    ``mix_shard``.
    """
    _, quotas, shards = plan_mix(docs, id_col, text_col, source_col, block_words, shard_words, seed, **rules)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(source_col).alias("source"),
        size_of(text_col).alias("size"), hash_of(id_col, text_col).alias("draw_hash"),
    )
    drawn = draws_of(rows, quotas, shards, seed)
    place = F.xxhash64(F.lit(seed), "draw_hash", "epoch")
    return (
        drawn.withColumn("place", place).repartition("shard").sortWithinPartitions("shard", "place")
        .select("doc.*", F.col("shard").alias("mix_shard"))
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each of all ``documents``, and in which shards."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words, quotas, shards = plan_mix(docs, "doc_id", "text", "source", BLOCK_WORDS, SHARD_WORDS, 0)
    drawn = draws_of(words, quotas, shards).groupBy("row").agg(
        F.sum("size").alias("taken"), F.sort_array(F.collect_list("shard")).alias("shards")  # two at most
    )
    plan = _plan_frame(spark, quotas).withColumnRenamed("source", "plan_source")
    return (
        words.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).join(drawn, "row", "left")
        .select(F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "shards")
    )
