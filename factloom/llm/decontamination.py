"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import python_batches, stored, texts_of, tidied
from factloom.llm.tokens import hashed_grams, hashed_words

#: Words of the shortest tile, and the share of an item's words that tiles must cover.
MIN_TILE, COVERAGE = 5, 0.5
#: Bits of the filter that every task gets, whatever the size of the benchmark: 1 MB.
FILTER_BITS = 23
_PRIME, _RADIX = (1 << 61) - 1, 1_000_003


def windows(words: list[int], marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """Karp-Rabin: rolling hash and start of every window of ``size`` unmarked words."""
    lead, value, run = pow(_RADIX, size - 1, _PRIME), 0, 0
    for k, word in enumerate(words):
        if marked[k]:
            value = run = 0
            continue
        if run >= size:
            value -= words[k - size] * lead
        value, run = (value * _RADIX + word) % _PRIME, run + 1
        if run >= size:
            yield value, k - size + 1


def tiles(text: list[int], item: list[int], smallest: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``text start, item start, length`` of tiles, each word in one tile at most.

    Again and again the longest matches of unmarked words are sought, from
    windows of ``smallest`` words with equal rolling hashes that are compared
    and drawn out, and marked unless an earlier one of that length lies in the
    way; ties go to the first place in the text, then in the item. So passages
    are found in whatever order they stand.
    """
    in_text, in_item, found = [False] * len(text), [False] * len(item), []
    while True:
        at: dict[int, list[int]] = defaultdict(list)
        for value, k in windows(item, in_item, smallest):
            at[value].append(k)
        longest, matches = smallest, []
        for value, t in windows(text, in_text, smallest):
            for k in at.get(value, ()):
                if t and k and not in_text[t - 1] and not in_item[k - 1] and text[t - 1] == item[k - 1]:
                    continue  # part of a match that began before
                n = 0
                while t + n < len(text) and k + n < len(item) and not in_text[t + n] and not in_item[k + n] and text[t + n] == item[k + n]:
                    n += 1
                if n > longest:
                    longest, matches = n, []
                if n == longest:
                    matches.append((t, k))
        if not matches:
            return found
        for t, k in matches:
            if not any(in_text[t : t + longest]) and not any(in_item[k : k + longest]):
                in_text[t : t + longest] = in_item[k : k + longest] = [True] * longest
                found.append((t, k, longest))


def _key(id_col: str, text_col: str) -> list:
    return [F.xxhash64(F.col(id_col), F.col(text_col)).alias("k1"), F.hash(F.col(text_col), F.col(id_col)).alias("k2")]


def _items(benchmark: DataFrame, id_col: str, text_col: str, smallest: int) -> DataFrame:
    """``item, words`` of items with a word; items with the same words are one, named by the smallest id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, owner = hashed_words(texts_of(batch.column(1)))
            cut = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            rows = [words[a:b].view(np.int64) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int64()))], ["item", "words"])

    made = benchmark.select(F.col(id_col).cast("long"), F.col(text_col)).where(F.col(id_col).isNotNull()).mapInArrow(tidied(run), "item long, words array<long>")
    one = made.where(F.size("words") > 0).groupBy(F.xxhash64("words").alias("h"), "words").agg(F.min("item").alias("item"))
    # an item shorter than the shortest tile is a tile of its own
    return one.select("item", "words", F.least(F.size("words"), F.lit(smallest)).alias("tile"))


def _seeds(items: DataFrame, coverage: float) -> tuple[DataFrame, DataFrame]:
    """All shingles, and ``seed, item``: those that a document must share at least one of to cover enough of the item.

    Shingles that many items share are left out first, as long as the words
    under those left out fall short of the coverage: a document that shares
    nothing else cannot reach it. Phrases common to a whole benchmark therefore
    don't pair every document with every item.
    """
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, words, tile in zip(*(c.to_pylist() for c in batch.columns)):
                words = np.array(words, dtype=np.int64).view(np.uint64)
                grams, at = hashed_grams(words, np.zeros(len(words), dtype=np.int8), tile)
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * n), pa.array(at.astype(np.int32)), pa.array([tile] * n, pa.int32()), pa.array([len(words)] * n, pa.int32()), pa.array(grams.view(np.int64))],
                    ["item", "at", "tile", "size", "seed"],
                )

    every = stored(items.select("item", "words", "tile").mapInArrow(tidied(shingle), "item long, at int, tile int, size int, seed long"), "benchmark-seeds")
    common = every.groupBy("seed").agg(F.count_distinct("item").alias("items"))
    gathered = every.join(common, "seed").groupBy("item", "tile", "size").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("items")).alias("rank"), "at", "seed"))).alias("seeds")
    )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, tile, size, seeds in zip(*(c.to_pylist() for c in batch.columns)):
                under, kept = np.zeros(size, dtype=bool), []
                for s in seeds:
                    new = under.copy()
                    new[s["at"] : s["at"] + tile] = True
                    if s["rank"] < -1 and new.sum() < coverage * size:
                        under = new
                    else:
                        kept.append(s["seed"])
                kept = sorted(set(kept))
                yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array([item] * len(kept), pa.int64())], ["seed", "item"])

    return every, stored(gathered.mapInArrow(tidied(choose), "seed long, item long"), "benchmark-keys")


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", smallest: int = MIN_TILE, coverage: float = COVERAGE,
) -> DataFrame:
    """``k1, k2, id, item_id, item_words, covered, coverage, tiles`` of documents whose tiles cover enough of an item.

    Words are lower-cased runs of letters and digits. One pass over the texts
    keeps the runs of words whose shingles may stand in the benchmark, by a
    filter of fixed size; only those runs can hold tiles. They meet the
    benchmark in a join on shingles, which leaves pairs; each pair is tiled.
    Items with the same words are one, named by the smallest id; items shorter
    than ``smallest`` words must occur whole. Null and wordless texts and items
    match nothing, null items are passed over. Null document ids stay null.
    Repeated rows give one row. Other columns are not read. Empty tables: no rows.
    """
    spark = docs.sparkSession
    python_batches(spark)
    items = stored(_items(benchmark, item_col, item_text_col, smallest), "benchmark-items")
    every, keys = _seeds(items, coverage)
    sizes = sorted(r.tile for r in items.select("tile").distinct().collect())  # 1 to smallest
    bucket = F.shiftrightunsigned("seed", 64 - FILTER_BITS).cast("long") + 1  # bitmaps count from one
    maps = (
        every.select(bucket.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("n"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits")).collect()  # 257 rows of 4 KB at most
    )
    bits = np.zeros((1 << FILTER_BITS) + (1 << 16), dtype=bool)
    for r in maps:
        # bucket n holds the numbers 32768 * (n - 1) to 32768 * n - 1
        part = np.unpackbits(np.frombuffer(bytes(r.bits), dtype=np.uint8), bitorder="little")
        low = (r.n - 1) * 32768
        bits[low : low + len(part)] = part.astype(bool)
    packed = spark.sparkContext.broadcast(np.packbits(bits[: 1 << FILTER_BITS]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(packed.value).view(bool)
        for batch in batches:
            words, owner = hashed_words(texts_of(batch.column(3)))
            inside, seeds = np.zeros(len(words), dtype=bool), [[], []]
            for size in sizes:
                grams, at = hashed_grams(words, owner, size)
                hit = known[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
                seeds[0].append(at[hit])
                seeds[1].append(grams[hit])
                for k in range(size):
                    inside[at[hit] + k] = True
            if not inside.any():
                continue
            at, grams = np.concatenate(seeds[0]), np.concatenate(seeds[1])
            order = np.argsort(at, kind="stable")
            at, grams = at[order], grams[order]
            new = inside & ~(np.concatenate([[False], inside[:-1]]) & np.concatenate([[False], owner[1:] == owner[:-1]]))
            starts = np.flatnonzero(new)
            edges = np.flatnonzero(inside)
            ends = edges[np.concatenate([np.searchsorted(edges, starts[1:]) - 1, [len(edges) - 1]])] + 1
            of = owner[starts]
            first = np.searchsorted(owner, of)
            cut = np.searchsorted(at, np.concatenate([starts, [len(words)]]))
            take = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [*(c.take(take) for c in batch.columns[:3]), pa.array((starts - first).astype(np.int64)),
                 pa.array([words[a:b].view(np.int64) for a, b in zip(starts, ends)], pa.list_(pa.int64())),
                 pa.array([np.unique(grams[a:b]).view(np.int64) for a, b in zip(cut[:-1], cut[1:])], pa.list_(pa.int64()))],
                ["k1", "k2", "id", "at", "words", "seeds"],
            )

    runs = stored(
        docs.select(*_key(id_col, text_col), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(tidied(run), "k1 long, k2 int, id long, at long, words array<long>, seeds array<long>"), "benchmark-runs",
    )
    pairs = runs.select("k1", "k2", F.explode("seeds").alias("seed")).distinct().join(keys, "seed").select("k1", "k2", "item").distinct()
    of_doc = runs.groupBy("k1", "k2").agg(F.first("id").alias("id"), F.sort_array(F.collect_set(F.struct("at", "words"))).alias("runs"))
    both = pairs.join(of_doc, ["k1", "k2"]).join(items, "item").select("k1", "k2", "id", "item", "runs", "words", "tile")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k1, k2, key, item, held, words, least in zip(*(c.to_pylist() for c in batch.columns)):
                text, place = [], []
                for r in held:
                    text += [*r["words"], None]
                    place += [*range(r["at"], r["at"] + len(r["words"])), -1]
                ids = {w: n for n, w in enumerate(dict.fromkeys([*words, *text]))}
                found = tiles([ids[w] for w in text], [ids[w] for w in words], least)  # the gap between runs is in no item
                covered = sum(n for _, _, n in found)
                if covered >= coverage * len(words):
                    out.append((k1, k2, key, item, len(words), covered, covered / len(words),
                                [{"doc_start": place[t], "item_start": i, "length": n} for t, i, n in sorted(found)]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    spec = pa.struct([("doc_start", pa.int64()), ("item_start", pa.int32()), ("length", pa.int32())])
    names = ["k1", "k2", "id", "item_id", "item_words", "covered", "coverage", "tiles"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.list_(spec)]
    return both.mapInArrow(
        tidied(tile), "k1 long, k2 int, id long, item_id long, item_words int, covered int, coverage double,"
        " tiles array<struct<doc_start: long, item_start: int, length: int>>",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rules) -> DataFrame:
    """The rows of ``docs`` that cover no item of the benchmark, with all their columns."""
    bad = stored(leaks(docs, benchmark, id_col, text_col, **rules).select("k1", "k2").distinct(), "leaks")
    k1, k2 = _key(id_col, text_col)
    return docs.join(bad, (k1 == bad.k1) & (k2 == bad.k2), "left_anti")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents among all ``documents`` that hold an item of ``benchmark``, with the tiles."""
    found = leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "item_words", "covered", "coverage", "tiles")
