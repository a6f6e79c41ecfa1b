"""SimHash near-duplicates: fingerprints, and a binary-trie self-join over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import lowest_labels, python_batches, stored, texts_of, tidied
from factloom.llm.components import components

SEED = 42
#: Widths of the three leading runs of bits; two errors leave one of them without any.
WIDTHS = (22, 21, 21)
#: Distinct fingerprints of one group that a task takes at once; larger groups are dealt out as pairs of chunks.
GROUP_ROWS = 20_000
_CHUNK = 200_000
_FRONTIER = 1_000_000


def fingerprint(text: bytes, words: int = 3) -> int:
    """64-bit SimHash of the lower-cased ``words``-word shingles of a text, repeats included."""
    tokens = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles: Iterator[bytes] = iter([b" ".join(tokens)])
    else:
        shingles = map(b" ".join, zip(*(tokens[k:] for k in range(words))))
    n = max(1, len(tokens) - words + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype=">u8", count=n)
    set_bits = np.zeros(64, dtype=np.int64)
    for k in range(0, n, 1 << 16):
        part = np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
        set_bits += part.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``id, fp`` (signed 64 bits) of every row. Null and wordless texts have fingerprint 0."""
    python_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, words) for t in texts_of(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidied(run), f"id {id_type}, fp long")


def trie_pairs(keys: np.ndarray, first: np.ndarray, top: int, errors: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs of sorted distinct ``keys`` that differ in at most ``errors`` of the low ``top`` bits.

    ``first`` holds the borders of the trie nodes to start from, whose keys
    agree above bit ``top``. A node is a run of the sorted keys; a node pair
    holds the differing bits met so far and goes on to its child pairs while
    that number is within the budget.
    """
    ones: dict[int, np.ndarray] = {}

    def split(level: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if level not in ones:
            ones[level] = np.concatenate([[0], np.cumsum((keys >> np.uint64(level)) & np.uint64(1))]).astype(np.int64)
        return hi - (ones[level][hi] - ones[level][lo])

    lo, hi = first[:-1], first[1:]
    wide = hi - lo > 1
    lo, hi = lo[wide], hi[wide]
    stack = [(top - 1, lo, hi, lo, hi, np.zeros(len(lo), dtype=np.int8))]
    while stack:
        level, al, ah, bl, bh, spent = stack.pop()
        if level < 0:
            if len(al):
                yield al, bl
            continue
        if len(al) > _FRONTIER:
            half = len(al) // 2
            for part in (slice(None, half), slice(half, None)):
                stack.append((level, al[part], ah[part], bl[part], bh[part], spent[part]))
            continue
        am, bm = split(level, al, ah), split(level, bl, bh)
        same = (al == bl) & (ah == bh)
        out = []
        for x, y, more in ((0, 0, 0), (1, 1, 0), (0, 1, 1), (1, 0, 1)):
            xl, xh = (al, am) if x == 0 else (am, ah)
            yl, yh = (bl, bm) if y == 0 else (bm, bh)
            keep = (xh > xl) & (yh > yl) & (spent + more <= errors)
            if x == y:
                keep &= ~same | (xh - xl > 1)  # a node with itself needs two keys
            else:
                keep &= ~same | (x < y)
            out.append((xl[keep], xh[keep], yl[keep], yh[keep], spent[keep] + np.int8(more)))
        stack.append((level - 1, *(np.concatenate(c) for c in zip(*out))))


def _forest(group: np.ndarray, turned: np.ndarray, errors: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the trie self-join finds inside the groups, one per key that is not the first of its class."""
    order = np.lexsort((turned, group))
    group, turned = group[order], turned[order]
    fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (turned[1:] != turned[:-1])])
    group, turned = group[fresh], turned[fresh]
    borders = np.concatenate([np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])), [len(group)]])
    labels = np.arange(len(turned))
    for left, right in trie_pairs(turned, borders, 64 - width, errors):
        labels = lowest_labels(len(turned), left, right, labels)
    moved = np.flatnonzero(labels != np.arange(len(turned)))
    return turned[moved], turned[labels[moved]]


def near_links(prints: DataFrame, errors: int = 2, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``fp, other``: links that connect all fingerprints within ``errors`` (at most 2) differing bits.

    ``prints`` holds distinct non-null ``fp``. Three tries are used, each over
    the bits turned so that another third leads; a pair within two bits agrees
    in a whole third, so in one trie its two paths meet no error down to that
    depth. The nodes there are the groups that tasks get; a task goes through
    the rest of the trie. Groups of more than ``group_rows`` keys are dealt
    out as pairs of chunks. Of the pairs found in a task only a spanning forest
    is returned; no link between classes is lost.
    """
    if not 0 <= errors < len(WIDTHS):
        raise ValueError(f"errors must be 0 to {len(WIDTHS) - 1}")
    turns = []
    for block, width in enumerate(WIDTHS):
        by = sum(WIDTHS[:block])
        turned = F.col("fp") if by == 0 else F.shiftleft("fp", by).bitwiseOR(F.shiftrightunsigned("fp", 64 - by))
        turns.append(F.struct(F.lit(block).alias("block"), F.shiftrightunsigned(turned, 64 - width).alias("node"), turned.alias("turned")))
    keys = prints.select(F.explode(F.array(*turns)).alias("k")).select("k.*")
    large = (
        keys.groupBy("block", "node").count().where(F.col("count") > group_rows)
        .select("block", "node", F.ceil(F.col("count") / group_rows).cast("int").alias("chunks"))
    )
    chunk = F.pmod(F.xxhash64("turned"), F.col("chunks")).cast("int")
    dealt = (
        keys.join(large, ["block", "node"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("own", chunk)
        .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
        .select("block", "node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "turned")
    )
    spread = dealt.repartition("block", "node", "i", "j").sortWithinPartitions("block", "node", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            block, node, i, j, turned = cols
            new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in (block, node, i, j)], axis=0)])
            group = np.cumsum(new)
            for b, width in enumerate(WIDTHS):
                mine = block == b
                if mine.any():
                    by = np.uint64(sum(WIDTHS[:b]))
                    pair = _forest(group[mine], turned[mine].view(np.uint64), errors, width)
                    back = [x if by == 0 else (x >> by) | (x << (np.uint64(64) - by)) for x in pair]
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in back], ["fp", "other"])

        held: list[list[np.ndarray]] = []
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if sum(len(h[0]) for h in held) < _CHUNK:
                continue
            cols = [np.concatenate(c) for c in zip(*held)]
            last = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0))
            if len(last):
                cut = last[-1] + 1
                yield from links([c[:cut] for c in cols])
                cols = [c[cut:] for c in cols]
            held = [cols]
        if held and sum(len(h[0]) for h in held):
            yield from links([np.concatenate(c) for c in zip(*held)])

    return spread.mapInArrow(run, "fp long, other long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, errors: int = 2,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``id, fp, component_id`` of every row; the component is the smallest id its links reach.

    Rows with equal fingerprints are one class, folded before any shuffle of
    pairs, so copies cost nothing. Null texts have fingerprint 0 and are linked
    like any other. Null ids are kept; they are passed over when the smallest id
    is sought (null only if a component has no other). Repeated rows stay.
    Columns beside id and text are not read. No rows: no rows.
    """
    prints = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    classes = stored(prints.groupBy("fp").agg(F.min("id").alias("low")), "classes")
    found = components(near_links(classes.select("fp"), errors, group_rows), "fp", "other")
    rooted = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of_class = rooted.select("fp", "root").join(lowest, "root").select("fp", "component_id")
    return prints.join(of_class, "fp").select("id", "fp", "component_id")


def without_copies(docs: DataFrame, near: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is its component's in ``near`` (``id, component_id``), one row for an id; rows without id stay."""
    near = stored(near.select("id", "component_id"), "near")
    # narrow tables are written, so that Spark knows their size when it chooses whether texts are shuffled
    gone = stored(near.where(F.col("id") != F.col("component_id")).select(F.col("id").alias(id_col)).distinct(), "near-gone")
    repeated = stored(
        near.where("id = component_id").groupBy(F.col("id").alias(id_col)).count().where("count > 1").select(id_col), "near-repeated"
    )
    single = docs.join(gone.union(repeated), id_col, "left_anti")
    return single.unionByName(docs.join(repeated, id_col, "left_semi").dropDuplicates([id_col])).select(docs.columns)


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, errors: int = 2) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their group, one row for an id; rows without id stay."""
    return without_copies(docs, near_duplicates(docs, id_col, text_col, words, errors), id_col)


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all ``documents`` at 2 or fewer differing bits."""
    near = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return near.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
