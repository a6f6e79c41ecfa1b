"""Exact substring dedup: hash-compared suffix sort of sampled places.

A string of ``window`` bytes that stands twice has, in both places, the same
smallest hash among its ``gram``-byte pieces, at the same offset: its anchor. Only
anchors are kept (about one in 36 bytes), and of these only such as occur twice
go on, with the bytes around them that their windows span. The places of one
anchor are then sorted by what follows and by what comes before, in a mergesort
whose comparisons find the common extension by binary search over prefix
polynomial hashes; the extensions of neighbours, verified byte by byte, give the
classes of equal windows, and all but the first of a class are repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import python_batches, stored, texts_of
from factloom.llm.tokens import mixed, powers, prefix_sums

WINDOW, GRAM = 100, 32
#: Places of one anchor that a task sorts at once; more are dealt out as pairs of chunks.
GROUP_ROWS = 8192
_SORT_ROWS = 30_000
_PIECE = 1 << 20
_FIRST = -(1 << 63)
_LOW = np.uint64(0xFFFFFFFF)


def anchors(texts: list[bytes], window: int = WINDOW, gram: int = GRAM, piece: int = _PIECE) -> tuple[np.ndarray, ...]:
    """``text, hash, place, nearest, furthest`` of every anchor.

    Texts are worked through in pieces that overlap by a window less one byte,
    so that arrays over bytes stay small; an anchor whose windows lie in two
    pieces has a row for each.

    ``place`` counts from the start of the text; the anchor stands for the
    windows that begin ``nearest`` to ``furthest`` bytes before it. Each window
    of a text has one anchor, the last of its pieces with the smallest hash.
    """
    out, held, of, at, size = [_anchors([], window, gram)], [], [], [], 0

    def flush() -> None:
        text, hashes, place, *reach = _anchors(held, window, gram)
        out.append((np.array(of, dtype=np.int64)[text], hashes, place + np.array(at, dtype=np.int64)[text], *reach))
        held.clear(), of.clear(), at.clear()

    for k, text in enumerate(texts):
        for lo in range(0, max(0, len(text) - window + 1), piece):
            held.append(text[lo : lo + piece + window - 1])
            of.append(k)
            at.append(lo)
            size += len(held[-1])
            if size >= piece:
                flush()
                size = 0
    if held:
        flush()
    return tuple(np.concatenate(c) for c in zip(*out))


def _anchors(texts: list[bytes], window: int, gram: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    none = np.zeros(0, dtype=np.int64)
    if not len(sizes) or sizes.max() < window:
        return none, np.zeros(0, dtype=np.uint64), none, none, none
    prefix, n, span = prefix_sums(data), len(data) - gram + 1, window - gram + 1
    hashes = mixed((prefix[gram:] - prefix[:-gram]) * powers(len(prefix))[1][:n])
    ranked = (hashes & ~_LOW) | (_LOW - np.arange(n, dtype=np.uint64))
    padded = np.full(-(-n // span) * span + span, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = ranked
    rows = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(rows, axis=1).ravel()
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    counts = np.maximum(sizes - window + 1, 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    begin = np.arange(len(text)) + np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    at = (_LOW - (np.minimum(ahead[begin], behind[begin + span - 1]) & _LOW)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([new[1:], [len(at)]]) - 1
    return text[new], hashes[at[new]], at[new] - starts[text[new]], at[new] - begin[last], at[new] - begin[new]


def suffix_sort(group: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the fixed-width ``strings`` inside their groups (runs of equal ids), and common bytes with the one before.

    A bottom-up mergesort, all groups and runs at once: each string's place in
    the neighbouring run is found by binary search, each comparison by binary
    search for the longest common prefix over prefix hashes. The common bytes of
    neighbours are then counted in the bytes themselves; if any are out of
    order, hashes have collided and the bytes are sorted directly.
    """
    n, width = strings.shape
    sums = np.zeros((n, width + 1), dtype=np.uint64)
    np.cumsum((strings.astype(np.uint64) + np.uint64(1)) * powers(width + 1)[0][:width], axis=1, out=sums[:, 1:])

    def order_of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for each pair."""
        common, step = np.zeros(len(x), dtype=np.int64), 1 << (width.bit_length() - 1)
        while step:
            longer = np.minimum(common + step, width)
            common = np.where(sums[x, longer] == sums[y, longer], longer, common)
            step >>= 1
        at = np.minimum(common, width - 1)
        return np.where(common == width, 0, np.sign(strings[x, at].astype(np.int16) - strings[y, at]))

    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.concatenate([first, [n]]))
    base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
    local, order, run = np.arange(n) - base, np.arange(n), 1
    while run < sizes.max():
        here = np.flatnonzero(size > run)
        b, p, s = base[here], local[here], size[here]
        mine = p // run
        low = (mine ^ 1) * run
        right = (mine & 1) == 1
        lo, hi = np.minimum(low, s), np.minimum(low + run, s)
        rank = lo.copy()
        top = hi.copy()
        while (open_ := np.flatnonzero(rank < top)).size:
            mid = (rank[open_] + top[open_]) // 2
            sign = order_of(order[here[open_]], order[b[open_] + mid])
            after = (sign > 0) | ((sign == 0) & right[open_])
            rank[open_] = np.where(after, mid + 1, rank[open_])
            top[open_] = np.where(after, top[open_], mid)
        place = b + np.minimum(mine & ~1, mine) * run + (p - mine * run) + (rank - lo)
        moved = order.copy()
        moved[place] = order[here]
        order, run = moved, run * 2

    def common_bytes() -> tuple[np.ndarray, np.ndarray]:
        x, y = strings[order[:-1]], strings[order[1:]]
        differ = x != y
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        at, k = np.minimum(same, width - 1), np.arange(n - 1)
        inside = group[order[1:]] == group[order[:-1]]
        return np.where(inside, same, -1), ~inside | (same == width) | (x[k, at] < y[k, at])

    if n > 1:
        same, sorted_ = common_bytes()
        if not sorted_.all():
            order = np.array(sorted(range(n), key=lambda k: (group[k], strings[k].tobytes(), k)))
            same, _ = common_bytes()
    else:
        same = np.zeros(0, dtype=np.int64)
    return order, np.concatenate([[-1], same])[:n]


def repeats(
    group: np.ndarray, text: np.ndarray, place: np.ndarray, nearest: np.ndarray, furthest: np.ndarray, around: list[bytes], window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, start, end`` of the runs of windows that stand earlier, too.

    Rows are places of anchors, ordered by group, text and place; ``around``
    holds the bytes from the furthest window's start to the nearest one's end.
    """
    n, reach = len(group), int(furthest.max()) + 1
    after, before = np.zeros((n, window), dtype=np.uint8), np.zeros((n, reach), dtype=np.uint8)
    for k, (f, data) in enumerate(zip(furthest.tolist(), around)):
        raw = np.frombuffer(data, dtype=np.uint8)
        after[k, : len(raw) - f] = raw[f:]
        before[k, :f] = raw[:f][::-1]
    classes = []
    for strings in (after, before):
        order, common = suffix_sort(group, strings)
        classes.append((np.argsort(order), common))
    later = np.zeros((n, reach + 1), dtype=bool)
    for offset in range(reach):
        rows = np.flatnonzero((nearest <= offset) & (offset <= furthest))
        if len(rows) < 2:
            continue
        keys = [np.cumsum(common < max(1, need))[rank[rows]] for (rank, common), need in zip(classes, (window - offset, offset))]
        if not offset:
            keys[1] = group[rows]
        key = keys[0] * np.int64(n + 2) + keys[1]
        order = np.argsort(key, kind="stable")
        sorted_rows, sorted_key = rows[order], key[order]
        head = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]))
        lead = np.repeat(sorted_rows[head], np.diff(np.concatenate([head, [len(order)]])))
        later[sorted_rows, offset] = (text[sorted_rows] != text[lead]) | (place[sorted_rows] != place[lead])
    edges = np.diff(later.view(np.int8), axis=1, prepend=0)
    row, low = np.nonzero(edges == 1)
    high = np.nonzero(edges == -1)[1]  # one past the last offset; runs alternate, so the two lists go together
    return row, place[row] - high + 1, place[row] - low + window


def _batch(columns: dict[str, tuple[object, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


def _doubled(keyed: DataFrame, window: int, gram: int) -> DataFrame:
    """``k1, hash`` of anchors that occur more than once.

    An anchor that a batch holds twice is known to be double there: one of its
    rows goes to where its other places are counted, the rest are passed on by
    document, so a passage found everywhere does not gather in one task.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1 = batch.column(0).to_numpy()
            text, hashes, *_ = anchors(texts_of(batch.column(1)), window, gram)
            order = np.argsort(hashes, kind="stable")
            text, hashes = text[order], hashes[order]
            new = np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)]
            many = np.zeros(len(hashes), dtype=bool)
            many[:-1] = ~new[1:]
            kind = np.where(new, np.where(many, 1, 0), 2)
            own = new | np.concatenate([[True], text[1:] != text[:-1]])[: len(text)]  # a document needs an anchor once
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)[own]), pa.array(k1[text[own]]), pa.array(kind[own].astype(np.int8))], ["hash", "k1", "kind"]
            )

    found = keyed.select("k1", "text").mapInArrow(find, "hash long, k1 long, kind byte")
    spread = found.repartition(F.when(F.col("kind") == 2, F.col("k1")).otherwise(F.col("hash"))).sortWithinPartitions("hash")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int8)]

        def double(cols: list[np.ndarray]) -> pa.RecordBatch:
            hashes, k1, kind = cols
            new = np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)]
            group = np.cumsum(new) - 1
            places = np.bincount(group, np.where(kind == 0, 1, np.where(kind == 1, 2, 0)), int(group[-1]) + 1 if len(group) else 0)
            keep = (kind == 2) | (places[group] > 1)
            return pa.RecordBatch.from_arrays([pa.array(k1[keep]), pa.array(hashes[keep])], ["k1", "hash"])

        for batch in batches:
            cols = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns)]
            cut = int(np.searchsorted(cols[0], cols[0][-1])) if len(cols[0]) else 0
            if cut:
                yield double([c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
            if len(held[0]) > 1 << 16:  # a hash with very many rows: what is known of it goes on
                known = [held[0][:1], held[1][:1], np.array([1], dtype=np.int8)]
                if (held[2] != 2).sum() > 1:
                    yield pa.RecordBatch.from_arrays([pa.array(held[1]), pa.array(held[0])], ["k1", "hash"])
                    held = known
        if len(held[0]):
            yield double(held)

    return spread.mapInArrow(count, "k1 long, hash long")


def _places(keyed: DataFrame, doubled: DataFrame, window: int, gram: int) -> DataFrame:
    """Places of doubled anchors with the bytes around them, or (``around`` null) spans that are known to be repeats.

    Places of a batch with the same bytes around them are folded into the first
    of them; the windows of the others are repeats of its windows.
    """
    wanted = doubled.groupBy("k1").agg(F.collect_set("hash").alias("hashes"))  # anchors of one document

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, order = (batch.column(k).to_numpy() for k in range(3))
            texts = texts_of(batch.column(3))
            text, hashes, place, nearest, furthest = anchors(texts, window, gram)
            bounds, keep = np.searchsorted(text, np.arange(len(texts) + 1)), np.zeros(len(text), dtype=bool)
            for k, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
                keep[lo:hi] = np.isin(hashes[lo:hi].view(np.int64), batch.column(4)[k].values.to_numpy(zero_copy_only=False))
            text, hashes, place, nearest, furthest = (x[keep] for x in (text, hashes, place, nearest, furthest))
            by_text = np.lexsort((place, order[text]))
            seen: dict[tuple[bytes, int], tuple[int, int]] = {}
            around: list[bytes | None] = [None] * len(text)
            for r, o, p, lo, hi in zip(by_text.tolist(), order[text][by_text].tolist(), place[by_text].tolist(), nearest[by_text].tolist(), furthest[by_text].tolist()):
                data = texts[text[r]][p - hi : p - lo + window]
                if seen.setdefault((data, hi), (o, p)) == (o, p):
                    around[r] = data
            yield _batch({
                "hash": (hashes.view(np.int64), pa.int64()), "order": (order[text], pa.int64()), "k1": (k1[text], pa.int64()),
                "k2": (k2[text], pa.int32()), "place": (place, pa.int64()), "nearest": (nearest, pa.int32()),
                "furthest": (furthest, pa.int32()), "around": (around, pa.binary()),
            })

    joined = keyed.join(wanted, "k1").select("k1", "k2", "order", "text", "hashes")
    return joined.mapInArrow(cut, "hash long, order long, k1 long, k2 int, place long, nearest int, furthest int, around binary")


def _sorted_repeats(places: DataFrame, window: int, group_rows: int) -> DataFrame:
    """``k1, k2, start, end`` of the repeats among places with the same anchor."""
    large = places.groupBy("hash").count().where(F.col("count") > group_rows).select(
        "hash", F.ceil(F.col("count") / group_rows).cast("int").alias("chunks")
    )
    dealt = (
        places.join(stored(large, "large-anchors"), "hash", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("k1", "place"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
        .select("hash", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "order", "place", "k1", "k2", "nearest", "furthest", "around")
    )
    spread = dealt.repartition("hash", "i", "j").sortWithinPartitions("hash", "i", "j", "order", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def changes(table: pa.Table) -> np.ndarray:
            cols = [table.column(c).to_numpy() for c in ("hash", "i", "j")]
            return np.concatenate([[True], np.any([c[1:] != c[:-1] for c in cols], axis=0)])

        def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
            group = np.cumsum(changes(table))
            lone = np.bincount(group)[group] > 1
            table, group = table.filter(pa.array(lone)), group[lone]
            if table.num_rows:
                cols = [table.column(c).to_numpy() for c in ("order", "place", "nearest", "furthest")]
                row, start, end = repeats(group, *cols, table.column("around").to_pylist(), window)
                yield pa.RecordBatch.from_arrays(
                    [table.column("k1").combine_chunks().take(pa.array(row)), table.column("k2").combine_chunks().take(pa.array(row)), pa.array(start), pa.array(end)],
                    ["k1", "k2", "start", "end"],
                )

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= _SORT_ROWS:
                table = pa.Table.from_batches(held)
                cut = int(np.flatnonzero(changes(table))[-1])
                if cut:
                    yield from found(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield from found(pa.Table.from_batches(held))

    return spread.mapInArrow(run, "k1 long, k2 int, start long, end long")


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """``id, n_bytes, spans, kept`` of every row: the removed spans (merged) and the bytes that stay.

    A byte goes if a string of ``window`` bytes over it also starts earlier: in
    a document with a smaller id, or in the same one further left. Ids must be
    integers; a null id is smaller than any. Rows with the same id and text are
    one document and get the same result; rows with the same id and other texts
    are versions of one document, in which a string that starts at the same place
    is no repeat. Null texts are empty; texts shorter than the window lose
    nothing. Other columns are not read. No rows: no rows.
    """
    python_batches(docs.sparkSession, 4000, 16)
    keyed = docs.select(
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("k1"), F.hash(F.col(text_col), F.col(id_col)).alias("k2"), F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_FIRST)).alias("order"), F.col(text_col).alias("text"),
    )
    places = stored(_places(keyed, _doubled(keyed, window, gram), window, gram), "anchor-places")
    known = places.where("around is null").select("k1", "k2", (F.col("place") - F.col("furthest")).alias("start"), (F.col("place") - F.col("nearest") + window).alias("end"))
    spans = known.unionByName(_sorted_repeats(places.where("around is not null"), window, group_rows))
    of_doc = spans.groupBy("k1").agg(F.collect_set(F.struct("k2", "start", "end")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed, kept = texts_of(batch.column(2)), [], []
            for k2, text, found in zip(batch.column(1).to_pylist(), texts, batch.column(3)):
                merged: list[list[int]] = []
                if found.is_valid:
                    own, start, end = (found.values.field(k).to_numpy() for k in range(3))
                    for lo, hi in sorted(zip(start[own == k2].tolist(), end[own == k2].tolist())):
                        if merged and lo <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], hi)
                        else:
                            merged.append([lo, hi])
                removed.append([{"start": lo, "end": hi} for lo, hi in merged])
                cuts = [0, *(x for m in merged for x in m), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                ["id", "n_bytes", "spans", "kept"],
            )

    joined = keyed.select("k1", "k2", "id", "text").join(of_doc, "k1", "left").select("id", "k2", "text", "spans")
    return joined.mapInArrow(cut, "id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all ``documents`` lose of strings of 100 bytes that start earlier, too."""
    done = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return done.select(
        F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
