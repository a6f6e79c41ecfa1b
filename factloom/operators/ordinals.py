"""Row numbers inside groups of any size.

A plain window would put a whole group into one task. Here a group is cut into
blocks of consecutive row numbers; rows are numbered inside their block and the
block's offset is added. Offsets come from counts, which are aggregated before
they are shuffled, and are summed in two steps so that no window sees more than
``BLOCKS_PER_STRIP`` blocks or one row per strip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

ROWS_PER_BLOCK = 4096
BLOCKS_PER_STRIP = 4096


def block_of(row_number: Column | str, rows_per_block: int = ROWS_PER_BLOCK) -> Column:
    row_number = F.col(row_number) if isinstance(row_number, str) else row_number
    return F.floor(row_number / rows_per_block).cast("long")


def _before(window: Window, value: str) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def block_offsets(df: DataFrame, group: str) -> DataFrame:
    """``(group, _block, _offset)``: how many rows of the group lie before each block."""
    counts = df.groupBy(group, "_block").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_strip", F.floor(F.col("_block") / BLOCKS_PER_STRIP))
    strips = counts.groupBy(group, "_strip").agg(F.sum("_n").alias("_strip_n"))
    strips = strips.select(
        group, "_strip", _before(Window.partitionBy(group).orderBy("_strip"), "_strip_n").alias("_strip_offset")
    )
    inside = counts.select(
        group, "_strip", "_block",
        _before(Window.partitionBy(group, "_strip").orderBy("_block"), "_n").alias("_block_offset"),
    )
    return inside.join(strips, [group, "_strip"]).select(
        group, "_block", (F.col("_strip_offset") + F.col("_block_offset")).alias("_offset")
    )


def with_ordinal(
    df: DataFrame, group: str, row_number: str, order: list[str], out: str, first: int | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Add the 1-based position of each row in its group, ordered by ``order``.

    ``row_number`` is the leading column of ``order``. With ``first``, only the
    first so many rows of each group are kept, and blocks wholly beyond them
    are dropped before anything is sorted.
    """
    blocked = df.withColumn("_block", block_of(row_number, rows_per_block))
    offsets = block_offsets(blocked, group)
    if first is not None:
        offsets = offsets.filter(F.col("_offset") < first)
    within = F.row_number().over(Window.partitionBy(group, "_block").orderBy(*order))
    numbered = (
        blocked.join(offsets, [group, "_block"])
        .withColumn(out, (within + F.col("_offset")).cast("long"))
        .select(*df.columns, out)
    )
    return numbered if first is None else numbered.filter(F.col(out) <= first)


def spread(per_group: DataFrame, rows: DataFrame, group: str) -> DataFrame:
    """Repeat one row per group for each block that the group has in ``rows``.

    Joining on ``(group, _block)`` then cuts a hot group into many join keys,
    while a small group keeps one.
    """
    blocks = rows.select(group, "_block").distinct()
    return blocks.join(per_group, group)
