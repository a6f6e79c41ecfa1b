"""CSV files of any size, read by many tasks.

Spark cuts a file into blocks at line ends, but a line end inside quotes ends no
record. Whether a line begins inside quotes follows from all lines before it, so
each line is first reduced to a function of two states (outside and inside
quotes). Functions are composed over chunks of lines, over the blocks of a file
and over the file, each in order; then every line knows its state and the number
of its record, and only records of several lines are brought together. Texts
are shuffled by chunk, so one file of any size is many tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.keys import row_key
from .ordinals import block_of, spread, with_ordinal
from .tables import csv_grid, has_content, named_columns, pick

Staged = Callable[[DataFrame, str], DataFrame]
#: Lines per chunk, as a power of two.
CHUNK_BITS = 12
# Whole fields with their separators, then a quoted field that is still open at the end.
_CLOSED = r'(?:"(?:[^"]++|"")*+"(?!"))?+(?:[^,"\r\n][^,\r\n]*+)?+'
STILL_OPEN = rf'^(?:{_CLOSED}(?:,|\r\n|\r|\n))*+"(?:[^"]++|"")*+\z'
_CHUNK = ["uri", "_block", "_chunk"]
_FUNCTION = ["end0", "end1", "n0", "n1"]


def csv_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of the files below ``path`` with their place: ``uri, _size, _block, _place, _line``.

    ``uri`` is spelled as in ``read_files``. Lines end at a line feed; a carriage return stays with its line. The bytes
    are kept as they are, but for a byte order mark at the beginning.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    uri = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    return lines.select(
        uri.alias("uri"), F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_place"),
        F.col("value").alias("_line"),
    )


def _latin(line: Column) -> Column:
    """One character for each byte: marks of CSV are the same in either encoding."""
    return F.decode(line.cast("binary"), "ISO-8859-1")


def _as_functions(lines: DataFrame) -> DataFrame:
    """Add the chunk of a line, the state after it for either state before it, and the records that begin in it."""
    line = F.col("_line")
    open_after = lambda text: F.when(line.contains('"'), text.rlike(STILL_OPEN).cast("int"))
    return lines.withColumn("_chunk", F.shiftright("_place", CHUNK_BITS)).withColumns({
        "end0": F.coalesce(open_after(_latin(line)), F.lit(0)),
        "end1": F.coalesce(open_after(F.concat(F.lit('"'), _latin(line))), F.lit(1)),
        "n0": F.lit(1).cast("long"), "n1": F.lit(0).cast("long"),
    })


def _composed(parts: DataFrame, group: list[str], order: str) -> DataFrame:
    """Add the state before each part (``before0``, ``before1``) and the records before it (``records0``, ``records1``).

    Either is given for both states at the start of the group. Parts that end in
    one state whatever came before fix the state; others keep or swap it.
    """
    window = Window.partitionBy(*group).orderBy(order)
    upto, ahead = window.rowsBetween(Window.unboundedPreceding, 0), window.rowsBetween(Window.unboundedPreceding, -1)
    swap = F.when((F.col("end0") == 1) & (F.col("end1") == 0), 1).otherwise(0)
    made = parts.withColumn("_swaps", F.sum(swap).over(upto))
    made = made.withColumn("_anchor", F.when(F.col("end0") == F.col("end1"), F.pmod(F.col("end0") + F.col("_swaps"), F.lit(2))))
    made = made.withColumns({
        "_fixed": F.last("_anchor", ignorenulls=True).over(ahead), "_flips": F.coalesce(F.last("_swaps").over(ahead), F.lit(0)),
    })
    before = lambda start: F.pmod(F.coalesce("_fixed", F.lit(start)) + F.col("_flips"), F.lit(2))
    made = made.withColumns({"before0": before(0), "before1": before(1)})
    begun = lambda state: F.when(F.col(state) == 0, F.col("n0")).otherwise(F.col("n1"))
    return made.withColumns({
        f"records{s}": F.coalesce(F.sum(begun(f"before{s}")).over(ahead), F.lit(0)) for s in (0, 1)
    }).drop("_swaps", "_anchor", "_fixed", "_flips")


def _after(state: str) -> Column:
    return F.when(F.col(state) == 0, F.col("end0")).otherwise(F.col("end1"))


def _whole(composed: DataFrame, group: list[str], order: str, *more: Column) -> DataFrame:
    """The function of each group from its composed parts."""
    begun = lambda s: F.when(F.col(f"before{s}") == 0, F.col("n0")).otherwise(F.col("n1"))
    return composed.groupBy(*group).agg(
        *[F.max_by(_after(f"before{s}"), F.col(order)).alias(f"end{s}") for s in (0, 1)],
        *[F.sum(begun(s)).alias(f"n{s}") for s in (0, 1)], *more,
    )


def _starts(functions: DataFrame) -> DataFrame:
    """For each chunk of lines: state and number of records before it, and whether its file is Latin-1 and ends in a line end."""
    line = F.col("_line")
    narrow = functions.select(
        *_CHUNK, "_place", "_size", *_FUNCTION, (F.octet_length(line) + 1).cast("long").alias("_bytes"), F.is_valid_utf8(line).alias("_valid")
    )
    facts = [F.sum("_bytes").alias("_bytes"), F.bool_and("_valid").alias("_valid"), F.max("_size").alias("_size")]
    chunks = _composed(_whole(_composed(narrow, _CHUNK, "_place"), _CHUNK, "_place", *facts), ["uri", "_block"], "_chunk")
    blocks = _composed(_whole(chunks, ["uri", "_block"], "_chunk"), ["uri"], "_block")
    # a file without a line end at its end has a byte less than its lines say, and the mark at its beginning was left out
    files = chunks.groupBy("uri").agg(
        (~F.bool_and("_valid")).alias("_is_latin"), (F.max("_size") - F.sum("_bytes")).isin(0, 3).alias("_ended")
    )
    block_state, block_records = F.col("before0"), F.col("records0")
    known = blocks.select("uri", "_block", block_state.alias("_state"), block_records.alias("_records")).join(files, "uri")
    own = lambda name: F.when(F.col("_state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    return chunks.join(known, ["uri", "_block"]).select(
        *_CHUNK, own("before").alias("_start"), (F.col("_records") + own("records")).alias("_begun"), "_is_latin", "_ended"
    )


def csv_records(lines: DataFrame, staged: Staged) -> DataFrame:
    """``uri, record, part, fields array<string>``: the records of files, from :func:`csv_lines`.

    Records are numbered from 0 within their file; where lines end in lone
    carriage returns, ``part`` numbers the records of a line. Fields are those of
    the reader of whole files, and so is the decoding, by all bytes of the file.
    A quote that is never closed takes the rest of its file into one record.
    ``staged(df, name)`` writes rows and reads them back: places of lines are
    those of one scan, and another scan may cut the files in another way.
    """
    functions = staged(_as_functions(lines), "csv_lines")
    placed = _composed(functions.drop("_size"), _CHUNK, "_place").join(_starts(functions), _CHUNK)
    own = lambda name: F.when(F.col("_start") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    text = F.when(F.col("_is_latin"), _latin(F.col("_line"))).otherwise(F.col("_line"))
    read = placed.withColumn("_before", own("before")).select(
        "uri", "_block", "_place", text.alias("_text"), "_ended", "_before", _after("_before").alias("_open"),
        (F.col("_begun") + own("records") - F.col("_before")).alias("record"),
    )
    single = (F.col("_before") == 0) & (F.col("_open") == 0)
    one = read.filter(single).select("uri", "record", F.concat("_text", F.lit("\n")).alias("_text"))
    place = F.struct("_block", "_place")
    several = read.filter(~single).groupBy("uri", "record").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_place", "_text"))).alias("_lines"),
        F.max_by("_open", place).alias("_open"), F.any_value("_ended").alias("_ended"),
    ).select(
        "uri", "record",
        F.concat(F.array_join("_lines._text", "\n"), F.when((F.col("_open") == 1) & ~F.col("_ended"), "").otherwise("\n")).alias("_text"),
    )
    return one.unionByName(several).select("uri", "record", F.posexplode(csv_grid(F.col("_text"))).alias("part", "fields"))


def csv_file_rows(records: DataFrame, files: DataFrame, staged: Staged) -> DataFrame:
    """Data rows of large files under their headers, for ``sheet_tables`` and ``sheet_cells``.

    ``files(uri, department_id, document_id)`` names the documents; files not in
    it are left out. The rules are those of ``csv_tables``: the first record is
    the header, unnamed columns and blank rows go, rows are cut or padded. As
    records serve headers and rows, ``staged`` writes them once.
    """
    keyed = staged(records.join(files.select("uri", "department_id", "document_id"), "uri").select(
        "department_id", "document_id", row_key(F.col("document_id"), "csv", F.lit(0)).alias("table_id"),
        "record", F.col("part").cast("long").alias("part"), "fields", block_of("record").alias("_block"),
    ), "csv_records")
    is_head = (F.col("record") == 0) & (F.col("part") == 0)
    heads = keyed.filter(is_head).select("table_id", F.col("fields").alias("_head"))
    heads = heads.withColumn("_named", named_columns(F.col("_head"))).filter(F.size("_named") > 0)
    body, named = keyed.filter(~is_head), F.col("_named")
    picked = pick(F.col("fields"), named)
    judged = F.when(F.size(named) == F.size("_head"), F.col("fields")).otherwise(picked)
    rows = body.join(spread(heads, body, "table_id"), ["table_id", "_block"]).filter(has_content(judged)).select(
        "department_id", "document_id", "table_id", "record", "part", pick(F.col("_head"), named).alias("headers"), picked.alias("_row")
    )
    return with_ordinal(rows, "table_id", "record", ["record", "part"], "_ordinal").select(
        "department_id", "document_id", "table_id", F.lit(0).cast("long").alias("table_index"), F.lit(None).cast("string").alias("sheet_name"),
        F.lit("csv_parser").alias("extraction_method"), "headers", (F.col("_ordinal") - 1).alias("source_row_number"), "_row",
    )
