"""Cells of source tables to observations.

One plan serves every table shape:

1. the headers of a table are classified and folded into one *spec* per table:
   its shape, the columns that matter, and the list of columns to emit;
2. cells are brought together per source row, keyed by (table, block of rows),
   so that one huge table is many keys - this is the only shuffle of the cells;
3. each row meets its spec under the same key, its label is classified, and its
   emitted columns are exploded into observations.

A row has at most as many cells as a table may have columns (500), so no group
is unbounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..dictionaries import LABEL_COLUMNS, Dictionaries
from ..functions.keys import entity_key, row_key
from ..functions.numeric import bare_number, parse_bare
from ..functions.text import (
    blank_to_null, header_without_years, header_year, is_measure_year_header, names_geo_id, strip,
)
from .candidates import DECIDING
from .classify import classify_and_resolve, classify_texts, with_geography_key
from .ordinals import block_of, spread, with_ordinal

# Column names looked for, in order of preference.
FINANCE_VALUE = ["value", "amount", "montant"]
LONG_VALUE = ["obs_value", "value"]
LONG_TIME = ["time_period", "ref_date"]
LONG_GEO = ["geography", "geo", "dguid"]
FINANCIAL_SIGNS = ["amount", "expenditure"]
FINANCIAL_VALUE = ["amount", "expenditure", "total"]
SURVEY_VALUE = ["score100", "score5"]

FACT_COLUMNS = [
    "observation_id", "department_id", "document_id", "table_id", "metric_id", "time_id",
    "geography_id", "scenario_id", "value_numeric", "value_text", "unit_raw", "scale_factor",
    "currency_code", "source_row_number", "source_column_number", "quality_score",
]

_EMISSION = (
    "struct<column_number:bigint,metric_id:string,time_id:string,geography_id:string,scenario_id:string,label:string>"
)


def headers_of(cells: DataFrame) -> DataFrame:
    """Distinct headers of each table, for cells that come without header records."""
    return cells.select(
        "department_id", "table_id", F.col("source_column_number").alias("column_number"), "header_raw"
    ).distinct()


def _first_named(candidates: list[str], name: Column) -> Column:
    """Aggregate: the column whose name comes first in ``candidates``; the leftmost one on a tie."""
    rank = F.array_position(F.array(*[F.lit(c) for c in candidates]), name)
    return F.min(F.when(rank > 0, F.struct(rank.alias("rank"), F.col("column_number").alias("n"))))["n"]


def _emission(time_id=None, geography_id=None, scenario_id=None, metric_id=None) -> Column:
    null = F.lit(None).cast("string")
    return F.struct(
        F.col("column_number"), metric_id if metric_id is not None else null,
        time_id if time_id is not None else null, geography_id if geography_id is not None else null,
        scenario_id if scenario_id is not None else null, F.col("header_raw"),
    ).cast(_EMISSION)


def table_specs(headers: DataFrame, dictionaries: Dictionaries) -> DataFrame:
    """One row per table: ``shape``, key columns and the emissions of each source row.

    ``headers(department_id, table_id, column_number, header_raw)``.
    """
    text = F.col("header_raw")
    known = headers.select("department_id", "table_id", "column_number", F.coalesce(text, F.lit("")).alias("header_raw"), *_kind_of_document(headers))
    measured = known.withColumn("_year_measure", is_measure_year_header(text)).withColumn(
        "_year_label", F.when(F.col("_year_measure"), header_without_years(text))
    )
    labelled = classify_texts(measured, {"header_raw": "_own", "_year_label": "_year"}, dictionaries).withColumn(
        "_year_metric", F.when(F.col("_year_measure"), F.when(F.col("_own.verdict.method").isin(DECIDING), F.col("_own.mapping.metric_id")).otherwise(F.col("_year.mapping.metric_id"))),
    )
    kind, own = F.col("_own.verdict.header_class"), F.col("_own.mapping")
    bare = F.regexp_replace("_name", "^@", "")
    is_time = kind.isin("time", "time_range")
    is_geo = kind == "geography"
    time_emission = _emission(time_id=own["time_id"], scenario_id=own["scenario_id"])
    named = labelled.withColumn("_name", strip(F.lower(text))).withColumn("_bare", bare)
    by_column = lambda condition, value: F.array_sort(F.collect_list(F.when(condition, value)))
    folded = named.groupBy("table_id").agg(
        F.first("department_id").alias("_department"),
        F.count_if(is_time).alias("_n_time"),
        F.count_if(is_geo).alias("_n_geo"),
        F.when(F.count("column_number") < F.count(F.lit(1)), "header_without_column")
        .when(F.count(F.lit(1)) > F.count_distinct("column_number"), "two_headers_of_a_column").alias("error"),
        _first_named(FINANCE_VALUE, F.col("_name")).alias("_finance_value"),
        _first_named(LONG_VALUE, F.col("_bare")).alias("_long_value"),
        _first_named(LONG_TIME, F.col("_bare")).alias("_long_time"),
        _first_named(LONG_GEO, F.col("_bare")).alias("_long_geo"),
        _first_named(FINANCIAL_SIGNS, F.col("_name")).alias("_financial_sign"),
        _first_named(FINANCIAL_VALUE, F.col("_name")).alias("_financial_value"),
        _first_named(SURVEY_VALUE, F.col("_name")).alias("_survey_value"),
        F.min(F.when(names_geo_id(text), F.col("column_number"))).alias("_geo_id_column"),
        by_column(F.col("_name").isin(LABEL_COLUMNS), F.col("column_number")).alias("label_columns"),
        by_column(is_time, time_emission).alias("_times"),
        by_column(is_geo, _emission(geography_id=own["geography_id"])).alias("_geos"),
        by_column(
            F.col("_year_measure"),
            _emission(time_id=entity_key("time", header_year(text)), metric_id=F.col("_year_metric")),
        ).alias("_years"),
    )
    department = F.col("_department")
    shape = (
        F.when(
            department == "statcan",
            F.when(F.col("_long_value").isNotNull() & F.col("_long_time").isNotNull(), "long")
            .when(F.size("_years") > 0, "census"),
        )
        .when(
            department == "tbs-sct",
            F.when(F.col("_financial_sign").isNotNull(), "financial").when(F.col("_survey_value").isNotNull(), "survey"),
        )
        .when(F.col("_finance_value").isNotNull(), "dimensional")
        .when((F.col("_n_geo") > F.col("_n_time")) & (F.col("_n_geo") >= 2), "geo_columns")
        .otherwise("time_columns")
    )
    one = lambda column: F.array(
        F.struct(column.cast("bigint"), *[F.lit(None).cast("string")] * 5).cast(_EMISSION)
    )
    value_column = F.col("_finance_value")
    times = F.filter("_times", lambda e: e["column_number"] != value_column)
    first_time = F.try_element_at(times, F.lit(1))
    value_emission = F.array(F.struct(
        value_column, F.lit(None).cast("string"), first_time["time_id"], F.lit(None).cast("string"),
        first_time["scenario_id"], first_time["label"],
    ).cast(_EMISSION))
    emissions = (
        F.when(F.col("shape") == "time_columns", F.col("_times"))
        .when(F.col("shape") == "geo_columns", F.col("_geos"))
        .when(F.col("shape") == "dimensional", F.concat(value_emission, times))
        .when(F.col("shape") == "census", F.col("_years"))
        .when(F.col("shape") == "long", one(F.col("_long_value")))
        .when(F.col("shape") == "financial", one(F.col("_financial_value")))
        .when(F.col("shape") == "survey", one(F.col("_survey_value")))
    )
    return folded.withColumn("shape", F.coalesce(shape, F.lit("none"))).select(
        "table_id", "shape",
        F.when(F.col("shape") == "long", F.col("_long_time")).alias("time_column"),
        F.when(F.col("shape") == "long", F.col("_long_geo"))
        .when(F.col("shape") == "census", F.col("_geo_id_column")).alias("geo_column"),
        "label_columns", emissions.alias("emissions"),
        F.col("_n_time").alias("time_columns"), F.col("_n_geo").alias("geo_columns"), "error",
    )


def source_rows(cells: DataFrame) -> DataFrame:
    """Cells of one source row as ``values map<column, text>``, keyed and laid out by (table, block).

    Row numbers come first among the keys: cells of a block are sorted by them, and
    table ids would all compare equal. A cell staged twice counts once. ``row_error`` says what is wrong with a row:
    cells without a place, or two values in one place.
    """
    filled = cells.select(
        "department_id", "document_id", "table_id", "source_row_number", *_kind_of_document(cells),
        F.col("source_column_number").cast("bigint").alias("_column"), blank_to_null(F.col("value_raw")).alias("_value"),
        _block().alias("_block"),
    )
    lost = F.col("source_row_number").isNull() | F.exists("_cells", lambda c: c["_column"].isNull())
    twice = F.size(F.array_distinct(F.transform("_cells", lambda c: c["_column"]))) < F.size("_cells")
    return (
        filled.repartition("table_id", "_block")
        .groupBy("source_row_number", "table_id", "_block", "department_id", "document_id", *_kind_of_document(cells))
        .agg(F.array_sort(F.collect_set(F.struct("_column", "_value"))).alias("_cells"))
        .withColumn("row_error", F.when(lost, "cell_without_place").when(twice, "two_values_in_a_cell"))
        .withColumn("values", F.when(F.col("row_error").isNull(), F.map_from_entries("_cells")))
        .drop("_cells")
    )


def _kind_of_document(df: DataFrame) -> list[str]:
    """Rules may ask for the type of the document, where it is known."""
    return [c for c in ("document_type",) if c in df.columns]


def _block() -> Column:
    return F.coalesce(block_of("source_row_number"), F.lit(-1))


def _value(column: Column) -> Column:
    return F.try_element_at("values", column.cast("bigint"))


def _row_text() -> Column:
    """The text of a row that has to be understood: its label, or its period in the long shape."""
    labels = F.array_compact(F.transform("label_columns", _value))
    composite = F.nullif(F.array_join(labels, " | "), F.lit(""))
    first = _value(F.lit(0))
    return (
        F.when(F.col("shape").isin("time_columns", "geo_columns"), first)
        .when(F.col("shape") == "dimensional", F.coalesce(composite, first))
        .when(F.col("shape") == "long", _value(F.col("time_column")))
    )


def _keeps_row() -> Column:
    """Whether the row can carry observations at all, from what its text was understood as."""
    names_metric = (F.col("verdict.header_class") != "junk") & F.col("mapping.metric_id").isNotNull()
    has_text = F.col("row_text").isNotNull()
    return (
        F.when(F.col("shape").isin("time_columns", "dimensional"), has_text & names_metric)
        .when(F.col("shape") == "geo_columns", has_text & F.col("mapping.time_id").isNotNull())
        .when(F.col("shape") == "long", has_text)
        .otherwise(True)
    )


def _emitted_values(finite_only: bool) -> Column:
    """Emissions of a row with their values, those without a usable value left out.

    Kept inside one array expression: a filter after the explode would be
    pushed down and repeat the number parsing for each of its uses.
    """
    shape = F.col("shape")
    emissions = F.when(_keeps_row(), F.col("emissions"))
    raw = F.transform(emissions, lambda e: F.struct(e.alias("e"), _value(e["column_number"]).alias("raw")))
    bare = F.transform(raw, lambda p: F.struct(p["e"].alias("e"), p["raw"].alias("raw"), bare_number(p["raw"]).alias("bare")))
    parsed = F.transform(
        bare, lambda p: F.struct(p["e"].alias("e"), p["raw"].alias("raw"), parse_bare(p["bare"], finite_only).alias("value_numeric"))
    )
    takes_text = shape.isin("time_columns", "long")
    good = F.filter(
        F.transform(parsed, lambda p: F.struct(
            p["e"].alias("e"), p["value_numeric"].alias("value_numeric"),
            F.when(takes_text & p["value_numeric"].isNull(), p["raw"]).alias("value_text"),
        )),
        lambda p: p["value_numeric"].isNotNull() | p["value_text"].isNotNull() | (shape == "long"),
    )
    none = F.array(F.struct(F.lit(None).cast(_EMISSION).alias("e"), F.lit(None).cast("double").alias("value_numeric"), F.lit(None).cast("string").alias("value_text")))
    return F.when(F.col("error").isNull(), good).otherwise(none)


def composite_labels(cells: DataFrame, label_columns: list[str] | None = None) -> DataFrame:
    """Label of each source row: values of the label columns in table order, else the first column."""
    wanted = [F.lit(c) for c in (LABEL_COLUMNS if label_columns is None else label_columns)]
    value = blank_to_null(F.col("value_raw"))
    is_label = strip(F.lower("header_raw")).isin(*wanted)
    parts = F.array_sort(F.collect_list(F.when(is_label & value.isNotNull(), F.struct("source_column_number", value.alias("v")))))
    return (
        cells.repartition("table_id", block_of("source_row_number"))
        .groupBy("table_id", block_of("source_row_number").alias("_block"), "source_row_number")
        .agg(
            F.array_join(F.transform(parts, lambda p: p["v"]), " | ").alias("_joined"),
            F.max(F.when(F.col("source_column_number") == 0, value)).alias("_first"),
        )
        .select("table_id", "source_row_number", F.coalesce(F.nullif("_joined", F.lit("")), "_first").alias("label"))
    )


Shape = Callable[[DataFrame], DataFrame]


def observations(
    cells: DataFrame, dictionaries: Dictionaries, headers: DataFrame | None = None,
    finite_only: bool = False, extra_shapes: dict[str, Shape] | None = None, errors: bool = False,
) -> DataFrame:
    """Observations of every table in ``cells``, in the layout of the fact table.

    ``shape`` and ``mapping_confidence`` (how sure the metric of a row label is)
    are extra columns, and so are the texts that the keys were resolved from:
    ``row_label``, ``column_label`` and ``area_label``. ``headers`` saves a pass over the cells when header
    records exist. With ``errors`` rows that cannot be read are not passed over in
    silence: each gives one row with the reason in ``error`` and no observation,
    see ``parted``; without it they give nothing.
    ``extra_shapes`` maps a department to a function from its cells to
    observations, for sources that need a rule of their own.
    """
    extra_shapes = extra_shapes or {}
    own = cells.filter(~F.col("department_id").isin(list(extra_shapes))) if extra_shapes else cells
    specs = table_specs(headers_of(own) if headers is None else headers, dictionaries)
    rows = source_rows(own)
    blocked = own.select("table_id", _block().alias("_block"))
    if errors:
        placed = rows.join(spread(specs.withColumn("_known", F.lit(True)), blocked, "table_id"), ["table_id", "_block"], "left")
        wrong = F.coalesce("error", "row_error", F.when(F.col("_known").isNull(), "no_headers"))
        placed = placed.withColumn("error", wrong).drop("_known", "row_error")
    else:
        # merged, as the folded rows look small enough to be broadcast, and all their work would follow the partitions of the specs
        placed = rows.filter("row_error is null").drop("row_error").join(
            spread(specs.filter("error is null"), blocked, "table_id").hint("merge"), ["table_id", "_block"]
        )
    read = classify_and_resolve(placed.withColumn("row_text", _row_text()), "row_text", dictionaries)
    geo_text = F.when(F.col("shape").isin("long", "census"), _value(F.col("geo_column")))
    located = with_geography_key(read, geo_text, dictionaries, "row_geography_id")
    valued = located.select(
        "department_id", "document_id", "table_id", "shape", "source_row_number",
        F.col("mapping.metric_id").alias("row_metric_id"), F.col("verdict.confidence").alias("row_confidence"),
        F.col("mapping.time_id").alias("row_time_id"), F.col("row_text").alias("row_label"), geo_text.alias("area_label"),
        "row_geography_id", "error", F.inline(_emitted_values(finite_only)),
    )
    shape, column = F.col("shape"), F.col("e.column_number")
    by_cell = ~shape.isin("long", "financial", "survey")
    observation_id = (
        F.when(by_cell, row_key(F.col("table_id"), F.col("source_row_number"), column))
        .when(shape == "survey", row_key(F.col("table_id"), "survey", F.col("source_row_number")))
        .otherwise(row_key(F.col("table_id"), F.col("source_row_number")))
    )
    none = F.lit("")
    facts = valued.select(
        observation_id.alias("observation_id"), "department_id", "document_id", "table_id",
        F.when(shape.isin("time_columns", "dimensional"), F.col("row_metric_id"))
        .when(shape == "census", F.coalesce("e.metric_id", none)).otherwise(none).alias("metric_id"),
        F.when(shape.isin("geo_columns", "long"), F.coalesce("row_time_id", none))
        .otherwise(F.coalesce("e.time_id", none)).alias("time_id"),
        F.coalesce("e.geography_id", "row_geography_id").alias("geography_id"),
        F.col("e.scenario_id").alias("scenario_id"),
        "value_numeric", "value_text",
        F.lit(None).cast("string").alias("unit_raw"), F.lit(1.0).alias("scale_factor"),
        F.lit(None).cast("string").alias("currency_code"),
        F.col("source_row_number").cast("long").alias("source_row_number"),
        F.when(by_cell, column).alias("source_column_number"),
        F.lit(None).cast("double").alias("quality_score"), "shape",
        F.when(shape.isin("time_columns", "dimensional"), F.col("row_confidence")).alias("mapping_confidence"),
        "row_label", F.col("e.label").alias("column_label"), "area_label", "error",
    )
    facts = facts.withColumn("observation_id", F.when(F.col("error").isNull(), F.col("observation_id"))) if errors else facts.drop("error")
    for department, make in extra_shapes.items():
        made = make(cells.filter(F.col("department_id") == department))
        facts = facts.unionByName(made.withColumn("shape", F.lit(department)), allowMissingColumns=True)
    return facts


def parted(found: DataFrame, once: Callable[[DataFrame, str], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Observations of good tables, and ``department_id, document_id, table_id, error`` of bad ones, from rows with ``error``.

    One row that cannot be read makes its whole table a bad one, as half a table
    would pass for all of it; other tables keep their observations. The reason
    is the first by name. Reasons are folded before the shuffle, so a table of
    bad rows only is one row by then. ``once`` writes the bad tables and reads
    them back: by their size Spark need not shuffle the observations to leave them out.
    """
    bad = found.filter("error is not null").groupBy("department_id", "document_id", "table_id").agg(F.min("error").alias("error"))
    bad = bad if once is None else once(bad, "bad_tables")
    good = found.filter("error is null").join(bad.select("table_id"), "table_id", "left_anti")
    return good.drop("error"), bad


def _source_order() -> list:
    return ["source_row_number", F.coalesce("source_column_number", F.lit(0)), "observation_id"]


def capped(facts: DataFrame, limit: int | None = None) -> DataFrame:
    """All observations, or the first ``limit`` of each table, in source order."""
    if limit is None:
        return facts
    return with_ordinal(facts, "table_id", "source_row_number", _source_order(), "_ordinal", first=limit).drop("_ordinal")


def beyond_cap(facts: DataFrame, limit: int) -> DataFrame:
    """Reject records of the observations that ``capped`` leaves out."""
    numbered = with_ordinal(facts, "table_id", "source_row_number", _source_order(), "_ordinal").filter(F.col("_ordinal") > limit)
    return numbered.select(
        F.lit("fact_observation").alias("layer"), F.col("observation_id").alias("record_id"), "document_id", "table_id",
        F.lit("beyond_observation_limit").alias("reason"),
    )
