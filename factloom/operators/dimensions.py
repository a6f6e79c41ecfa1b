"""Dimension tables: seeding, building from labels in use, merging, bridging."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..dictionaries import DIMENSION_COLUMNS, Dictionaries
from ..functions.keys import entity_key
from ..functions.text import (
    blank_to_null, header_without_years, header_year, infer_geo_type, is_measure_year_header, normalize_header, strip,
)
from ..functions.periods import FISCAL_START_MONTH
from .classify import classify_and_resolve, classify_headers, flat_periods, with_geography_key, with_scenario_of_period

UNRESOLVED = "unresolved"
COMPOSITE = "composite_dimensional"


def seed_dimensions(dictionaries: Dictionaries) -> dict[str, DataFrame]:
    """Dimension rows known before any document is read."""
    geographies = dictionaries.geographies.select(
        entity_key("geo", F.col("code")).alias("geography_id"), "geo_type", "code", "name_en", "name_fr"
    )
    scenarios = dictionaries.scenarios.select(
        entity_key("scenario", F.col("scenario_key")).alias("scenario_id"),
        F.col("scenario_key").alias("scenario_name"), F.lit(None).cast("string").alias("scenario_group"),
    )
    metrics = dictionaries.metrics.select(
        entity_key("metric", F.col("metric_key")).alias("metric_id"),
        F.col("name_en").alias("canonical_name"), F.col("name_fr").alias("canonical_name_fr"),
        F.col("family").alias("metric_family"), F.col("unit").alias("default_unit_id"),
        F.lit(None).cast("string").alias("description"), F.coalesce("is_additive", F.lit(False)).alias("is_additive"),
    )
    types, values = attribute_dimensions(dictionaries.attributes)
    departments = dictionaries.departments.select(
        "department_id", F.col("department_id").alias("department_code"),
        "department_name_en", "department_name_fr", F.lit(True).alias("active_flag"),
    )
    return {
        "dim_geography": geographies, "dim_scenario": scenarios, "dim_metric": metrics,
        "dim_attribute_type": types, "dim_attribute_value": values, "dim_department": departments,
    }


def attribute_dimensions(attributes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(type_key, type_name, values array<struct<key,en,fr>>)`` to types and values."""
    type_id = entity_key("attr_type", F.col("type_key"))
    types = attributes.select(
        type_id.alias("attribute_type_id"), F.col("type_name").alias("attribute_type_name"),
        F.lit(None).cast("string").alias("description"),
    )
    values = attributes.select("type_key", type_id.alias("attribute_type_id"), F.explode("values").alias("v"))
    values = values.select(
        entity_key("attr_val", F.concat_ws("|", "type_key", "v.key")).alias("attribute_value_id"),
        "attribute_type_id", F.col("v.en").alias("value_en"), F.col("v.fr").alias("value_fr"),
        F.col("v.key").alias("normalized_value"),
    )
    return types, values


def build_dim_time(labels: DataFrame, dictionaries: Dictionaries, text: str = "label_raw") -> DataFrame:
    """One row per period named by the texts in use; two spellings of a period give one row."""
    return _time_rows(classify_and_resolve(labels.select(text).distinct(), text, dictionaries))


def _time_rows(read: DataFrame) -> DataFrame:
    return (
        read.filter(F.col("mapping.time_id").isNotNull())
        .select(F.col("mapping.time_id").alias("time_id"), *flat_periods(read))
        .groupBy("time_id")
        .agg(
            F.min("time_type").alias("time_type"), F.min("label").alias("label"),
            F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
            F.lit(FISCAL_START_MONTH).cast("long").alias("fiscal_year_start_month"),
            F.bool_and("is_projection").alias("is_projection"),
        )
    )


def build_dim_metric(labels: DataFrame, dictionaries: Dictionaries, text: str = "label_raw") -> DataFrame:
    """Metrics named by the texts in use. Texts outside the dictionary are kept, marked by family."""
    return _metric_rows(classify_and_resolve(labels.select(text).distinct(), text, dictionaries), dictionaries, text)


def _metric_rows(read: DataFrame, dictionaries: Dictionaries, text: str) -> DataFrame:
    known = dictionaries.metrics.select(
        F.col("metric_key").alias("_key"), "name_en", "name_fr", "family", "unit", "is_additive"
    )
    named = read.filter(F.col("mapping.metric_id").isNotNull()).join(
        known, F.col("term.metric_key") == F.col("_key"), "left"
    )
    family = F.when(F.col(text).contains(" | "), COMPOSITE).otherwise(UNRESOLVED)
    return named.groupBy(F.col("mapping.metric_id").alias("metric_id")).agg(
        F.min(F.coalesce("name_en", strip(F.col(text)))).alias("canonical_name"),
        F.min("name_fr").alias("canonical_name_fr"),
        F.min(F.coalesce("family", family)).alias("metric_family"),
        F.min("unit").alias("default_unit_id"),
        F.lit(None).cast("string").alias("description"),
        F.coalesce(F.bool_or("is_additive"), F.lit(False)).alias("is_additive"),
    )


def build_dim_geography(labels: DataFrame, dictionaries: Dictionaries, text: str = "label_raw") -> DataFrame:
    """Areas named by the texts in use; a text outside the dictionary is its own code."""
    known = dictionaries.geographies.select(
        entity_key("geo", F.col("code")).alias("geography_id"), "code",
        F.col("geo_type").alias("_type"), F.col("name_en").alias("_en"), F.col("name_fr").alias("_fr"),
    )
    texts = labels.select(strip(F.col(text)).alias("_text")).filter("_text != ''").distinct()
    read = with_geography_key(texts, F.col("_text"), dictionaries, "geography_id")
    return (
        read.join(known, "geography_id", "left")
        .groupBy("geography_id")
        .agg(
            F.min(F.coalesce("_type", infer_geo_type(F.col("_text")))).alias("geo_type"),
            F.min(F.coalesce("code", "_text")).alias("code"),
            F.min(F.coalesce("_en", "_text")).alias("name_en"),
            F.min("_fr").alias("name_fr"),
        )
    )


def build_dim_scenario(labels: DataFrame, dictionaries: Dictionaries, text: str = "label_raw") -> DataFrame:
    """Scenarios named by the texts in use, on their own or with a period."""
    return _scenario_rows(classify_headers(labels.select(text).distinct(), text, dictionaries), dictionaries)


def _scenario_rows(classified: DataFrame, dictionaries: Dictionaries) -> DataFrame:
    read = with_scenario_of_period(classified, dictionaries, "_of_period")
    key = F.coalesce("_of_period", "term.scenario_key")
    return read.filter(key.isNotNull()).select(
        entity_key("scenario", key).alias("scenario_id"), key.alias("scenario_name")
    ).groupBy("scenario_id").agg(F.min("scenario_name").alias("scenario_name"))


def resolved_dimensions(
    facts: DataFrame, dictionaries: Dictionaries, once: Callable[[DataFrame, str], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The dimension rows of exactly the keys that ``facts`` carry, from the texts they were resolved from.

    Texts are made distinct before they are classified again; a key whose text
    is a column name with a year (``Population, 2016``) gets its two parts.
    Three dimensions are read from the classified texts; ``once`` writes these and reads them back.
    """
    column = F.col("column_label")
    texts = facts.select(F.explode(F.array(
        F.col("row_label"), column, header_year(column), F.when(is_measure_year_header(column), header_without_years(column))
    )).alias("label_raw")).filter("label_raw is not null").distinct()
    areas = facts.select(F.explode(F.array("area_label", "column_label")).alias("label_raw")).filter("label_raw is not null").distinct()
    read = classify_and_resolve(texts, "label_raw", dictionaries)
    read = read if once is None else once(read, "label_texts")
    built = {
        "time_id": _time_rows(read), "metric_id": _metric_rows(read, dictionaries, "label_raw"),
        "geography_id": build_dim_geography(areas, dictionaries), "scenario_id": _scenario_rows(read, dictionaries),
    }
    return {key: rows.join(facts.select(key).distinct(), key, "left_semi") for key, rows in built.items()}


def build_dim_document(documents: DataFrame, facts: DataFrame) -> DataFrame:
    """Documents that facts refer to, one row for an id: of departments that hold the same file, the first."""
    used = facts.select("document_id").distinct()
    columns = [
        "department_id", "title", "document_type", "language", "published_date",
        "fiscal_year_label", "source_url", "gcs_uri",
    ]
    named = documents.join(used, "document_id", "left_semi").select(
        "document_id", *[F.col(c) if c in documents.columns else F.lit(None).cast("string").alias(c) for c in columns]
    )
    return one_per_key(named, "document_id")


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row for each key, null keys left out: the least by its other columns from left to right, null last.

    A minimum, combined before the shuffle, so a key that fills the table is one row by then.
    """
    fields = [c for c in df.columns if c != key]
    if not fields:
        return df.filter(F.col(key).isNotNull()).distinct()
    row = F.struct(*[F.struct(F.col(c).isNull().alias("absent"), F.col(c).alias("v")).alias(c) for c in fields])
    least = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(row).alias("_row"))
    return least.select(*[F.col(c) if c == key else F.col(f"_row.{c}.v").alias(c) for c in df.columns])


def changed_rows(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The keys of ``incoming`` (one row each) that ``stored`` lacks, or holds with another value; a null brings nothing."""
    fields = [c for c in incoming.columns if c != key and c in stored.columns]
    old = one_per_key(stored.select(key, *fields), key).select(F.col(key).alias("_key"), *[F.col(c).alias(f"_old_{c}") for c in fields])
    other = [F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in fields]
    differs = F.col("_key").isNull()
    for o in other:
        differs = differs | o
    return incoming.join(old, F.col(key) == F.col("_key"), "left").filter(differs).select(key)


def upsert(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Merge rows by key: a new value replaces the stored one unless it is NULL; other rows stay.

    Each side counts once for a key, see ``one_per_key``, so repeated keys never multiply.
    """
    fields = [c for c in stored.columns if c != key]
    own, fresh = one_per_key(stored, key), one_per_key(incoming, key)
    old = own.select(key, F.struct(*fields).alias("_old"))
    new = fresh.select(key, F.struct(*[c for c in incoming.columns if c != key]).alias("_new"))
    brought = set(incoming.columns)
    return old.join(new, key, "full").select(
        key,
        *[
            (F.coalesce(f"_new.{c}", f"_old.{c}") if c in brought else F.col(f"_old.{c}")).alias(c)
            for c in fields
        ],
    )


def attribute_bridge(cells: DataFrame, facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dimension cells of a source row as attribute values of its observations.

    Returns the bridge ``(observation_id, attribute_value_id)`` and the values
    themselves. The join is on the source row, so no key is hot. A header is
    one of the names by then, and these are normalised as they stand.
    """
    name = strip(F.lower("header_raw"))
    value = blank_to_null(F.col("value_raw"))
    dims = cells.filter(name.isin(DIMENSION_COLUMNS) & value.isNotNull()).select(
        "table_id", "source_row_number", name.alias("type_key"),
        value.alias("value_en"), normalize_header(value).alias("normalized_value"),
    )
    dims = dims.withColumn(
        "attribute_value_id", entity_key("attr_val", F.concat_ws("|", "type_key", "normalized_value"))
    )
    bridge = facts.select("observation_id", "table_id", "source_row_number").join(
        dims.select("table_id", "source_row_number", "attribute_value_id"), ["table_id", "source_row_number"]
    ).select("observation_id", "attribute_value_id").distinct()
    values = dims.groupBy("attribute_value_id").agg(
        F.min(entity_key("attr_type", F.col("type_key"))).alias("attribute_type_id"),
        F.min("value_en").alias("value_en"), F.lit(None).cast("string").alias("value_fr"),
        F.min("normalized_value").alias("normalized_value"),
    )
    return bridge, values


def additive_totals(facts: DataFrame, dim_metric: DataFrame, by: list[str]) -> DataFrame:
    """Totals of the metrics that may be summed. Values are folded per metric before the join."""
    folded = facts.filter(F.col("value_numeric").isNotNull()).groupBy("metric_id", *by).agg(
        F.sum(F.col("value_numeric").cast("decimal(28,4)")).alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    additive = dim_metric.filter("is_additive").select("metric_id", "canonical_name")
    return folded.join(additive, "metric_id").groupBy("canonical_name", *by).agg(
        F.sum("_sum").cast("double").alias("total"), F.sum("_n").alias("observations")
    )
