"""Header classification and resolution to dimension keys.

Both are map-side: the dictionary is one small look-up table joined on the
normalised text, and the rest is one chain of expressions. ``classify_texts``
does this for distinct texts only and hands the results back to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..dictionaries import UNIT_COLUMNS, UNIT_PATTERN, VALUE_COLUMNS, Dictionaries
from ..functions.keys import entity_key
from ..functions.periods import PERIOD_FIELDS, with_period
from ..functions.text import dimension_name, normalize_header, sql_list, sql_text
from ..session import compiled

# Rules in order as (condition, class, confidence, method, hint).
def _rules(junk: str) -> list[tuple[str, str, float, str, str]]:
    return [
        ("normalized = ''", "junk", 1.0, "empty", "NULL"),
        (f"normalized RLIKE {sql_text(junk)}", "junk", 1.0, "junk_pattern", "NULL"),
        (f"normalized IN {sql_list(VALUE_COLUMNS)}", "metric", 0.9, "statcan_value_column", "'observation_value'"),
        (f"normalized IN {sql_list(UNIT_COLUMNS)}", "unit", 0.95, "statcan_unit_column", "NULL"),
        ("period.time_type = 'range'", "time_range", 0.95, "time_parser", "period.scenario_hint"),
        ("period IS NOT NULL", "time", 0.95, "time_parser", "period.scenario_hint"),
        ("term.geo_code IS NOT NULL", "geography", 0.95, "geo_dictionary", "NULL"),
        ("normalized = '@geography'", "geography", 0.95, "statcan_geo_attribute", "NULL"),
        ("term.scenario_key IS NOT NULL", "scenario", 0.95, "scenario_dictionary", "term.scenario_key"),
        ("normalized LIKE '@_%'", "attribute", 0.8, "statcan_dimension_attribute", "NULL"),
        ("term.metric_key IS NOT NULL", "metric", 0.9, "metric_dictionary", "term.metric_key"),
        (f"normalized RLIKE {sql_text(UNIT_PATTERN)}", "unit", 0.9, "unit_pattern", "NULL"),
        ("true", "metric", 0.3, "fallback", "NULL"),
    ]


def _verdict(junk: str) -> Column:
    cases = " ".join(
        f"WHEN {condition} THEN named_struct('header_class', '{kind}', 'confidence', {confidence}D, "
        f"'method', '{method}', 'hint', CAST({hint} AS string))"
        for condition, kind, confidence, method, hint in _rules(junk)
    )
    return F.expr(f"CASE {cases} END")


def classify_headers(df: DataFrame, header: str, dictionaries: Dictionaries) -> DataFrame:
    """Add ``normalized``, ``period``, ``term`` and ``verdict`` for the text in ``header``.

    The first rule that applies decides: empty, junk, value column, unit
    column, period, geography, scenario, attribute, metric, unit text; any
    other text is taken for a metric with low confidence.
    """
    compiled(df.sparkSession)
    kept = df.columns
    terms = dictionaries.terms.select(
        F.col("term").alias("_term"),
        F.struct("geo_code", "geo_type", "scenario_key", "metric_key").alias("term"),
    )
    staged = with_period(df.withColumn("normalized", normalize_header(F.col(header))), F.col(header), "period")
    staged = staged.join(terms, F.col("normalized") == F.col("_term"), "left")
    return staged.select(*kept, "normalized", "period", "term", _verdict(dictionaries.junk).alias("verdict"))


def with_scenario_of_period(df: DataFrame, dictionaries: Dictionaries, out: str) -> DataFrame:
    """Scenario key of the scenario word in ``period``, through the scenario spellings."""
    words = dictionaries.terms.filter("scenario_key is not null").select(
        F.col("term").alias("_word_term"), F.col("scenario_key").alias("_word_key")
    )
    hint = F.col("period.scenario_hint")
    return df.join(words, hint == F.col("_word_term"), "left").withColumn(
        out, F.coalesce("_word_key", hint)
    ).drop("_word_term", "_word_key")


def resolve_headers(classified: DataFrame, dictionaries: Dictionaries) -> DataFrame:
    """Add ``mapping``: the dimension keys that a classified text stands for."""
    kept = classified.columns
    staged = with_scenario_of_period(classified, dictionaries, "_period_scenario")
    kind = F.col("verdict.header_class")
    text = F.col("normalized")
    is_time = kind.isin("time", "time_range")
    mapping = F.struct(
        F.when(kind == "metric", entity_key("metric", F.coalesce("term.metric_key", text))).alias("metric_id"),
        F.when(is_time, entity_key("time", F.col("period.label"))).alias("time_id"),
        F.when(kind == "geography", entity_key("geo", F.coalesce("term.geo_code", text))).alias("geography_id"),
        F.when(is_time & F.col("_period_scenario").isNotNull(), entity_key("scenario", F.col("_period_scenario")))
        .when(kind == "scenario", entity_key("scenario", F.coalesce("term.scenario_key", text)))
        .alias("scenario_id"),
        F.when(kind == "attribute", entity_key("attr_type", dimension_name(text))).alias("attribute_type_id"),
        (kind == "junk").alias("is_junk"),
    )
    return staged.select(*kept, mapping.alias("mapping"))


def classify_and_resolve(df: DataFrame, header: str, dictionaries: Dictionaries) -> DataFrame:
    """Both steps; where ``dictionaries`` carries decisions and ``df`` says the department, they come first."""
    found = resolve_headers(classify_headers(df, header, dictionaries), dictionaries)
    return found if dictionaries.decided is None or "department_id" not in df.columns else with_decisions(found, dictionaries.decided)


SALTS = 16
#: Rows from which on a text is dealt out over the salts.
HOT_ROWS = 50_000


def classify_texts(df: DataFrame, texts: dict[str, str], dictionaries: Dictionaries, salts: int = SALTS, hot: int = HOT_ROWS) -> DataFrame:
    """Add for each text column of ``texts`` a struct of ``verdict`` and ``mapping``, each distinct text classified once.

    All columns share one table of texts, folded before it is shuffled; where
    decisions hold, texts of different departments and document types are kept
    apart. Results go back to the rows by text and, for a text of ``hot`` rows or
    more, by one of ``salts`` numbers, so that a text of a third of all rows is
    many keys; only such texts are multiplied. They are at most one for ``hot``
    texts of the rows, few enough to be sent to every task. NULL counts as the
    empty text. Meant for narrow rows: a wide row is better served by
    ``classify_and_resolve``, which does not move it.
    """
    scope = [c for c in ("department_id", "document_type") if dictionaries.decided is not None and c in df.columns]
    own = [F.col(c).alias(f"_in_{c}") for c in scope]
    added = ["_spelled", *[f"_in_{c}" for c in scope]]
    each = F.explode(F.array_distinct(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in texts]))).alias("_spelled")
    folded = df.select(*scope, each).groupBy(*scope, "_spelled").agg((F.count(F.lit(1)) >= hot).alias("_hot"))
    often = F.broadcast(folded.filter("_hot").select(*own, "_spelled", "_hot"))
    known = classify_and_resolve(folded, "_spelled", dictionaries).select(
        *own, "_spelled", F.struct("verdict", "mapping").alias("_known"),
        F.explode(F.sequence(F.lit(0), F.when(F.col("_hot"), salts - 1).otherwise(0))).alias("_salt"),
    )
    found = df
    for text, out in texts.items():
        same = F.coalesce(F.col(text), F.lit("")) == F.col("_spelled")
        for c in scope:
            same &= F.col(c).eqNullSafe(F.col(f"_in_{c}"))
        dealt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")).otherwise(0)
        found = found.join(often, same, "left").withColumn("_dealt", dealt).drop("_hot", *added)
        found = found.join(known, same & (F.col("_dealt") == F.col("_salt")), "left").drop("_dealt", "_salt", *added).withColumnRenamed("_known", out)
    return found


#: The class that a text has once an entity of a type was chosen for it.
DECIDED_CLASS = {"metric": "metric", "time": "time", "geography": "geography", "scenario": "scenario", "attribute_type": "attribute"}


def with_decisions(resolved: DataFrame, decided: DataFrame) -> DataFrame:
    """Replace ``verdict`` and ``mapping`` where a rule or a review decides a text.

    ``decided(normalized, options)`` has a row for a text and, best first, what
    was decided for which department and document type (null: any); see
    ``candidates.decisions_by_text``. It is one look-up by the text. An option
    without an entity is a refusal: the text then stands for nothing.
    """
    kept = resolved.columns
    kind = F.col("document_type") if "document_type" in kept else F.lit(None).cast("string")
    table = decided.select(F.col("normalized").alias("_text"), F.col("options").alias("_options"))
    fits = lambda o: (
        (o["department_id"].isNull() | (o["department_id"] == F.col("department_id")))
        & (o["document_type"].isNull() | F.coalesce(o["document_type"] == kind, F.lit(False)))
    )
    joined = resolved.join(table, F.col("normalized") == F.col("_text"), "left").withColumn("_first", F.get(F.filter("_options", fits), 0))
    chosen = F.col("_first.entity_type")
    header_class = F.lit("junk")
    for entity, name in DECIDED_CLASS.items():
        header_class = F.when((chosen == entity) & F.col("_first.entity_id").isNotNull(), name).otherwise(header_class)
    verdict = F.struct(
        header_class.alias("header_class"), F.lit(1.0).alias("confidence"), F.col("_first.method").alias("method"), F.lit(None).cast("string").alias("hint"),
    )
    keys = {"metric_id": "metric", "time_id": "time", "geography_id": "geography", "scenario_id": "scenario", "attribute_type_id": "attribute_type"}
    mapping = F.struct(*[F.when(chosen == e, F.col("_first.entity_id")).alias(k) for k, e in keys.items()], F.col("_first.entity_id").isNull().alias("is_junk"))
    there = F.col("_first").isNotNull()
    made = {"verdict": F.when(there, verdict).otherwise(F.col("verdict")), "mapping": F.when(there, mapping).otherwise(F.col("mapping"))}
    return joined.select(*[made[c].alias(c) if c in made else F.col(c) for c in kept])


def with_geography_key(df: DataFrame, source: Column, dictionaries: Dictionaries, out: str) -> DataFrame:
    """Key of a text known to name an area: by dictionary, else from the text itself."""
    terms = dictionaries.terms.filter("geo_code is not null").select(
        F.col("term").alias("_geo_term"), F.col("geo_code").alias("_geo_code")
    )
    staged = df.withColumn("_geo_text", F.when(source.isNotNull(), normalize_header(source)))
    return (
        staged.join(terms, F.col("_geo_text") == F.col("_geo_term"), "left")
        .withColumn(out, entity_key("geo", F.coalesce("_geo_code", "_geo_text")))
        .drop("_geo_text", "_geo_term", "_geo_code")
    )


def flat_periods(parsed: DataFrame, period: str = "period") -> list[Column]:
    """The fields of a period struct as columns."""
    return [F.col(f"{period}.{name}").alias(name) for name in PERIOD_FIELDS]
