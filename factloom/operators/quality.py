"""Quality scores of observations and checks on whole layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.periods import MIN_PERIOD_SCORE, with_refusal
from ..schemas import LAYERS

MIN_CONFIDENCE = 0.8
MAX_PLAUSIBLE = 1e15


def large_number_text(value: Column) -> Column:
    """A number above the plausible range in the fewest digits: plain below 1e16, else ``1.5e+16``."""
    digits = [F.format_string(f"%.{n}e", value) for n in (14, 15, 16)]
    exact = F.coalesce(*[F.when(d.try_cast("double") == value, d) for d in digits])
    scientific = F.regexp_replace(exact, r"\.?0+e", "e")
    plain = F.regexp_replace(exact.try_cast("decimal(38,6)").cast("string"), r"(\.\d+?)0+$", "$1")
    infinite = F.when(value == float("inf"), "inf").when(value == float("-inf"), "-inf")
    return F.coalesce(infinite, F.when(F.abs(value) < 1e16, plain).otherwise(scientific))


QUALITY_COLUMNS = [
    "quality_confidence", "issue_codes", "issue_notes", "review_status", "reviewed_by", "reviewed_at",
]


def score_observations(facts: DataFrame, confidence: Column | None = None) -> DataFrame:
    """The quality record of each observation."""
    return with_scores(facts, confidence).select("observation_id", *QUALITY_COLUMNS)


def with_scores(facts: DataFrame, confidence: Column | None = None) -> DataFrame:
    """Add a confidence between 0 and 1, issue codes and notes to each observation.

    Penalties are subtracted in a fixed order, so results are equal to the last bit.
    """
    confidence = F.lit(None).cast("double") if confidence is None else confidence
    value = F.col("value_numeric")
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    no_value = value.isNull() & empty(F.col("value_text"))
    low = F.coalesce(confidence < MIN_CONFIDENCE, F.lit(False))
    implausible = F.coalesce(F.abs(value) > MAX_PLAUSIBLE, F.lit(False)) & ~F.coalesce(F.isnan(value), F.lit(False))
    # Condition, penalty, code, note.
    rules = [
        (empty(F.col("metric_id")), 0.3, "MISSING_METRIC", F.lit("No metric ID assigned")),
        (empty(F.col("time_id")), 0.2, "MISSING_TIME", F.lit("No time dimension assigned")),
        (low, 0.2, "LOW_METRIC_CONFIDENCE",
         F.format_string("Mapping confidence %.2f below threshold", confidence)),
        (no_value, 0.3, "MISSING_VALUE", F.lit("Neither numeric nor text value present")),
        (implausible, 0.2, "IMPLAUSIBLE_VALUE",
         F.concat(F.lit("Value "), large_number_text(value), F.lit(" exceeds plausibility threshold"))),
        (value.isNotNull() & empty(F.col("unit_raw")), 0.05, "MISSING_UNIT", None),
    ]
    score, codes, notes = F.lit(1.0), [], []
    for condition, penalty, code, note in rules:
        score = score - F.when(condition, penalty).otherwise(0.0)
        codes.append(F.when(condition, code))
        if note is not None:
            notes.append(F.when(condition, note))
    return facts.select(
        "*",
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("quality_confidence"),
        F.concat_ws(",", *codes).alias("issue_codes"),
        F.concat_ws("; ", *notes).alias("issue_notes"),
        F.lit("unreviewed").alias("review_status"),
        F.lit(None).cast("string").alias("reviewed_by"),
        F.lit(None).cast("timestamp").alias("reviewed_at"),
    )


def orphans(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Observations whose key is set but absent from the dimension."""
    return facts.filter(F.coalesce(F.col(key), F.lit("")) != "").join(dimension.select(key), key, "left_anti")


def orphan_report(facts: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """``(dimension_key, missing_keys, observations)``: facts are folded to their keys first, then compared."""
    keys = facts.select(
        F.explode(F.array(*[
            F.struct(F.lit(k).alias("dimension_key"), F.col(k).alias("key")) for k in dimensions
        ])).alias("e")
    ).select("e.*").filter(F.coalesce("key", F.lit("")) != "")
    used = keys.groupBy("dimension_key", "key").agg(F.count(F.lit(1)).alias("n"))
    known = None
    for name, dimension in dimensions.items():
        part = dimension.select(F.lit(name).alias("dimension_key"), F.col(name).alias("key"))
        known = part if known is None else known.unionByName(part)
    return (
        used.join(known, ["dimension_key", "key"], "left_anti")
        .groupBy("dimension_key")
        .agg(F.count(F.lit(1)).alias("missing_keys"), F.sum("n").alias("observations"))
    )


def constraint_report(layer: DataFrame, required: list[str], key: list[str]) -> DataFrame:
    """One row: NULLs per required column, and surplus rows of repeated keys."""
    nulls = [F.sum(F.col(f"_null_{c}")).alias(f"null_{c}") for c in required]
    per_key = layer.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in required]
    )
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), *nulls,
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_keys"),
    )


def null_rates(facts: DataFrame, columns: list[str], by: str = "department_id") -> DataFrame:
    """Share of missing or empty values per column."""
    missing = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    return facts.groupBy(by).agg(
        F.count(F.lit(1)).alias("observations"),
        *[(F.count_if(missing(c)) / F.count(F.lit(1))).alias(f"{c}_missing") for c in columns],
    )


def conflicting_units(facts: DataFrame, metric: str = "metric_id", unit: str = "unit_raw") -> DataFrame:
    """Metrics reported in more than one unit."""
    pairs = facts.filter(F.col(unit).isNotNull()).groupBy(metric, unit).agg(F.count(F.lit(1)).alias("n"))
    return (
        pairs.groupBy(metric).agg(F.count(F.lit(1)).alias("units"), F.sum("n").alias("observations"))
        .filter("units > 1")
    )


def refused_periods(texts: DataFrame, column: str, min_score: float = MIN_PERIOD_SCORE) -> DataFrame:
    """``(text, score, reason, occurrences)`` of every text in ``column`` that looks like a period and was refused.

    Texts are folded first, so each is looked at once, however often it occurs.
    """
    folded = texts.groupBy(F.col(column).alias("text")).agg(F.count(F.lit(1)).alias("occurrences"))
    judged = with_refusal(folded, F.col("text"), "_refusal", min_score)
    # a generator, as a filter would be pushed below the rules and run them twice
    found = judged.select("text", "occurrences", F.inline(F.array_compact(F.array("_refusal"))))
    return found.select("text", "score", "reason", "occurrences")


def layer_report(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows, required values that are missing and repeated keys of each layer, by its declared constraints."""
    parts = []
    for name, df in layers.items():
        spec = LAYERS[name]
        missing = [f"null_{c}" for c in spec.required]
        keyed = df.select(*{*spec.required, *spec.key})
        parts.append(constraint_report(keyed, spec.required, spec.key).select(
            F.lit(name).alias("layer"), "rows", sum((F.col(c) for c in missing), F.lit(0)).alias("missing"), "duplicate_keys"
        ))
    return reduce(DataFrame.unionByName, parts)
