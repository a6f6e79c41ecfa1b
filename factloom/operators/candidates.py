"""Mapping candidates of headers, their ranking, review and quality counts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..dictionaries import Dictionaries
from ..functions.keys import entity_key
from ..functions.text import normalize_header
from .classify import classify_and_resolve

AUTO_APPROVE = 0.8
MIN_SCORE = 0.5
MAX_EDITS = 2
#: Letters up to which a term is indexed by what remains of it when letters are left out.
SHORT_TERM = 20

# Where a candidate comes from, best first.
PRIORITY = [
    "exact_rule", "scoped_rule", "time_parser", "geo_dictionary", "statcan_geo_attribute",
    "scenario_dictionary", "metric_dictionary", "statcan_value_column", "statcan_dimension_attribute",
    "fuzzy", "fallback", "manual",
]
CANDIDATE_COLUMNS = [
    "header_id", "canonical_entity_type", "canonical_entity_id", "candidate_method", "candidate_score",
]


def direct_candidates(resolved: DataFrame) -> DataFrame:
    """Candidates from the classifier: one per key that a header resolves to.

    Input: resolved headers with ``header_id``.
    """
    kinds = {
        "metric": "metric_id", "time": "time_id", "geography": "geography_id",
        "scenario": "scenario_id", "attribute_type": "attribute_type_id",
    }
    entries = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(f"mapping.{key}").alias("id")) for kind, key in kinds.items()
    ])
    return resolved.select("header_id", "verdict", F.explode(entries).alias("e")).filter("e.id is not null").select(
        "header_id", F.col("e.kind").alias("canonical_entity_type"), F.col("e.id").alias("canonical_entity_id"),
        F.col("verdict.method").alias("candidate_method"), F.col("verdict.confidence").alias("candidate_score"),
    )


def _left_out(text: Column, most: int) -> Column:
    """All strings that remain when up to ``most`` letters are left out."""
    without = lambda s: F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))),
        lambda n: F.concat(F.substr(s, F.lit(1), n - 1), F.substr(s, n + 1)),
    )
    found = F.array(text)
    for _ in range(most):
        found = F.array_distinct(F.concat(found, F.flatten(F.transform(found, without))))
    return found


def _pieces(length: Column, max_edits: int) -> Column:
    """``(number, start, size)`` of the ``max_edits + 1`` pieces that a term of this length is cut into."""
    numbers = F.sequence(F.lit(0), F.lit(max_edits))
    edge = lambda n: F.floor(n * length / (max_edits + 1)).cast("int")
    return F.transform(numbers, lambda n: F.struct(n.alias("number"), edge(n).alias("start"), (edge(n + 1) - edge(n)).alias("size")))


def near_terms(texts: DataFrame, terms: DataFrame, max_edits: int = MAX_EDITS) -> DataFrame:
    """All pairs ``(text, term, edits)`` within ``max_edits`` edits, by equality joins on hashed keys.

    Two strings that near share a string left when each loses up to
    ``max_edits`` letters, so short terms are joined on those. Their number grows
    with a power of the length; a term of more than ``SHORT_TERM`` letters is cut
    into ``max_edits + 1`` pieces instead, one of which stands unchanged in the
    text, at most ``max_edits`` letters from its place. Either way no pair is
    missed, and the exact distance decides. NULL is near nothing; texts and terms
    are folded first, so a pair comes out once.
    """
    text, term = F.col("text"), F.col("term")
    texts = texts.select("text").distinct().filter(text.isNotNull())
    terms = terms.select("term").distinct().filter(term.isNotNull())
    hashed = lambda keys, *more: F.explode(F.array_distinct(F.transform(keys, lambda k: F.xxhash64(k, *more))))
    left_out = lambda df, c: df.select(c, hashed(_left_out(F.col(c), max_edits)).alias("_key"))
    short = left_out(texts.filter(F.length(text) <= SHORT_TERM + max_edits), "text").join(
        left_out(terms.filter(F.length(term) <= SHORT_TERM), "term"), "_key"
    )
    cut = lambda p: F.xxhash64(F.length(term), p["number"], F.substr(term, p["start"] + 1, p["size"]))
    long_terms = terms.filter(F.length(term) > SHORT_TERM).select(
        "term", F.explode(F.array_distinct(F.transform(_pieces(F.length(term), max_edits), cut))).alias("_key")
    )
    lengths = F.sequence(F.greatest(F.length(text) - max_edits, F.lit(SHORT_TERM + 1)), F.length(text) + max_edits)
    shifts = F.sequence(F.lit(-max_edits), F.lit(max_edits))
    seen = lambda size, p: F.transform(
        F.filter(shifts, lambda d: (p["start"] + d).between(F.lit(0), F.length(text) - p["size"])),
        lambda d: F.xxhash64(size, p["number"], F.substr(text, p["start"] + d + 1, p["size"])),
    )
    keys = F.flatten(F.transform(lengths, lambda size: F.flatten(F.transform(_pieces(size, max_edits), lambda p: seen(size, p)))))
    long_texts = texts.filter(F.length(text) > SHORT_TERM - max_edits).select("text", F.explode(F.array_distinct(keys)).alias("_key"))
    pairs = short.unionByName(long_texts.join(long_terms, "_key")).select("text", "term").distinct()
    return pairs.withColumn("edits", F.levenshtein(text, term, max_edits)).filter("edits >= 0")


def fuzzy_candidates(resolved: DataFrame, dictionaries: Dictionaries, max_edits: int = MAX_EDITS) -> DataFrame:
    """Dictionary metrics within a few edits of a header text that nothing else matched.

    Texts are compared once each (see :func:`near_terms`), and headers are
    joined back on the text afterwards.
    """
    unresolved = resolved.filter(F.col("verdict.method") == "fallback").select("header_id", "normalized")
    terms = dictionaries.terms.filter("metric_key is not null").select("term", "metric_key")
    longest = F.greatest(F.length("text"), F.length("term"))
    pairs = (
        near_terms(unresolved.select(F.col("normalized").alias("text")), terms, max_edits).join(terms, "term")
        .groupBy(F.col("text").alias("normalized"), "metric_key").agg(F.max(1 - F.col("edits") / longest).alias("candidate_score"))
        .filter(F.col("candidate_score") >= MIN_SCORE)
    )
    return unresolved.join(pairs, "normalized").select(
        "header_id", F.lit("metric").alias("canonical_entity_type"),
        entity_key("metric", F.col("metric_key")).alias("canonical_entity_id"),
        F.lit("fuzzy").alias("candidate_method"), "candidate_score",
    )


def scoped_candidates(headers: DataFrame, rules: DataFrame) -> DataFrame:
    """Candidates from mapping rules ``(normalized, department_id, document_type, entity_type, entity_id)``.

    A rule without department is exact for all; one with a department (and,
    where given, a document type) holds only there.
    """
    scope = rules.select(
        "normalized", F.col("department_id").alias("_department"), F.col("document_type").alias("_type"),
        "entity_type", "entity_id",
    )
    fits = (F.col("_department").isNull() | (F.col("_department") == F.col("department_id"))) & (
        F.col("_type").isNull() | (F.col("_type") == F.col("document_type"))
    )
    return headers.join(scope, "normalized").filter(fits).select(
        "header_id", F.col("entity_type").alias("canonical_entity_type"),
        F.col("entity_id").alias("canonical_entity_id"),
        F.when(F.col("_department").isNull(), "exact_rule").otherwise("scoped_rule").alias("candidate_method"),
        F.lit(1.0).alias("candidate_score"),
    )


def mapping_candidates(resolved: DataFrame, dictionaries: Dictionaries, *others: DataFrame) -> DataFrame:
    """All candidates above the minimum score, approved on their own when the score is high enough.

    A resolution by fallback stays in the list whatever its score, so that no header is lost to review.
    """
    parts = [direct_candidates(resolved), fuzzy_candidates(resolved, dictionaries), *others]
    together = reduce(DataFrame.unionByName, parts)
    return together.filter(
        (F.col("candidate_score") >= MIN_SCORE) | (F.col("candidate_method") == "fallback")
    ).withColumn("approved_flag", F.when(F.col("candidate_score") >= AUTO_APPROVE, True))


def header_candidates(headers: DataFrame, dictionaries: Dictionaries, once: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``mapping_candidates`` of ``headers(header_id, header_raw)``, each distinct text classified and compared once.

    ``once`` writes the classified texts and their candidates and reads them back: the first are used
    several times, and the size of the second decides how they are joined with the headers. A text
    without candidates, as the empty one, gives no row.
    """
    own = headers.select("header_id", "header_raw").dropDuplicates(["header_id"])
    read = classify_and_resolve(headers.select("header_raw").distinct(), "header_raw", dictionaries)
    texts = once(read.select(F.col("header_raw").alias("header_id"), "normalized", "verdict", "mapping"), "header_texts")
    found = once(mapping_candidates(texts, dictionaries).withColumnRenamed("header_id", "header_raw"), "text_candidates")
    return own.join(found, "header_raw").drop("header_raw")


def priority(method: Column) -> Column:
    position = F.array_position(F.array(*[F.lit(p) for p in PRIORITY]), method)
    return F.when(position > 0, position).otherwise(len(PRIORITY) + 1)


def best_mapping(candidates: DataFrame) -> DataFrame:
    """The best candidate of each header and entity type.

    An aggregate of a minimum, not a ranking window: it is combined before the shuffle.
    """
    fields = ["canonical_entity_id", "candidate_method", "candidate_score"]
    rank = F.struct(
        priority(F.col("candidate_method")).alias("p"), (-F.col("candidate_score")).alias("s"),
        F.col("canonical_entity_id").alias("i"),
    )
    return (
        candidates.groupBy("header_id", "canonical_entity_type")
        .agg(F.min_by(F.struct(*fields), rank).alias("best"))
        .select("header_id", "canonical_entity_type", *[F.col(f"best.{f}") for f in fields])
    )


def review_queue(
    candidates: DataFrame, headers: DataFrame, department: str | None = None, limit: int | None = None
) -> DataFrame:
    """Candidates that wait for a person, the most certain first."""
    waiting = candidates.filter(
        ~F.coalesce("approved_flag", F.lit(False)) & (F.col("candidate_score") < AUTO_APPROVE)
    )
    if department is not None:
        headers = headers.filter(F.col("department_id") == department)
    queue = (
        waiting.join(headers.select("header_id", "department_id", "header_raw"), "header_id")
        .select("header_id", "department_id", "header_raw", *CANDIDATE_COLUMNS[1:])
        .orderBy(F.desc("candidate_score"), "header_id", "canonical_entity_type", "canonical_entity_id")
    )
    return queue if limit is None else queue.limit(limit)


def apply_reviews(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Set the verdict of reviewed headers on all of their candidates.

    ``decisions(header_id, approved, reviewer, decided_at)``: the latest decision holds.
    """
    latest = decisions.groupBy("header_id").agg(
        F.max_by(F.struct("approved", "reviewer", "decided_at"), F.struct("decided_at", "reviewer", "approved")).alias("d")
    )
    base = [c for c in candidates.columns if c not in ("approved_flag", "approved_by", "approved_at")]
    return candidates.join(latest, "header_id", "left").select(
        *base,
        F.coalesce("d.approved", "approved_flag").alias("approved_flag"),
        F.col("d.reviewer").alias("approved_by"), F.col("d.decided_at").alias("approved_at"),
    )


#: What decides a text before the dictionaries do, best first.
DECIDING = ["review", "exact_rule", "scoped_rule"]


def reviewed_texts(candidates: DataFrame, headers: DataFrame, decisions: DataFrame) -> DataFrame:
    """What reviews decide: ``normalized, department_id, document_type, entity_type, entity_id, decided_at``.

    An approval chooses the best candidate of the header (see ``best_mapping``)
    for its text in its department; a refusal leaves the text without an entity.
    ``decisions`` may name the ``canonical_entity_id`` that it approves.
    """
    named = "canonical_entity_id" in decisions.columns
    latest = decisions.groupBy("header_id").agg(F.max_by(
        F.struct("approved", "decided_at", (F.col("canonical_entity_id") if named else F.lit(None).cast("string")).alias("wanted")),
        F.struct("decided_at", "approved"),
    ).alias("d")).select("header_id", "d.*")
    own = candidates.join(latest, "header_id").filter(F.col("wanted").isNull() | (F.col("wanted") == F.col("canonical_entity_id")))
    best = best_mapping(own.select(*CANDIDATE_COLUMNS))
    texts = headers.select("header_id", "department_id", normalize_header(F.col("header_raw")).alias("normalized")).distinct()
    return texts.join(latest, "header_id").join(best, "header_id").select(
        "normalized", "department_id", F.lit(None).cast("string").alias("document_type"), F.col("canonical_entity_type").alias("entity_type"),
        F.when(F.col("approved"), F.col("canonical_entity_id")).alias("entity_id"), "decided_at",
    )


def decisions_by_text(rules: DataFrame | None = None, reviews: DataFrame | None = None) -> DataFrame:
    """``normalized, options``: all that rules and reviews decide for a text, best first.

    ``rules`` as for ``scoped_candidates``, ``reviews`` as ``reviewed_texts``
    gives them. Reviews go before rules, later reviews before earlier ones; of
    rules one for all departments goes before one for a department, as
    ``PRIORITY`` has it, and one that also names the document type before one
    that does not. A text has as many options as rules and reviews name it.
    """
    parts = []
    none = F.lit(None).cast("timestamp")
    if reviews is not None:
        parts.append(reviews.withColumn("method", F.lit("review")))
    if rules is not None:
        scoped = F.when(F.col("department_id").isNull(), "exact_rule").otherwise("scoped_rule")
        parts.append(rules.withColumn("method", scoped).withColumn("decided_at", none))
    if not parts:
        raise ValueError("neither rules nor reviews")
    fields = ["department_id", "document_type", "entity_type", "entity_id", "method"]
    every = reduce(DataFrame.unionByName, [p.select("normalized", *fields, F.col("decided_at").cast("timestamp").alias("decided_at")) for p in parts])
    rank = F.array_position(F.array(*[F.lit(m) for m in DECIDING]), F.col("method"))
    late = F.coalesce(-F.unix_micros("decided_at"), F.lit(0))
    option = F.struct(rank.alias("rank"), late.alias("late"), F.col("document_type").isNull().alias("any_type"), F.col("entity_id").isNull().alias("refused"), *fields)
    return every.groupBy("normalized").agg(F.array_sort(F.collect_set(option)).alias("options"))


def mapping_counts(resolved: DataFrame, by: str = "department_id") -> DataFrame:
    """Headers seen, mapped on their own, left for review, unmapped; and shares."""
    score, kind = F.col("verdict.confidence"), F.col("verdict.header_class")
    seen = F.count(F.lit(1))
    useful = kind != "junk"
    mapped = F.count_if(useful & (score >= AUTO_APPROVE))
    review = F.count_if(useful & (score < AUTO_APPROVE) & (score >= MIN_SCORE))
    unmapped = F.count_if(useful & (score < MIN_SCORE))
    return resolved.groupBy(by).agg(
        seen.alias("headers_seen"), mapped.alias("auto_mapped"), review.alias("review_required"),
        unmapped.alias("unmapped"), F.count_if(~useful).alias("junk"),
        F.round(F.count_if(score >= MIN_SCORE) / seen, 6).alias("share_classified"),
        F.round(mapped / seen, 6).alias("share_mapped"),
    )


def mapping_warnings(candidates: DataFrame) -> DataFrame:
    """Headers with several candidates of one entity type."""
    return (
        candidates.groupBy("header_id", "canonical_entity_type")
        .agg(F.count(F.lit(1)).alias("candidates"), F.countDistinct("canonical_entity_id").alias("entities"))
        .filter("entities > 1")
    )
