"""Observations of each table shape, quality, candidates, dimensions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from factloom.dictionaries import DIMENSION_COLUMNS
from factloom.functions.text import attribute_type_name
from factloom.operators.candidates import apply_reviews, best_mapping, fuzzy_candidates, mapping_candidates, review_queue
from factloom.operators.classify import classify_and_resolve
from factloom.operators.dimensions import attribute_bridge, upsert
from factloom.operators.quality import score_observations
from factloom.operators.reshape import capped, observations

CELLS = (
    "department_id string, document_id string, table_id string, source_row_number long, source_column_number long, "
    "header_raw string, value_raw string"
)


def entity(text):
    return hashlib.sha256(text.encode()).hexdigest()[:24]


def cells(spark, department, headers, rows, table="t"):
    data = [
        (department, "doc", table, r, c, headers[c], v) for r, row in enumerate(rows) for c, v in enumerate(row)
    ]
    return spark.createDataFrame(data, CELLS)


def facts(spark, known, department, headers, rows):
    made = observations(cells(spark, department, headers, rows), known)
    return made.orderBy("source_row_number", F.coalesce("source_column_number", F.lit(-1))).collect()


def test_time_columns(spark, known):
    got = facts(spark, known, "fin", ["", "2023-24", "forecast 2024-25", "Note"], [
        ["Revenues", "100", "n/a", "x"], ["Code", "1", "2", "3"], ["", "1", "2", "3"], ["Ontario", "1", "2", "3"], ["Other", None, "7", ""],
    ])
    assert [(g.source_row_number, g.source_column_number, g.value_numeric, g.value_text) for g in got] == [
        (0, 1, 100.0, None), (0, 2, None, "n/a"), (4, 2, 7.0, None)]
    assert got[0].metric_id == entity("metric|budgetary_revenues") and got[2].metric_id == entity("metric|other")
    assert got[0].time_id == entity("time|2023-24") and got[1].scenario_id == entity("scenario|projection")
    assert got[0].observation_id == hashlib.sha256(b"t|0|1").hexdigest()[:32]


def test_geo_columns(spark, known):
    got = facts(spark, known, "fin", ["Year", "ON", "QC", "Canada"], [["2020", "1", "x", "3"], ["total", "1", "2", "3"]])
    assert [(g.geography_id, g.value_numeric, g.metric_id) for g in got] == [
        (entity("geo|on"), 1.0, ""), (entity("geo|ca"), 3.0, "")]


def test_dimensional(spark, known):
    got = facts(spark, known, "fin", ["CATEGORY", "SUBJECT", "ITEM", "VALUE", "2020-21"], [
        ["c", " S ", "I", "5", "6"], ["c", "", None, "7", "x"], ["Code", "", "", "1", "1"]])
    assert [(g.source_row_number, g.source_column_number, g.value_numeric) for g in got] == [(0, 3, 5.0), (0, 4, 6.0), (1, 3, 7.0)]
    assert got[0].metric_id == entity("metric|s | i") and got[2].metric_id == entity("metric|c")
    assert {g.time_id for g in got} == {entity("time|2020-21")}


@pytest.mark.parametrize("names", [["@TIME_PERIOD", "@OBS_VALUE", "@Geography"], ["TIME_PERIOD", "OBS_VALUE", "GEO"], ["REF_DATE", "VALUE", "DGUID"]])
def test_long(spark, known, names):
    got = facts(spark, known, "statcan", names, [["2016", "5", "Ontario"], ["", "6", "x"], ["odd", "..", ""], ["2017", None, "Here"]])
    assert [(g.source_row_number, g.time_id, g.geography_id, g.value_numeric, g.value_text) for g in got] == [
        (0, entity("time|2016"), entity("geo|on"), 5.0, None), (2, "", None, None, ".."),
        (3, entity("time|2017"), entity("geo|here"), None, None)]
    assert got[0].observation_id == hashlib.sha256(b"t|0").hexdigest()[:32] and got[0].source_column_number is None


def test_census(spark, known):
    got = facts(spark, known, "statcan", ["DAUID2006", "Population, 2016", "POP2006", "Name 2016"], [["35001", "1,200", "x", "9"], ["", "4", "5", "9"]])
    assert [(g.metric_id, g.time_id, g.geography_id, g.value_numeric) for g in got] == [
        (entity("metric|population"), entity("time|2016"), entity("geo|35001"), 1200.0),
        (entity("metric|population"), entity("time|2016"), None, 4.0), (entity("metric|census_population"), entity("time|2006"), None, 5.0)]


def test_treasury_shapes_and_none(spark, known):
    money = facts(spark, known, "tbs-sct", ["Organization", "Vote", "Amount"], [["a", "1", "$5"], ["b", "2", "n/a"]])
    assert [(m.value_numeric, m.observation_id) for m in money] == [(5.0, hashlib.sha256(b"t|0").hexdigest()[:32])]
    survey = facts(spark, known, "tbs-sct", ["QUESTION", "SCORE5", "SCORE100"], [["q", "4", "80"]])
    assert [(s.value_numeric, s.observation_id) for s in survey] == [(80.0, hashlib.sha256(b"t|survey|0").hexdigest()[:32])]
    assert facts(spark, known, "tbs-sct", ["Total", "x"], [["1", "2"]]) == []
    assert facts(spark, known, "statcan", ["Level", "Code", "Class title"], [["1", "2", "3"]]) == []
    assert facts(spark, known, "elsewhere", ["", "2020"], [["thing", "4"]])[0].value_numeric == 4.0


def test_a_cell_staged_twice_counts_once(spark, known):
    once = cells(spark, "fin", ["", "2020"], [["thing", "4"]])
    assert observations(once.unionByName(once), known).count() == 1


def test_own_shape_for_a_department(spark, known):
    own = lambda df: df.filter("source_column_number = 1").select(
        F.lit("o").alias("observation_id"), "department_id", "document_id", "table_id", F.lit("m").alias("metric_id"))
    df = cells(spark, "mine", ["a", "b"], [["x", "1"]]).unionByName(cells(spark, "fin", ["", "2020"], [["y", "2"]], "u"))
    got = observations(df, known, extra_shapes={"mine": own}).select("table_id", "metric_id").collect()
    assert sorted(map(tuple, got)) == [("t", "m"), ("u", entity("metric|y"))]


def test_cap_keeps_source_order(spark, known):
    made = observations(cells(spark, "fin", ["", "2019", "2020"], [[f"m{n}", "1", "2"] for n in range(10)]), known)
    got = capped(made, 5).collect()
    assert sorted((g.source_row_number, g.source_column_number) for g in got) == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1)]


def test_quality(spark):
    rows = [("a", "m", "t", 1.0, None, "u", 0.9), ("b", "", "", None, None, None, 0.5), ("c", None, "t", -2e15, None, None, None),
            ("d", "m", "t", None, "x", None, None), ("e", "m", "t", 1.5e16, None, "u", None)]
    df = spark.createDataFrame(rows, "observation_id string, metric_id string, time_id string, value_numeric double, value_text string, unit_raw string, k double")
    got = {r.observation_id: r for r in score_observations(df, F.col("k")).collect()}
    assert got["a"].quality_confidence == 1.0 and got["a"].issue_codes == ""
    assert got["b"].quality_confidence == 1.0 - 0.3 - 0.2 - 0.2 - 0.3 or got["b"].quality_confidence == 0.0
    assert got["b"].issue_codes == "MISSING_METRIC,MISSING_TIME,LOW_METRIC_CONFIDENCE,MISSING_VALUE"
    assert got["c"].quality_confidence == 1.0 - 0.3 - 0.2 - 0.05
    assert got["c"].issue_notes == f"No metric ID assigned; Value {-2e15} exceeds plausibility threshold"
    assert got["d"].quality_confidence == 1.0 and got["e"].issue_notes == f"Value {1.5e16} exceeds plausibility threshold"


def test_candidates_and_reviews(spark, known):
    headers = spark.createDataFrame(
        [("h1", "d", "Unemployment rate"), ("h2", "d", "Employmant"), ("h3", "d", "Name"), ("h4", "d", "unrelated words")],
        "header_id string, department_id string, header_raw string")
    resolved = classify_and_resolve(headers, "header_raw", known)
    fuzzy = fuzzy_candidates(resolved, known).collect()
    assert [(f.header_id, f.canonical_entity_id) for f in fuzzy] == [("h2", entity("metric|employment"))]
    candidates = mapping_candidates(resolved, known)
    best = {b.header_id: b.candidate_method for b in best_mapping(candidates).collect()}
    assert best == {"h1": "metric_dictionary", "h2": "fuzzy", "h4": "fallback"}
    assert [r.header_id for r in review_queue(candidates, headers, "d").collect()] == ["h2", "h4"]
    assert review_queue(candidates, headers, "other").count() == 0
    decisions = spark.createDataFrame(
        [("h2", True, "ann", 1), ("h2", False, "bo", 2)], "header_id string, approved boolean, reviewer string, decided_at long")
    after = apply_reviews(candidates, decisions).filter("header_id = 'h2'").collect()
    assert len(after) == 2 and all(a.approved_flag is False and a.approved_by == "bo" for a in after)


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    new = spark.createDataFrame([("b", None, "z"), ("c", 3, None)], "k string, v int, w string")
    assert sorted(map(tuple, upsert(old, new, "k").collect())) == [("a", 1, "x"), ("b", 2, "z"), ("c", 3, None)]


def test_rows_are_not_broadcast_to_the_specs(spark, known):
    """Two rows of cells look small; broadcast, all rows would be read where the specs lie."""
    found = observations(cells(spark, "fin", ["CATEGORY", "VALUE"], [["a", "1"], ["b", "2"]]), known)
    assert {r.value_numeric for r in found.collect()} == {1.0, 2.0}
    ran = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    on_blocks = [line for line in ran.splitlines() if "Join [table_id" in line and "_block" in line]
    assert on_blocks and all("SortMergeJoin" in line for line in on_blocks)


def test_dimension_names_are_normalised_as_they_stand(spark, known):
    names = spark.createDataFrame([(n,) for n in DIMENSION_COLUMNS], "name string")
    assert names.filter(attribute_type_name(F.col("name")) != F.col("name")).isEmpty()
    own = cells(spark, "fin", [" Vote Number\u00a0", "VALUE"], [["A  b", "1"]])
    _, values = attribute_bridge(own, observations(own, known))
    assert "coalesce(header_raw" not in values._jdf.queryExecution().analyzed().toString()
    (value,) = values.collect()
    assert (value.attribute_value_id, value.attribute_type_id) == (entity("attr_val|vote number|a b"), entity("attr_type|vote number"))
