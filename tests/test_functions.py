"""Scalar functions on tables of cases written from their rules."""

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from factloom.functions.keys import document_id, entity_key, row_key
from factloom.functions.numeric import parse_numeric
from factloom.functions.periods import with_is_time_like, with_period
from factloom.functions.text import (
    attribute_type_name, detect_language, header_without_years, header_year, infer_geo_type, is_measure_year_header,
    normalize_header,
)
from factloom.operators.classify import classify_and_resolve
from factloom.sources.files import decode_text, is_binary, uri_parts


def apply(spark, function, values):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
    return [r.out for r in df.select("n", function(F.col("v")).alias("out")).orderBy("n").collect()]


def test_normalize_header(spark):
    cases = {
        "  Total\n  Revenue: ": "total revenue", "﻿Year": "year", "2023–24": "2023-24", "a — b": "a - b",
        "“Net” ‘x’": "\"net\" 'x'", "Growth ( % )": "growth (%)", "M$": "millions $", "$US": "$ us", "a::": "a",
        "a  b": "a b", "": "", None: "", "x :": "x",
    }
    assert apply(spark, normalize_header, cases) == list(cases.values())


def test_detect_language(spark):
    cases = {
        "": "unknown", None: "unknown", "Total revenue": "en", "Dépenses": "fr", "ventes pour les clients": "fr",
        "the les and des for": "bilingual", "les": "en", "été with the": "bilingual",
    }
    assert apply(spark, detect_language, cases) == list(cases.values())


def test_parse_numeric(spark):
    cases = {
        "1,234.5": 1234.5, "$ 12": 12.0, "45 %": 45.0, "-3e2": -300.0, ".5": 0.5, "5.": 5.0, "1_000": 1000.0, "1d": None,
        "x": None, "F": None, "f": None, "...": None, "-": None, "": None, None: None, "n/a": None, "(5)": None, "1__0": None,
        "None": None, "nan": None, "1e999": None, "0x10": None,
    }
    assert apply(spark, parse_numeric, cases) == list(cases.values())
    loose = apply(spark, lambda c: parse_numeric(c, finite_only=False), ["nan", "-inf", "Infinity", "7", "None"])
    assert math.isnan(loose[0]) and loose[1:] == [-math.inf, math.inf, 7.0, None]


PERIODS = {
    "2023-24": ("fiscal_year", "2023-24", "2023-04-01", "2024-03-31", False, None),
    "2023-2024": ("fiscal_year", "2023-24", "2023-04-01", "2024-03-31", False, None),
    "2023—24": ("fiscal_year", "2023-24", "2023-04-01", "2024-03-31", False, None),
    "Projection 2024-25": ("fiscal_year", "2024-25", "2024-04-01", "2025-03-31", True, "projection"),
    "prévision2024": ("year", "2024", "2024-01-01", "2024-12-31", True, "prévision"),
    "Actual 2020": ("year", "2020", "2020-01-01", "2020-12-31", False, "actual"),
    "Feb. 2024": ("month", "2024-02", "2024-02-01", "2024-02-29", False, None),
    "août 2021": ("month", "2021-08", "2021-08-01", "2021-08-31", False, None),
    "April to December 2023-24": ("range", "april to december 2023-24", "2023-04-01", "2023-12-31", False, None),
    "October  to March 2023–24": ("range", "october to march 2023–24", "2023-10-01", "2024-03-31", False, None),
    "January to March 2023-24": ("range", "january to march 2023-24", "2023-01-01", "2023-03-31", False, None),
    "Year 07": ("range", "Year 7", None, None, False, None),
    "1999-00": None, "2023-25": None, "1899": None, "2101": None, "Foo 2024": None, "Projection": None, "2023-": None,
    "April to Foo 2023-24": None, "": None, None: None, "projection january 2024": None,
}


def test_periods(spark):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(PERIODS)], "n int, v string")
    rows = with_period(df, F.col("v"), "p").orderBy("n").collect()
    date = lambda text: dt.date.fromisoformat(text) if text else None
    for row, want in zip(rows, PERIODS.values()):
        want = want and (*want[:2], date(want[2]), date(want[3]), *want[4:])
        assert (row.p and tuple(row.p)) == want, row.v
    flags = with_is_time_like(df, F.col("v")).orderBy("n").collect()
    assert [r.is_time_like for r in flags] == [v is not None for v in PERIODS.values()]


def test_century_roll_is_optional(spark):
    df = spark.createDataFrame([("1999-00",)], "v string")
    assert with_period(df, F.col("v"), "p", century_roll=True).first().p.label == "1999-00"


def test_keys_match_plain_hashing(spark):
    digest = lambda text, n: hashlib.sha256(text.encode()).hexdigest()[:n]
    row = spark.range(1).select(
        row_key(F.lit("doc"), "csv", F.lit(0)).alias("t"), entity_key("metric", F.lit(" Real GDP ")).alias("m"),
        document_id(F.lit("u"), F.lit("c")).alias("d"),
    ).first()
    assert row.t == digest("doc|csv|0", 32) and row.m == digest("metric|real gdp", 24) and row.d == digest("u|c", 32)


def test_header_parts(spark):
    headers = ["Population, 2016", "POP2006", "DAUID2016", "2016", "Land area", "Rate 1871", "x total 1999 2001 ,"]
    assert apply(spark, header_year, headers) == ["2016", "2006", "2016", "2016", None, None, "1999"]
    assert apply(spark, header_without_years, headers) == ["Population", "POP", "DAUID", "2016", "Land area", "Rate 1871", "x total"]
    assert apply(spark, is_measure_year_header, headers) == [True, True, False, False, False, False, True]
    assert apply(spark, infer_geo_type, ["1234567", "12345", "HR 5", "Health unit", "x"]) == [
        "dissemination_area", "census_subdivision", "health_region", "health_region", "unknown"]
    assert apply(spark, attribute_type_name, ["@Age_Group", "Sex"]) == ["age group", "sex"]


CLASSES = {
    "": ("junk", 1.0, "empty"), "@URN": ("junk", 1.0, "junk_pattern"), "OBS": ("metric", 0.9, "statcan_value_column"),
    "@UOM": ("unit", 0.95, "statcan_unit_column"), "SCALAR_FACTOR": ("unit", 0.95, "statcan_unit_column"),
    "2021-22": ("time", 0.95, "time_parser"), "Year 1": ("time_range", 0.95, "time_parser"),
    "Ont.": ("geography", 0.95, "geo_dictionary"), "@Geography": ("geography", 0.95, "statcan_geo_attribute"),
    "Outturn": ("scenario", 0.95, "scenario_dictionary"), "@Gender": ("attribute", 0.8, "statcan_dimension_attribute"),
    "Unemployment rate": ("metric", 0.9, "metric_dictionary"), "Millions of dollars": ("unit", 0.9, "unit_pattern"),
    "Something else": ("metric", 0.3, "fallback"), "@": ("metric", 0.3, "fallback"),
}


def test_classification_order(spark, known):
    df = spark.createDataFrame([(n, h) for n, h in enumerate(CLASSES)], "n int, h string")
    rows = classify_and_resolve(df, "h", known).orderBy("n").collect()
    assert [tuple(r.verdict)[:3] for r in rows] == list(CLASSES.values())


def test_resolution(spark, known):
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()[:24]
    want = {
        "forecast 2022-23": ("time_id", "time|2022-23"), "Newfoundland and Labrador": ("geography_id", "geo|nl"),
        "observed": ("scenario_id", "scenario|actual"), "@Age_group": ("attribute_type_id", "attr_type|age group"),
        "Population": ("metric_id", "metric|population"), "My thing": ("metric_id", "metric|my thing"),
    }
    df = spark.createDataFrame([(h,) for h in want], "h string")
    got = {r.h: r.mapping for r in classify_and_resolve(df, "h", known).collect()}
    for header, (field, text) in want.items():
        assert got[header][field] == digest(text), header
    assert got["forecast 2022-23"].scenario_id == digest("scenario|projection")


def test_first_entry_wins_a_shared_spelling(spark):
    from factloom.dictionaries import Dictionaries

    metrics = [("first", "A", "", "f", "u", True, ["shared"]), ("second", "B", "", "f", "u", True, ["shared"])]
    made = Dictionaries.from_rows(spark, metrics=metrics)
    assert made.terms.filter("term = 'shared'").first().metric_key == "first"


def test_files(spark):
    rows = [
        (1, b"PK\x03\x04aaaa", "csv"), (2, b"PK\x03\x04aaaa", "XLSX"), (3, b"%PDF-1", "csv"), (4, b"a,b\n1,2\n", "csv"),
        (5, b"\x00" * 60 + b"a" * 500, "csv"), (6, b"", "csv"), (7, b"\x01a" * 3 + b"b" * 60, "csv"),
    ]
    df = spark.createDataFrame([(n, bytearray(c), f) for n, c, f in rows], "n int, c binary, f string")
    found = {r.n: r.b for r in df.select("n", is_binary(F.col("c"), F.col("f")).alias("b")).collect()}
    assert found == {1: True, 2: False, 3: True, 4: False, 5: True, 6: False, 7: False}
    texts = spark.createDataFrame([(bytearray("﻿é".encode()),), (bytearray("é".encode("latin-1")),)], "c binary")
    assert [r.t for r in texts.select(decode_text(F.col("c")).alias("t")).collect()] == ["é", "é"]
    uris = apply(spark, uri_parts, ["gs://b/x/y.csv", "s3://b/x", "gs://b"])
    assert tuple(uris[0]) == ("b", "x/y.csv", None) and uris[1].error and tuple(uris[2]) == ("b", "", None)


def test_refused_periods_carry_a_reason(spark):
    from factloom.functions.periods import with_refusal
    from factloom.operators.quality import refused_periods

    want = {
        "2020-21": None, "2020": None, "June 2020": None, "April to June 2020-21": None, "Year 3": None, "": None, None: None, "total": None,
        "population 2016": None, "12": None, "123456": None, "1,234.50": None, "forecast": None,
        "1899": "year_out_of_range", "mars 2150": "year_out_of_range", "0999-00": "year_out_of_range", "1999-00": "century_turn", "2020-01": "year_and_month",
        "2020-22": "years_not_neighbours", "Forecast 2020–2023": "years_not_neighbours", "2020 Q3": "quarter", "1 trimestre 2020": "quarter", "31/12/2020": "day",
        "2020-12-31": "day", "December 31, 2020": "day", "janv. 2020": "unknown_month", "2019 to 2021": "range_of_years", "June": None, "June 20": "other_form", "2020/21": "other_form",
    }
    rows = [(k, "kept") for k in want]
    got = {r.t: r.refusal and r.refusal.reason for r in with_refusal(spark.createDataFrame(rows, "t string, note string"), F.col("t")).collect()}
    assert got == want
    found = refused_periods(spark.createDataFrame([("2019 to 2021",)] * 3 + [("2020",), (None,)], "t string"), "t").collect()
    assert [tuple(r) for r in found] == [("2019 to 2021", 1.0, "range_of_years", 3)]
    assert refused_periods(spark.createDataFrame([], "t string"), "t").count() == 0


def test_texts_classified_once_read_like_rows_classified_one_by_one(spark, known):
    from factloom.operators.classify import classify_texts

    words = ["Ontario"] * 40 + ["2020-21", "", None, "Real GDP growth", " ontario ", "@x", "$ millions", "actual"] * 2
    rows = spark.createDataFrame([(n, w, words[-n - 1]) for n, w in enumerate(words)], "n long, a string, b string")
    got = classify_texts(rows, {"a": "ra", "b": "rb"}, known, salts=3)
    assert got.columns == ["n", "a", "b", "ra", "rb"]
    one = lambda c: {r.n: (r.verdict, r.mapping) for r in classify_and_resolve(rows.select("n", c), c, known).collect()}
    a, b = one("a"), one("b")
    found = got.collect()
    assert len(found) == len(words) and all((r.ra.verdict, r.ra.mapping) == a[r.n] and (r.rb.verdict, r.rb.mapping) == b[r.n] for r in found)
    assert classify_texts(rows.limit(0), {"a": "ra"}, known).count() == 0


def test_classification_runs_in_methods_that_are_compiled(spark):
    from factloom.dictionaries import Dictionaries

    held = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        df = spark.createDataFrame([("Ontario",), ("2019-20",)], "t string")
        assert classify_and_resolve(df, "t", Dictionaries.default(spark)).filter("mapping.is_junk").count() == 0
        assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", held)


def test_a_bare_number_is_read_as_the_text_is(spark):
    from factloom.functions.numeric import bare_number, parse_bare

    texts = ["$ 1,000.5", "12 %", "\u00a0+7\u2009", "NaN", "-inf", "Infinity", "1e400", "1_000", "...", "", None, "n/a", "F", "nan1", ".5e3"]
    two_steps = lambda c: parse_bare(bare_number(c), False)
    want = [1000.5, 12.0, 7.0, math.nan, -math.inf, math.inf, math.inf, 1000.0, None, None, None, None, None, None, 500.0]
    plain = lambda v: "nan" if v is not None and math.isnan(v) else v
    assert [plain(v) for v in apply(spark, two_steps, texts)] == [plain(v) for v in want]
