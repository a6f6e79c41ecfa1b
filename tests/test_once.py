"""Steps of the jobs that are done once for a document or a distinct text, however often their result is used."""

from pyspark.sql import functions as F

from factloom.functions.periods import _fiscal_start
from factloom.operators.candidates import header_candidates, mapping_candidates
from factloom.operators.classify import classify_and_resolve, classify_texts
from factloom.operators.dimensions import resolved_dimensions
from factloom.operators.reshape import parted
from factloom.plans.extract import extract
from factloom.plans.ingest import ingest
from factloom.sources.warehouse import Warehouse
from tests.test_jobs import landed


def test_contents_are_read_once(spark, tmp_path):
    store, read = Warehouse(spark, str(tmp_path)), spark.sparkContext.accumulator(0)
    files = landed(
        spark, ("fin", "a", "csv", "en", "Item,2020-21\nRevenues,1\n"), ("fin", "b", "html", "en", "<table><tr><th>a</th></tr><tr><td>1</td></tr></table>"),
        ("statcan", "c", "xml", "en", '<D><DataSet><Series GEO="Ontario"><Obs TIME_PERIOD="2016" OBS_VALUE="5"/></Series></DataSet></D>'),
        ("fin", "d", "csv", "en", "\x00\x01\x02\x03"), ("fin", "e", "json", "en", "{}"),
    )
    ingest(store, files, "b1")

    @F.udf("binary")
    def seen(content):
        read.add(1)
        return content

    named = files.select(F.concat(F.lit("https://open.canada.ca"), "url").alias("source_url"), "content")
    # written, so that the function is not run with the files
    contents = store.staged(store.read("raw_documents").join(named, "source_url").select("document_id", "content"), "given", "t")
    extract(store, contents.withColumn("content", seen("content")), "b1")
    assert read.value == 5
    status = sorted((r.department_id, r.status) for r in store.read("document_status").collect())
    assert status == [("fin", "binary_content"), ("fin", "extracted"), ("fin", "extracted"), ("fin", "unsupported_format"), ("statcan", "extracted")]


def test_candidates_of_texts_are_those_of_headers_one_by_one(spark, known, tmp_path):
    once = lambda df, name: Warehouse(spark, str(tmp_path)).staged(df, name, "b")
    texts = ["Ontario", "2020-21", "forecast 2031-32", "", None, "Real GDP growt", "real gdp growth", "@x", "$ millions", "Thing"] * 3
    headers = spark.createDataFrame([(f"h{n % 25}", texts[n % 25]) for n in range(30)], "header_id string, header_raw string")
    one = classify_and_resolve(headers.dropDuplicates(["header_id"]), "header_raw", known)
    want = sorted(map(str, mapping_candidates(one, known).collect()))
    got = header_candidates(headers, known, once)
    assert sorted(map(str, got.collect())) == want and "fuzzy" in str(want) and "fallback" in str(want)
    assert header_candidates(headers.limit(0), known, once).count() == 0


def test_a_frequent_text_is_dealt_out_and_the_others_are_not(spark, known):
    words = ["Ontario"] * 40 + ["2020-21", "", None, "Real GDP growth", " ontario "] * 2
    rows = spark.createDataFrame([(n, w, words[-n - 1]) for n, w in enumerate(words)], "n long, a string, b string")
    got = {r.n: r for r in classify_texts(rows, {"a": "ra", "b": "rb"}, known, salts=3, hot=20).collect()}
    assert len(got) == len(words)
    for c in "ab":
        for r in classify_and_resolve(rows.select("n", c), c, known).collect():
            assert (got[r.n][f"r{c}"].verdict, got[r.n][f"r{c}"].mapping) == (r.verdict, r.mapping)


def test_observations_stay_where_they_are_when_bad_tables_are_left_out(spark, tmp_path):
    once = lambda df, name: Warehouse(spark, str(tmp_path)).staged(df, name, "b")
    found = once(spark.createDataFrame(
        [("fin", "d", f"t{n % 7}", "no_headers" if n % 7 == 3 and n < 7 else None) for n in range(70)],
        "department_id string, document_id string, table_id string, error string"), "found")
    good, bad = parted(found, once)
    assert good.count() == 60 and [r.table_id for r in bad.collect()] == ["t3"]
    assert "Exchange hashpartitioning" not in good._jdf.queryExecution().executedPlan().toString()


def test_dimensions_classify_their_texts_once(spark, known, tmp_path):
    names = []

    def once(df, name):
        names.append(name)
        return Warehouse(spark, str(tmp_path)).staged(df, name, "b")

    columns = "row_label string, column_label string, area_label string, time_id string, metric_id string, geography_id string, scenario_id string"
    texts = [("Real GDP growth", "forecast 2031-32", None), ("Thing", "2020-21", "Ontario"), ("Thing", "Population 2016", "1001"), (None, "Ontario", None)]
    facts = spark.createDataFrame([(*t, None, None, None, None) for t in texts], columns)
    every = classify_and_resolve(facts.select(F.explode(F.array("row_label", "column_label")).alias("t")), "t", known).select("mapping.*")
    facts = facts.select("row_label", "column_label", "area_label").crossJoin(every.select("time_id", "metric_id", "geography_id", "scenario_id"))
    rows = lambda found: {k: sorted(map(str, df.collect())) for k, df in found.items()}
    got = rows(resolved_dimensions(facts, known, once))
    assert names == ["label_texts"] and got == rows(resolved_dimensions(facts, known)) and all(got.values())


def test_texts_that_are_no_fiscal_year_are_not_cast(spark):
    texts = spark.createDataFrame([("2020-21",), ("1999-2000",), ("Supplier#000000001",), ("",), (None,), ("2016",)], "t string")
    strict = _fiscal_start("t", False).replace("try_cast(", "cast(")  # a failed cast would raise
    assert [r[0] for r in texts.selectExpr(strict).collect()] == [2020, 1999, None, None, None, None]
