"""Whole jobs on a small warehouse, repeated jobs, streams, and parity with the reference SQL."""

import pytest
from pyspark.sql import functions as F

from checks import load
from checks.compare import compare, oracle_connection
from factloom.operators.serve import capped_limit, query_audit
from factloom.operators.quality import layer_report
from factloom.plans.extract import chosen_documents, extract, reprocess
from factloom.plans.ingest import ingest
from factloom.plans.normalize import normalize, seed
from factloom.schemas import LAYERS
from factloom.sources.files import read_files
from factloom.sources.warehouse import Warehouse, create_tables, table_exists
from factloom.operators.candidates import decisions_by_text, reviewed_texts
from factloom.operators.reshape import observations, parted
from factloom.streaming.documents import fact_batch, facts_stream, file_stream, for_each_batch, landed_stream

SF = "/root/testdata/sf0.001"
LANDED = (
    "department_id string, resource_id string, name string, format string, url string, language string, "
    "date_published string, title string, content binary"
)


def landed(spark, *rows):
    full = [(d, u, u, f, f"/x/{u}.{f}", lang, "2023-01-02T00:00", "Budget 2020", bytearray(c.encode())) for d, u, f, lang, c in rows]
    return spark.createDataFrame(full, LANDED)


def test_files_to_facts(spark, known, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    seed(store, known)
    seeded = store.read("dim_metric").count()
    files = landed(
        spark, ("fin", "a", "csv", "en", "Item,2020-21,2021-22\nRevenues,1,2\nExpenses,3,x\n"),
        ("statcan", "b", "xml", "en", '<D><DataSet><Series GEO="Ontario"><Obs TIME_PERIOD="2016" OBS_VALUE="5"/><Obs TIME_PERIOD="2017" OBS_VALUE="6"/></Series></DataSet></D>'),
        ("fin", "c", "csv", "fr", "a,b\n1,2\n3,4\n"), ("fin", "d", "csv", "en", "PK\x03\x04"),
        ("fin", "e", "json", "en", "{}"),
    )
    counts = {r.department_id: r.success for r in ingest(store, files, "b1").collect()}
    assert counts == {"fin": 2, "statcan": 1}
    with_url = files.select(F.concat(F.lit("https://open.canada.ca"), "url").alias("source_url"), "content")
    contents = lambda: store.read("raw_documents").join(with_url, "source_url")
    stats = {r.department_id: (r.documents, r.tables_kept, r.cells) for r in extract(store, contents(), "b1").collect()}
    assert stats == {"fin": (2, 1, 6), "statcan": (1, 1, 6)}
    made = {r.department_id: (r.tables, r.observations) for r in normalize(store, known, "b1").collect()}
    assert made == {"fin": (1, 4), "statcan": (1, 2)}
    first = sorted(map(str, store.read("fact_observation").drop("created_at").collect()))
    assert len(first) == 6 and store.read("dim_metric").count() >= seeded
    labels = {r.label for r in store.read("dim_time").collect()}
    assert labels == {"2020-21", "2021-22", "2016", "2017"}
    assert no_orphans(store)
    assert store.read("observation_quality").count() == 6
    # The same batch again changes nothing; a new batch finds nothing to do.
    ingest(store, files, "b1"), extract(store, contents(), "b1"), normalize(store, known, "b1")
    assert sorted(map(str, store.read("fact_observation").drop("created_at").collect())) == first
    assert ingest(store, files, "b2").agg(F.sum("success")).first()[0] == 0
    assert extract(store, contents(), "b2").count() == 0
    # Reading one document again gives the same facts.
    one = store.read("raw_documents").filter("department_id = 'fin' and file_format = 'csv'").first().document_id
    reprocess(store, contents(), spark.createDataFrame([(one,)], "document_id string"), "b3")
    normalize(store, known, "b3")
    assert sorted(map(str, store.read("fact_observation").drop("created_at").collect())) == first
    reprocess(store, contents(), chosen_documents(store, "statcan"), "b4")
    assert store.read("fact_observation").count() == 4 and store.read("observation_quality").count() == 4
    normalize(store, known, "b4")
    assert sorted(map(str, store.read("fact_observation").drop("created_at").collect())) == first
    # Keys of every layer are unique and required columns are filled.
    bad = layer_report({name: store.read(name) for name in LAYERS if store.exists(name)}).filter("missing > 0 or duplicate_keys > 0")
    assert bad.collect() == []
    # A batch that runs again with less keeps nothing of its first run.
    left = store.read("raw_documents").filter("department_id = 'fin'")
    store.append("raw_documents", spark.createDataFrame(left.collect(), left.schema), "b1")
    assert {r.department_id for r in store.read("raw_documents").collect()} == {"fin"}


def no_orphans(store):
    facts = store.read("fact_observation")
    for key, layer in (("time_id", "dim_time"), ("metric_id", "dim_metric"), ("geography_id", "dim_geography"), ("scenario_id", "dim_scenario"), ("document_id", "dim_document")):
        own = facts.filter(F.col(key).isNotNull() & (F.col(key) != ""))
        if own.join(store.read(layer), key, "left_anti").count():
            return False
    return True


def test_every_shape_finds_its_dimensions(spark, known, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    seed(store, known)
    seeded = {r.metric_id for r in store.read("dim_metric").collect()}
    files = landed(
        spark, ("statcan", "a", "csv", "en", "DAUID2016,Population 2016,Population 2021\n1001001,5,6\n1001002,7,8\n"),
        ("statcan", "b", "csv", "en", "REF_DATE,GEO,VALUE\n2015-16,Atlantis,1\n2016,Ontario,2\n"),
        ("fin", "c", "csv", "en", "Item,Ontario,Quebec\n2019-20,1,2\nforecast 2020-21,3,4\n"),
        ("fin", "d", "csv", "en", "Program,Kind,Value,2018-19\nRoads,Big,3,4\nRails,,5,6\n"),
        ("tbs-sct", "e", "csv", "en", "Vote,Amount\nA,1\nB,2\n"), ("fin", "f", "csv", "en", "Item,projection 2030-31\nSomething new,9\nRevenues,8\n"),
        ("statcan", "g", "xlsx", "en", "workbook"), ("statcan", "h", "xls", "en", "old workbook"),
    )
    ingest(store, files, "b1")
    with_url = files.select(F.concat(F.lit("https://open.canada.ca"), "url").alias("source_url"), "content")
    contents = lambda: store.read("raw_documents").join(with_url, "source_url")
    extract(store, contents(), "b1")
    status = lambda: {r.status: r.n for r in store.read("document_status").filter("stage = 'extract'").groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert status() == {"extracted": 6, "awaiting_grid": 2}
    normalize(store, known, "b1")
    books = [r.document_id for r in store.read("raw_documents").filter("file_format like 'xls%'").collect()]
    grid = spark.createDataFrame(
        [(d, 0, "S", n, c) for d in books for n, c in enumerate([["TIME_PERIOD", "", "OBS_VALUE"], ["2011", "x", "5"], ["2012", None, "6"]])],
        "document_id string, sheet_index int, sheet_name string, row_number long, cells array<string>",
    )
    assert extract(store, contents(), "b2", grids=grid).collect()[0].asDict() == {
        "department_id": "statcan", "documents": 2, "tables_kept": 2, "tables_skipped": 0, "headers": 4, "cells": 8}
    normalize(store, known, "b2")
    facts = store.read("fact_observation")
    assert facts.count() == 4 + 2 + 4 + 4 + 2 + 2 + 4 and no_orphans(store)
    assert {r.extraction_method for r in store.read("extracted_tables").filter("sheet_name = 'S'").collect()} == {"xlsx_parser", "xls_parser"}
    used = {r.metric_id for r in facts.collect()}
    assert {r.metric_id for r in store.read("dim_metric").collect()} - seeded <= used
    assert {"2011", "2012", "2015-16", "2016", "2021", "2019-20", "2020-21", "2018-19", "2030-31"} == {r.label for r in store.read("dim_time").collect()}


def test_downloads_without_content_fail_and_departments_stay_apart(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    files = landed(spark, ("a", "x", "csv", "en", "k,v\n1,2\n"), ("b", "x", "csv", "en", "k,v\n1,2\n"), ("a", "y", "csv", "en", ""))
    files = files.withColumn("content", F.when(F.col("url") != "/x/y.csv", F.col("content")))
    counts = {r.department_id: (r.success, r.failed) for r in ingest(store, files, "b1").collect()}
    assert counts == {"a": (1, 1), "b": (1, 0)}
    assert sorted(r.department_id for r in store.read("raw_documents").collect()) == ["a", "b"]
    again = {r.department_id: (r.success, r.failed, r.duplicate) for r in ingest(store, files, "b2").collect()}
    assert again == {"a": (0, 1, 1), "b": (0, 0, 1)}


def test_bounds_leave_a_record_of_what_they_cut(spark, known, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    files = landed(spark, ("fin", "a", "csv", "en", "Item,2020-21,2021-22\nRevenues,1,2\nExpenses,3,4\n"), ("fin", "b", "csv", "en", "Item,2020-21\nRevenues,1\n"))
    ingest(store, files, "b1")
    with_url = files.select(F.concat(F.lit("https://open.canada.ca"), "url").alias("source_url"), "content")
    extract(store, store.read("raw_documents").join(with_url, "source_url"), "b1", min_rows=2)
    normalize(store, known, "b1", limit=3)
    assert store.read("fact_observation").count() == 3
    assert {(r.layer, r.reason) for r in store.read("rejects").collect()} == {("extracted_tables", "too_few_rows"), ("fact_observation", "beyond_observation_limit")}


def test_stream_of_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("x")
    seen = []
    work = lambda df, batch: seen.append((batch, sorted(r.path.split("/")[-1] for r in df.select("path").collect())))
    run = lambda: for_each_batch(file_stream(spark, str(folder)), work, str(tmp_path / "check")).awaitTermination()
    run()
    (folder / "b.csv").write_text("yy")
    run()
    run()
    assert [files for _, files in seen] == [["a.csv"], ["b.csv"]]
    assert len({batch.rsplit("-", 1)[0] for batch, _ in seen}) == 1 and [batch[-8:] for batch, _ in seen] == ["00000000", "00000001"]
    assert read_files(spark, str(folder), max_bytes=1).count() == 1


REJECTS = "layer string, record_id string, document_id string, table_id string, reason string"


def test_forgetting_rewrites_only_the_batches_that_hold_the_rows(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    for batch, ids in {"b1": ["d1", "d2"], "b2": ["d3"], "b3": ["d1"]}.items():
        store.append("rejects", spark.createDataFrame([("l", batch, d, "t", "r") for d in ids], REJECTS), batch)
    files = lambda batch: sorted(f.name for f in (tmp_path / "rejects" / f"batch_id={batch}").iterdir() if f.suffix == ".parquet")
    before = files("b2")
    store.forget("rejects", spark.createDataFrame([("d1",), ("d9",)], "document_id string"), "x")
    assert sorted((r.record_id, r.document_id) for r in store.read("rejects").collect()) == [("b1", "d2"), ("b2", "d3")]
    assert files("b2") == before and store.read("rejects", batch="b3").isEmpty() and store.read("rejects", but_batch="b1").count() == 1
    store.forget("headers", spark.createDataFrame([("d1",)], "document_id string"), "x")  # an absent layer


def test_a_dimension_is_a_function_of_its_key(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    rows = lambda *r: spark.createDataFrame(list(r), "geography_id string, geo_type string, code string, name_en string")
    store.merge("dim_geography", rows(("a", "t", "2", None), ("a", "t", "1", "x"), (None, "t", "9", "n"), *[(f"k{n}", "t", str(n), "y") for n in range(40)]), "b1")
    held = lambda: {r.geography_id: (r.geo_type, r.code, r.name_en, r.name_fr) for r in store.read("dim_geography").collect()}
    assert held()["a"] == ("t", "1", "x", None) and len(held()) == 41 == store.read("dim_geography").count()
    files = lambda: {str(f) for f in (tmp_path / "dim_geography").rglob("*.parquet")}
    first, when = files(), {r.geography_id: r.created_at for r in store.read("dim_geography").collect()}
    store.merge("dim_geography", rows(("a", None, "1", "x"), ("k3", "t", "3", "y"), ("k3", "t", "3", "y")), "b2")
    assert files() == first  # nothing changed, nothing is written
    store.merge("dim_geography", rows(("a", "u", "1", None), ("new", "t", "5", "z")), "b3")
    assert held()["a"] == ("u", "1", "x", None) and held()["new"][1] == "5" and len(held()) == 42
    assert first - files() and len(first & files()) >= len(first) - 2
    assert {r.geography_id: r.created_at for r in store.read("dim_geography").collect() if r.geography_id in when} == when


def test_two_streams_share_a_store_and_facts_follow_batches(spark, known, tmp_path):
    store = Warehouse(spark, str(tmp_path / "store"))
    seed(store, known)
    one = landed(spark, ("fin", "a", "csv", "en", "Item,2020-21\nRevenues,1\nExpenses,3\n"), ("fin", "b", "csv", "en", "Item,2020-21\nRevenues,2\n"))
    two = landed(spark, ("fin", "c", "csv", "en", "Item,2021-22\nRevenues,5\n"), ("statcan", "a", "csv", "en", "Item,2020-21\nRevenues,1\nExpenses,3\n"))
    for name, rows in (("x", one), ("y", two)):
        rows.write.parquet(str(tmp_path / name))
        facts_stream(store, known, landed_stream(spark, str(tmp_path / name), rows.schema), str(tmp_path / f"check-{name}")).awaitTermination()
    assert store.read("raw_documents").count() == 4 and store.read("fact_observation").count() == 4
    names = sorted(r.batch for r in store.read("batch_commits").collect())
    assert len(names) == 2 and all(n.endswith("-00000000") for n in names) and no_orphans(store)
    said = lambda: sorted(map(str, store.read("fact_observation").drop("created_at").collect()))
    first, dims = said(), store.read("dim_document").count()
    assert dims == 3 == store.read("dim_document").select("document_id").distinct().count()

    class Again(Warehouse):
        """A store in which no commit is seen: a batch does all of its work again."""

        def committed(self, batch):
            return False

    for batch in names:
        rows = one if store.read("raw_documents", batch=batch).filter("source_url like '%/b.csv'").count() else two
        fact_batch(store, known, two, batch)  # committed: nothing happens
        fact_batch(Again(spark, store.root), known, rows, batch)
    assert said() == first and store.read("dim_document").count() == dims and store.read("raw_documents").count() == 4


CELLS = "department_id string, document_id string, table_id string, source_row_number long, source_column_number long, header_raw string, value_raw string"


def test_a_bad_table_does_not_hold_up_the_others(spark, known):
    def table(name, *extra):
        heads = ["Item", "2020-21"]
        return [("fin", f"d-{name}", name, n, k, heads[k], v) for n, row in enumerate([["Revenues", "1"], ["Expenses", "2"]]) for k, v in enumerate(row)] + list(extra)

    rows = table("good") + table("same", ("fin", "d-same", "same", 0, 1, "2020-21", "1")) + table("twice", ("fin", "d-twice", "twice", 1, 1, "2020-21", "7"))
    rows += table("lost", ("fin", "d-lost", "lost", None, 1, "2020-21", "7")) + table("place", ("fin", "d-place", "place", 1, None, "2020-21", "7")) + table("bare") + table("heads")
    cells = spark.createDataFrame(rows, CELLS)
    heads = [("fin", t, k, h) for t in ("good", "same", "twice", "lost", "place", "heads") for k, h in enumerate(["Item", "2020-21"])] + [("fin", "heads", 1, "2021-22")]
    headers = spark.createDataFrame(heads, "department_id string, table_id string, column_number long, header_raw string")
    good, bad = parted(observations(cells, known, headers, errors=True))
    assert {r.table_id: r["count"] for r in good.groupBy("table_id").count().collect()} == {"good": 2, "same": 2}
    assert {r.table_id: r.error for r in bad.collect()} == {
        "twice": "two_values_in_a_cell", "lost": "cell_without_place", "place": "cell_without_place", "bare": "no_headers", "heads": "two_headers_of_a_column"}
    assert observations(cells, known, headers).filter("table_id in ('good', 'same')").count() == 4


def test_rules_and_reviews_reach_the_facts(spark, known):
    heads = spark.createDataFrame([("fin", "t", 0, "Item"), ("fin", "t", 1, "2020-21"), ("statcan", "s", 0, "DAUID2016"), ("statcan", "s", 1, "Population 2016")],
                                  "department_id string, table_id string, column_number long, header_raw string")
    labels = ["Revenues", "Odd one", "Other", "Refused"]
    rows = [("fin", "d", "t", n, k, h, v) for n, t in enumerate(labels) for k, (h, v) in enumerate((("Item", t), ("2020-21", str(n))))]
    rows += [("statcan", "e", "s", 0, 0, "DAUID2016", "1001001"), ("statcan", "e", "s", 0, 1, "Population 2016", "5")]
    cells = spark.createDataFrame(rows, CELLS).withColumn("document_type", F.lit("budget"))
    rules = spark.createDataFrame([
        ("odd one", None, None, "metric", "M1"), ("odd one", "fin", None, "metric", "M2"), ("other", "fin", "estimates", "metric", "M3"), ("other", "fin", "budget", "metric", "M4"),
        ("revenues", "statcan", None, "metric", "M5"),
    ], "normalized string, department_id string, document_type string, entity_type string, entity_id string")
    candidates = spark.createDataFrame([("h1", "metric", "M6", "fuzzy", 0.7), ("h1", "metric", "M7", "fallback", 0.3), ("h2", "metric", "M8", "fallback", 0.3)],
                                       "header_id string, canonical_entity_type string, canonical_entity_id string, candidate_method string, candidate_score double")
    texts = spark.createDataFrame([("h1", "statcan", "Population 2016"), ("h2", "fin", " REFUSED")], "header_id string, department_id string, header_raw string")
    said = spark.createDataFrame([("h1", False, 1), ("h1", True, 2), ("h2", False, 3)], "header_id string, approved boolean, decided_at int").withColumn(
        "decided_at", F.timestamp_seconds("decided_at"))
    decided = known.with_decisions(decisions_by_text(rules, reviewed_texts(candidates, texts, said)))
    got = {(r.table_id, r.source_row_number): r.metric_id for r in observations(cells, decided, heads.withColumn("document_type", F.lit("budget"))).collect()}
    plain = {(r.table_id, r.source_row_number): r.metric_id for r in observations(cells, known, heads).collect()}
    assert got == {("t", 0): plain["t", 0], ("t", 1): "M1", ("t", 2): "M4", ("s", 0): "M6"} and len(plain) == 5


def test_catalogue_tables(spark):
    create_tables(spark, "layers")
    create_tables(spark, "layers")
    assert all(table_exists(spark, "layers", name) for name in LAYERS)
    assert not table_exists(spark, "layers", "nothing")


def test_limits():
    assert [capped_limit(v, 25) for v in (None, 0, -3, 7, 1000)] == [25, 25, 1, 7, 100]


def test_query_audit_keeps_its_known_limits(spark):
    texts = ["WITH a AS (SELECT 1) SELECT * FROM a", "SELECT limit_x FROM raw.documents", "SELECT 1 LIMIT 5000;", "SELECT 'drop' x", "SELECT a FROM `cur.t` ;"]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, sql string")
    got = [(r.reason, r.runnable) for r in query_audit(df, "p").orderBy("n").collect()]
    assert got == [
        ("not_select", None), (None, "SELECT limit_x FROM raw.documents"), (None, "SELECT 1 LIMIT 1000;"),
        ("forbidden_keyword", None), (None, "SELECT a FROM `p.cur.t` \nLIMIT 1000"),
    ]


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


PARITY = [
    "coverage_by_department", "metric_lookup", "citations", "csv_extract", "fact_observation", "observation_cap", "best_mapping",
    "raw_documents", "stream_ingest", "table_guards",
]


@pytest.mark.parametrize("name", PARITY)
def test_parity(spark, oracle, name):
    queries, sql = load()
    good, line = compare(spark, oracle, name, queries[name], sql.get(name), SF)
    assert good, line


def test_every_query_has_reference_sql():
    queries, sql = load()
    assert set(queries) == set(sql)
