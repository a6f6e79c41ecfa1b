"""Checks of the whole jobs: files of every shape to facts, and the dimensions that they point at."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.dictionaries import Dictionaries
from factloom.operators.dimensions import build_dim_document
from factloom.operators.quality import orphans
from factloom.plans.extract import extract
from factloom.plans.ingest import ingest
from factloom.plans.normalize import normalize, seed
from factloom.sources.warehouse import Warehouse
from factloom.streaming.documents import fact_batch, facts_stream, ingest_stream, landed_stream

from .kit import check, entity, table
from .scratch import folder

NAME, VALUE = "s_name", "cast(cast(s_acctbal as decimal(12,2)) as string)"
# (department, format, content, facts per file, of these with a period and with an area), one file of each shape for every supplier.
SHAPES = [
    ("fin", "csv", f"concat('Item,2020-21,forecast 2031-32\\n', {NAME}, ',', {VALUE}, ',5\\nother ', {NAME}, ',1,2\\n')", 4, 4, 0),
    ("fin", "csv", f"concat('Item,Ontario,Québec\\n1998-99,', {VALUE}, ',5\\n1999-2000,1,2\\n')", 4, 4, 4),
    ("fin", "csv", f"concat('Program,Kind,Value,2018-19\\n', {NAME}, ',Big,3,4\\n', {NAME}, ',,5,6\\n')", 4, 4, 0),
    ("statcan", "csv", f"concat('DAUID2016,Population 2016,', {NAME}, ' 2021\\n1001', s_suppkey, ',5,6\\n1002', s_suppkey, ',7,8\\n')", 2, 2, 2),  # a name with a year is no measure
    ("statcan", "csv", f"concat('REF_DATE,GEO,VALUE\\n2015,', {NAME}, ',1\\n2016,Ontario,2\\n')", 2, 2, 2),
    ("tbs-sct", "csv", f"concat('Vote,Amount\\nA,', {VALUE}, '\\nB,2\\n')", 2, 0, 0),
    ("statcan", "xml", f"""concat('<D><DataSet><Series GEO="', {NAME}, '"><Obs TIME_PERIOD="2007" OBS_VALUE="5"/><Obs TIME_PERIOD="2008" OBS_VALUE="6"/></Series></DataSet></D>')""", 2, 2, 2),
]
FACTS, TIMES, AREAS = (sum(s[n] for s in SHAPES) for n in (3, 4, 5))


@check("job_orphans", f"""
select 'fact_observation' as layer, count(*) * {FACTS} as facts, cast(0 as bigint) as orphans from supplier
union all select 'dim_time', count(*) * {TIMES}, 0 from supplier
union all select 'dim_geography', count(*) * {AREAS}, 0 from supplier
union all select 'dim_document', count(*) * {FACTS}, 0 from supplier
union all select 'dim_metric', null, 0 union all select 'dim_scenario', count(*) * 2, 0 from supplier""")
def _(spark, sf):
    store, known = Warehouse(spark, folder(spark, "jobs")), Dictionaries.default(spark)
    seed(store, known)
    suppliers = table(spark, sf, "supplier").repartition(spark.sparkContext.defaultParallelism)
    files = F.array(*[
        F.struct(F.lit(d).alias("department_id"), F.lit(f).alias("format"), F.expr(c.replace("\n", "\\n")).alias("text"), F.lit(str(n)).alias("n"))
        for n, (d, f, c, *_) in enumerate(SHAPES)
    ])
    landed = suppliers.select("s_suppkey", F.explode(files).alias("f")).select(
        "f.department_id", F.concat_ws("-", "f.n", "s_suppkey").alias("resource_id"), F.lit("").alias("name"), "f.format",
        F.concat(F.lit("https://e.org/"), "f.n", F.lit("/"), "s_suppkey", F.lit("."), "f.format").alias("url"), F.lit("en").alias("language"),
        F.lit(None).cast("string").alias("date_published"), F.lit("Tables").alias("title"), F.col("f.text").cast("binary").alias("content"),
    )
    ingest(store, landed, "b")
    contents = store.read("raw_documents").join(landed.select(F.col("url").alias("source_url"), "content"), "source_url")
    extract(store, contents, "b")
    normalize(store, known, "b")
    facts = store.read("fact_observation")
    out = facts.agg(F.lit("fact_observation").alias("layer"), F.count(F.lit(1)).alias("facts"), F.lit(0).cast("long").alias("orphans"))
    for key in ("time_id", "geography_id", "document_id", "metric_id", "scenario_id"):
        layer = f"dim_{key[:-3]}"
        own = facts.filter(F.col(key).isNotNull() & (F.col(key) != ""))
        lost = orphans(own, store.read(layer), key).groupBy().agg(F.count(F.lit(1)).alias("orphans"))
        count = F.lit(None).cast("long") if layer == "dim_metric" else F.count(F.lit(1))
        out = out.unionByName(own.agg(F.lit(layer).alias("layer"), count.alias("facts")).crossJoin(lost))
    return out


SHARED = f"""select d as department_id, s_name as metric, cast({VALUE} as double) as value_numeric, cast(1 as bigint) as facts, cast(1 as bigint) as documents
  from supplier, (values ('fin', 0), ('fin', 1), ('fin', 2), ('health', 0), ('health', 1), ('transport', 0)) o(d, k) where s_suppkey % 3 = k"""


@check("job_shared_file", f"{SHARED}")
def _(spark, sf):
    """One file in up to three departments, taken in at once or by a later batch, and three runs: each has its facts once."""
    store, known = Warehouse(spark, folder(spark, "shared")), Dictionaries.default(spark)
    seed(store, known)
    lots = [("fin", "true", 1), ("health", "s_suppkey % 3 = 0", 1), ("health", "s_suppkey % 3 = 1", 2), ("transport", "s_suppkey % 3 = 0", 2)]
    suppliers = table(spark, sf, "supplier")
    for run in (1, 2, 3):
        landed = None
        for department, which, since in lots:
            part = suppliers.filter(which).filter(F.lit(since <= run)).select(
                F.lit(department).alias("department_id"), F.col("s_suppkey").cast("string").alias("resource_id"), F.lit("").alias("name"), F.lit("csv").alias("format"),
                F.concat(F.lit("https://e.org/"), "s_suppkey", F.lit(".csv")).alias("url"), F.lit("en").alias("language"), F.lit(None).cast("string").alias("date_published"),
                F.lit("Tables").alias("title"), F.expr(f"cast(concat('Item,2020-21\n', {NAME}, ',', {VALUE}, '\n') as binary)").alias("content"),
            )
            landed = part if landed is None else landed.unionByName(part)
        ingest(store, landed, f"b{run}")
        files = landed.select("department_id", F.col("url").alias("source_url"), "content")
        extract(store, store.read("raw_documents").join(files, ["department_id", "source_url"]), f"b{run}")
        normalize(store, known, f"b{run}")
    documents = store.read("dim_document").groupBy("document_id").agg(F.count(F.lit(1)).alias("documents"))
    facts = store.read("fact_observation").join(store.read("dim_metric"), "metric_id").join(documents, "document_id")
    return facts.groupBy("department_id", F.col("canonical_name").alias("metric"), "value_numeric", "documents").agg(F.countDistinct("observation_id").alias("facts"))


class Again(Warehouse):
    """A store in which no commit is seen: a batch does all of its work again."""

    def committed(self, batch):
        return False


@check("two_streams", """select document_id, min(department_id) as department_id, count(distinct document_id) as rows from
 (select substr(sha256(concat('https://e.org/', event_type, '/', user_id) || '|' || sha256(props)), 1, 32) as document_id, event_type as department_id from events) group by document_id""")
def _(spark, sf):
    """Two streams with folders and checkpoints of their own into one store, each started twice."""
    landed = table(spark, sf, "events").selectExpr(
        "user_id % 2 as side", "event_type as department_id", "cast(event_id as string) as resource_id", "cast(event_id as string) as name",
        "'csv' as format", "concat('https://e.org/', event_type, '/', user_id) as url", "'en' as language",
        "cast(null as string) as date_published", "concat('Lot ', user_id) as title", "cast(props as binary) as content",
    )
    root = folder(spark, "streams")
    store = Warehouse(spark, root + "/store")
    for _ in range(2):
        for side in (0, 1):
            own = landed.filter(F.col("side") == side).drop("side")
            own.write.mode("append").parquet(f"{root}/{side}")
            ingest_stream(store, landed_stream(spark, f"{root}/{side}", own.schema), f"{root}/checkpoint-{side}").awaitTermination()
    return store.read("raw_documents").groupBy("document_id").agg(F.min("department_id").alias("department_id"), F.count(F.lit(1)).alias("rows"))


@check("stream_facts", f"""select s_name as metric, '2020-21' as period, cast({VALUE} as double) as value_numeric from supplier
union all select s_name, '2031-32', cast(s_suppkey as double) from supplier""")
def _(spark, sf):
    """Files in two lots through ingest, extraction and facts, a micro-batch each; then the first batch once more."""
    store, known, root = Warehouse(spark, folder(spark, "facts")), Dictionaries.default(spark), folder(spark, "facts-landed")
    seed(store, known)
    landed = table(spark, sf, "supplier").selectExpr(
        "s_suppkey % 2 as lot", "'fin' as department_id", "cast(s_suppkey as string) as resource_id", "'' as name", "'csv' as format",
        "concat('https://e.org/', s_suppkey, '.csv') as url", "'en' as language", "cast(null as string) as date_published", "'Tables' as title",
        f"cast(concat('Item,2020-21,forecast 2031-32\\n', {NAME}, ',', {VALUE}, ',', s_suppkey, '\\n') as binary) as content",
    )
    for lot in (0, 1):
        own = landed.filter(F.col("lot") == lot).drop("lot")
        own.write.mode("append").parquet(root + "/in")
        facts_stream(store, known, landed_stream(spark, root + "/in", own.schema), root + "/checkpoint").awaitTermination()
    first = min(r.batch for r in store.read("batch_commits").collect())
    fact_batch(Again(spark, store.root), known, landed.filter("lot = 0").drop("lot"), first)
    facts = store.read("fact_observation")
    return facts.join(store.read("dim_metric"), "metric_id").join(store.read("dim_time"), "time_id").select(
        F.col("canonical_name").alias("metric"), F.col("label").alias("period"), "value_numeric")


def staged_tables(store, cells, headers, kinds):
    """Put tables into a store as extraction would have left them."""
    tables = cells.select("table_id", "document_id", "department_id").distinct()
    store.append("raw_documents", tables.select("document_id", "department_id", F.lit("x").alias("gcs_uri"), F.lit("success").alias("ingestion_status"), F.lit(kinds).alias("document_type")), "b")
    store.append("extracted_tables", tables, "b")
    store.append("headers", headers, "b")
    store.append("row_values_long", cells.withColumn("staging_value_id", F.monotonically_increasing_id().cast("string")), "b")


def two_columns(spark, sf, label, department):
    """Cells and headers of a table for each nation: a label and a value for each supplier."""
    rows = table(spark, sf, "supplier").selectExpr(
        "s_nationkey as nation", f"{department} as department_id", "concat('d-', s_nationkey) as document_id", "concat('t-', s_nationkey) as table_id", "s_suppkey as source_row_number",
        f"inline(array(struct(0L as source_column_number, 'Item' as header_raw, {label} as value_raw), struct(1L as source_column_number, '2020-21' as header_raw, {VALUE} as value_raw)))",
    )
    headers = rows.selectExpr("nation", "department_id", "document_id", "table_id", "source_column_number as column_number", "header_raw",
                              "concat('h-', nation, '-', source_column_number) as header_id").distinct()
    return rows, headers


@check("table_errors", """select concat('t-', s_nationkey) as table_id, case when s_nationkey % 5 = 0 then count(*) else 0 end as observations,
  case s_nationkey % 5 when 1 then 'two_values_in_a_cell' when 2 then 'cell_without_place' when 3 then 'no_headers' when 4 then 'two_headers_of_a_column' end as reason
  from supplier group by s_nationkey""")
def _(spark, sf):
    """Tables with one thing wrong among good ones: these keep all facts, those become one reject each."""
    store, known = Warehouse(spark, folder(spark, "errors")), Dictionaries.default(spark)
    cells, headers = two_columns(spark, sf, NAME, "'fin'")
    least = cells.groupBy("nation").agg(F.min("source_row_number").alias("least"))
    first = cells.join(least, "nation").filter("source_row_number = least and source_column_number = 1").drop("least")
    twice = first.filter("nation % 5 = 1").withColumn("value_raw", F.concat("value_raw", F.lit("7")))
    lost = first.filter("nation % 5 = 2").withColumn("source_row_number", F.lit(None).cast("long"))
    more = headers.filter("nation % 5 = 4 and column_number = 1").withColumn("header_raw", F.lit("2021-22"))
    staged_tables(store, cells.unionByName(twice).unionByName(lost), headers.filter("nation % 5 <> 3").unionByName(more), None)
    normalize(store, known, "b")
    facts = store.read("fact_observation").groupBy("table_id").agg(F.count(F.lit(1)).alias("observations"))
    wrong = store.read("rejects").groupBy("table_id").agg(F.concat_ws("+", F.sort_array(F.collect_list("reason"))).alias("reason"))
    return store.read("extracted_tables").select("table_id").join(facts, "table_id", "left").join(wrong, "table_id", "left").fillna(0, ["observations"])


LINE, SIDE = "concat('Line ', s_suppkey % 4)", "case when s_nationkey % 2 = 0 then 'fin' else 'other' end"


@check("rule_to_fact", f"""select * from (select {SIDE} as department_id, cast(s_suppkey as bigint) as source_row_number,
  case s_suppkey % 4 when 0 then 'R0' when 1 then case when s_nationkey % 2 = 0 then 'R1' else {entity('metric', LINE)} end
  when 2 then {entity('metric', LINE)} else case when s_nationkey % 2 = 0 then 'R3' end end as metric_id from supplier) where metric_id is not null""")
def _(spark, sf):
    """An exact rule, a rule for one department, one for another, an approval and a refusal: the facts follow them."""
    store, known = Warehouse(spark, folder(spark, "rules")), Dictionaries.default(spark)
    cells, headers = two_columns(spark, sf, LINE, SIDE)
    headers = headers.withColumn("header_raw", F.when(F.col("column_number") == 0, "LINE  3").otherwise(F.col("header_raw")))
    staged_tables(store, cells, headers, "budget")
    rules = spark.createDataFrame(
        [("line 0", None, None, "metric", "R0"), ("line 1", "fin", "budget", "metric", "R1"), ("line 2", "fin", "estimates", "metric", "R2"), ("line 2", "statcan", None, "metric", "R2")],
        "normalized string, department_id string, document_type string, entity_type string, entity_id string")
    labels = headers.filter("column_number = 0").select("nation", "header_id")
    store.append("mapping_candidates", labels.select(
        "header_id", F.lit("metric").alias("canonical_entity_type"), F.lit("R3").alias("canonical_entity_id"), F.lit("manual").alias("candidate_method"),
        F.lit(0.6).alias("candidate_score")), "by hand")
    said = labels.select("header_id", (F.col("nation") % 2 == 0).alias("approved"), F.timestamp_seconds(F.lit(5)).alias("decided_at"))
    normalize(store, known, "b", rules=rules, reviews=said.unionByName(labels.select("header_id", F.lit(True).alias("approved"), F.timestamp_seconds(F.lit(1)).alias("decided_at"))))
    return store.read("fact_observation").select("department_id", "source_row_number", "metric_id")


@check("dim_document_runs", """select document_id, department_id, title, cast(1 as bigint) as rows from (
  select *, row_number() over (partition by document_id order by department_id, title) as n from (
    select cast(o_custkey as varchar) as document_id, o_orderstatus as department_id, o_orderpriority as title from orders)) where n = 1""")
def _(spark, sf):
    """Files held by several departments, three runs of the document dimension: one row each, whatever is repeated."""
    store = Warehouse(spark, folder(spark, "dimension"))
    documents = table(spark, sf, "orders").selectExpr("cast(o_custkey as string) as document_id", "o_orderstatus as department_id", "o_orderpriority as title")
    for run in ("b1", "b2", "b3"):
        store.merge("dim_document", build_dim_document(documents, documents), run)
    return store.read("dim_document").groupBy("document_id", "department_id", "title").agg(F.count(F.lit(1)).alias("rows"))
