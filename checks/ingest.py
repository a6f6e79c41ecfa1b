"""Checks of catalogue payloads, eligibility and document records."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions.keys import checksum, document_id
from factloom.sources import catalogue as cat
from factloom.sources.warehouse import ndjson, run_sql

from . import inputs as i
from .kit import check, in_list, q, table

RES = i.RESOURCE_SQL


def resources(spark, sf):
    return cat.catalogue_resources(i.payloads(spark, sf))


@check("catalog_flatten", f"{RES} select department_id, dataset_id, title, date_published, resource_id, name, format, url, size from res")
def _(spark, sf):
    return resources(spark, sf).drop("language")


@check("resource_format", f"{RES} select dataset_id, resource_id, lower(trim(format)) as file_format from res")
def _(spark, sf):
    return resources(spark, sf).select("dataset_id", "resource_id", cat.resource_format(F.col("format")).alias("file_format"))


LANGUAGE = """case when json_type(lang_json) = 'ARRAY' then case when json_array_length(lang_json) = 0 then 'unknown'
  when json_contains(lang_json, '"en"') and json_contains(lang_json, '"fr"') then 'bilingual' else json_extract_string(lang_json, '$[0]') end
  when json_type(lang_json) = 'VARCHAR' then json_extract_string(lang_json, '$') else 'unknown' end"""


@check("resource_language", f"{RES} select dataset_id, resource_id, {LANGUAGE} as language from res")
def _(spark, sf):
    return resources(spark, sf).select("dataset_id", "resource_id", cat.resource_language(F.col("language")).alias("language"))


TYPE = """case when lower(title) like '%budget%' then 'budget' when lower(title) like '%estimate%' then 'estimates' when lower(title) like '%fiscal monitor%' then 'fiscal_monitor'
  when regexp_matches(lower(title), 'economic (and fiscal )?(update|statement)') then 'economic_update' when lower(title) like '%survey%forecast%' then 'economic_survey'
  when lower(title) like '%transfer%' then 'transfer_tables' when lower(title) like '%proactive disclosure%' then 'proactive_disclosure'
  when lower(title) like '%employee survey%' or lower(title) like '%pses%' then 'employee_survey' when lower(title) like '%infobase%' or lower(title) like '%covid%' then 'expenditure_tracking'
  when lower(title) like '%aid%' or lower(title) like '%iati%' then 'international_aid' else 'other' end"""


@check("document_type", f"""{RES} select dataset_id, title, {TYPE} as document_type, nullif(regexp_extract(title, '(20\\d{{2}})', 1), '') as year
from res union all select concat('doc', doc_id), text, {TYPE.replace('title', 'text')}, nullif(regexp_extract(text, '(20\\d{{2}})', 1), '') from documents""")
def _(spark, sf):
    titles = resources(spark, sf).select("dataset_id", "title").unionByName(
        table(spark, sf, "documents").selectExpr("concat('doc', doc_id) as dataset_id", "text as title")
    )
    title = F.col("title")
    return titles.select("dataset_id", "title", cat.document_type(title).alias("document_type"), cat.title_year(title).alias("year"))


ENDING = "\\.(zip|gz|tar|rar|7z|pdf|doc|docx)$"
JUDGED = f"""{RES}, known as ({i.KNOWN_SQL}),
e as (select *, case when url like '/%' then 'https://open.canada.ca' || url else url end as source_url, lower(trim(format)) as file_format, {LANGUAGE} as language
  from res where coalesce(url, '') <> ''),
j as (select *, case when (department_id, source_url) in (select (department_id, source_url) from known) then 'known_url' when not {in_list('file_format', cat.SUPPORTED_FORMATS)} then 'format'
  when regexp_matches(lower(source_url), '{ENDING}') then 'ending' when language <> 'en' then 'language'
  when regexp_matches(lower(source_url), '-fra\\.(csv|xml|xlsx|xls)$') then 'french_file' when size > 200 then 'too_large' end as reason from e),
v as (select *, case when reason = 'known_url' then 'duplicate' when reason is not null then 'skipped' else 'eligible' end as verdict from j)"""


def judged(spark, sf):
    return cat.with_eligibility(resources(spark, sf), i.known_documents(spark, sf), max_bytes=200)


@check("resource_eligibility", f"{JUDGED} select dataset_id, resource_id, source_url, file_format, language, reason, verdict from v")
def _(spark, sf):
    return judged(spark, sf).select("dataset_id", "resource_id", "source_url", "file_format", "language", "reason", "verdict")


@check("known_urls", f"""{JUDGED} select dataset_id, resource_id, (department_id, source_url) in (select (department_id, source_url) from known) as is_known from e""")
def _(spark, sf):
    resources(spark, sf).withColumn("source_url", cat.resource_url(F.col("url"))).createOrReplaceTempView("checked_resources")
    chosen = run_sql(
        spark, "select department_id, dataset_id, resource_id, source_url from checked_resources where coalesce(url, '') != :none", none=""
    )
    return cat.known_urls(chosen, i.known_documents(spark, sf)).drop("department_id", "source_url")


# As landed: every resource with the page as content, one in seven downloads without any.
LANDED = JUDGED.replace("from res where", ", case when size % 7 <> 3 then raw end as html from res join (select page_id, html as raw from pages) on dataset_id = concat('d', page_id) where").replace(
    "when size > 200 then 'too_large' end", "when coalesce(strlen(html), size) > 2000 then 'too_large' when html is null then 'no_content' end"
).replace("when reason = 'known_url' then 'duplicate'", "when reason = 'known_url' then 'duplicate' when reason = 'no_content' then 'failed'")


@check("ingest_stats", f"""{LANDED} select department_id, count(*) filter (verdict = 'eligible') as success, count(*) filter (verdict = 'skipped') as skipped,
  count(*) filter (verdict = 'duplicate') as duplicate, count(*) filter (verdict = 'failed') as failed from v group by department_id""")
def _(spark, sf):
    content = table(spark, sf, "pages").selectExpr(
        "concat('d', page_id) as dataset_id", "case when page_id % 7 != 3 then cast(html as binary) end as content"
    )
    landed = resources(spark, sf).join(content, "dataset_id")
    return cat.ingest_counts(cat.with_eligibility(landed, i.known_documents(spark, sf), max_bytes=2000))


@check("raw_documents", f"""{JUDGED}, k as (select v.*, html, sha256(html) as checksum, substr(sha256(source_url || '|' || sha256(html)), 1, 32) as document_id,
    coalesce(nullif(regexp_extract(title, '(20\\d{{2}})', 1), ''), 'unknown') as year, {TYPE} as document_type
  from v join pages on dataset_id = concat('d', page_id) where verdict = 'eligible')
select document_id, department_id, 'gs://raw/department=' || department_id || '/year=' || year || '/document_id=' || document_id || '/' || coalesce(nullif(name, ''), resource_id) || '.' || file_format as gcs_uri,
  source_url, title, document_type, file_format, language, try_cast(substr(date_published, 1, 10) as date) as published_date, checksum, 'success' as ingestion_status from k""")
def _(spark, sf):
    content = table(spark, sf, "pages").selectExpr("concat('d', page_id) as dataset_id", "cast(html as binary) as content")
    landed = judged(spark, sf).join(content, "dataset_id")
    return cat.document_records(landed).drop("department_code", "source_system", "year")


@check("document_keys", f"""select checksum, document_id, count(*) as copies from ({i.RAW_SQL}) group by checksum, document_id""")
def _(spark, sf):
    docs = table(spark, sf, "documents").selectExpr(f"{i.DOC_URL} as url", "cast(text as binary) as content")
    keyed = docs.select("url", checksum(F.col("content")).alias("checksum"))
    keyed = keyed.withColumn("document_id", document_id(F.col("url"), F.col("checksum")))
    return keyed.groupBy("checksum", "document_id").agg(F.count(F.lit(1)).alias("copies"))


@check("ingest_status_counts", f"select ingestion_status, file_format, count(*) as documents from ({i.RAW_SQL}) group by all")
def _(spark, sf):
    return cat.status_counts(i.raw_documents(spark, sf))


@check("ndjson_rows", """select concat('{"o_orderkey":', o_orderkey, ',"o_orderstatus":"', o_orderstatus, '","o_orderpriority":"', o_orderpriority, '","day":"', strftime(o_orderdate, '%Y-%m-%d'), '"}') as line from orders""")
def _(spark, sf):
    return ndjson(table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderstatus", "o_orderpriority", "cast(o_orderdate as date) as day"))


@check("stream_ingest", """select document_id, min(department_id) as department_id, count(distinct document_id) as rows from
 (select substr(sha256(concat('https://e.org/', event_type, '/', user_id) || '|' || sha256(props)), 1, 32) as document_id, event_type as department_id from events) group by document_id""")
def _(spark, sf):
    """New events landed as files, taken in by a stream: once, then again over files that are all known."""
    from factloom.sources.warehouse import Warehouse
    from factloom.streaming.documents import ingest_stream

    from .scratch import folder

    # Landed in two lots of files, so that the second trigger meets addresses and contents seen before.
    landed = table(spark, sf, "events").selectExpr(
        "event_type as department_id", "cast(event_id as string) as resource_id", "cast(event_id as string) as name",
        "'csv' as format", "concat('https://e.org/', event_type, '/', user_id) as url", "'en' as language",
        "cast(null as string) as date_published", "concat('Lot ', user_id) as title", "cast(props as binary) as content",
    )
    root = folder(spark, "stream")
    landed.write.parquet(root + "/landed")
    stored = Warehouse(spark, root + "/store")
    for _ in range(2):
        stream = spark.readStream.schema(landed.schema).parquet(root + "/landed")
        ingest_stream(stored, stream, root + "/checkpoint").awaitTermination()
        landed.write.mode("append").parquet(root + "/landed")
    return stored.read("raw_documents").groupBy("document_id").agg(
        F.min("department_id").alias("department_id"), F.count(F.lit(1)).alias("rows")
    )
