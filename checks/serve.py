"""Checks of the look-ups, lists, citations and the query audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.operators import serve as sv

from . import inputs as i
from .kit import check, entity, q, table

STAR = f"f as ({i.FACT_SQL}), dm as ({i.DIM_METRIC_SQL}), dt as ({i.DIM_TIME_SQL}), dg as ({i.DIM_GEO_SQL}), dd as ({i.DIM_DOCUMENT_SQL})"

COVERAGE = "select department_id, count(*) as observations, count(distinct metric_id) as distinct_metrics, count(distinct document_id) as documents from f group by department_id"
METRICS = "select canonical_name, count(observation_id) as obs from f join dm using (metric_id) group by canonical_name"
TIMES = "select label, count(observation_id) as obs from f join dt using (time_id) group by label"
AREAS = "select name_en, geo_type, count(observation_id) as obs from dg {how} join f using (geography_id) group by name_en, geo_type"


@check("coverage_by_department", f"with {STAR} {COVERAGE}")
def _(spark, sf):
    return sv.coverage_by_department(i.star_facts(spark, sf))


@check("coverage_one_department", f"with {STAR} select * from ({COVERAGE}) where department_id = 'ASIA'")
def _(spark, sf):
    return sv.coverage_by_department(sv.for_department(sv.for_department(i.star_facts(spark, sf), "all"), "ASIA"))


@check("top_metrics", f"with {STAR} {METRICS} order by obs desc, canonical_name limit 30")
def _(spark, sf):
    return sv.top_metrics(i.star_facts(spark, sf), i.dim_metric(spark, sf))


@check("metric_search", f"with {STAR} select * from ({METRICS}) where lower(canonical_name) like '%economy brand#1%' order by obs desc, canonical_name limit 25")
def _(spark, sf):
    return sv.list_metrics(i.star_facts(spark, sf), i.dim_metric(spark, sf), "Economy brand#1")


@check("time_periods", f"with {STAR} {TIMES} order by obs desc, label limit 40")
def _(spark, sf):
    return sv.list_time_periods(i.star_facts(spark, sf), i.dim_time(spark, sf))


@check("geographies", f"with {STAR} {AREAS.format(how='left')}")
def _(spark, sf):
    return sv.list_geographies(i.star_facts(spark, sf), i.dim_geography(spark, sf))


@check("describe_coverage", f"""with {STAR}
select 'coverage_by_department' as section, department_id as name, cast(null as varchar) as detail, observations, documents from ({COVERAGE})
union all select * from (select 'top_30_metrics', canonical_name, null, obs, null from ({METRICS}) order by obs desc, canonical_name limit 30)
union all select 'time_periods', label, null, obs, null from ({TIMES})
union all select 'named_geographies_with_data', name_en, geo_type, obs, null from ({AREAS.format(how='inner')})""")
def _(spark, sf):
    return sv.describe_coverage(
        i.star_facts(spark, sf), i.dim_metric(spark, sf), i.dim_time(spark, sf), i.dim_geography(spark, sf)
    )


LOOKUP = "from f join dm using (metric_id) left join dt using (time_id) join dd using (document_id)"


@check("metric_lookup", f"""with {STAR} select canonical_name as metric, label as year, value_numeric, title, source_url {LOOKUP}
where canonical_name = 'ECONOMY Brand#1' and label = '1998-99' order by value_numeric desc nulls last, observation_id limit 20""")
def _(spark, sf):
    return sv.metric_lookup(
        i.star_facts(spark, sf), i.dim_metric(spark, sf), i.dim_time(spark, sf), i.dim_document(spark, sf),
        "ECONOMY Brand#1", "1998-99",
    )


@check("metric_history", f"""with {STAR} select canonical_name as metric, label as year, value_numeric, title, source_url {LOOKUP}
where contains(canonical_name, 'Brand#12') and value_numeric is not null order by label desc nulls last, value_numeric desc, observation_id limit 50""")
def _(spark, sf):
    return sv.metric_history(
        i.star_facts(spark, sf), i.dim_metric(spark, sf), i.dim_time(spark, sf), i.dim_document(spark, sf), "Brand#12"
    )


@check("geo_lookup", f"""with {STAR} select canonical_name as metric, label as year, name_en as geography, value_numeric, title, source_url {LOOKUP}
join dg using (geography_id) where name_en = 'NATION_7' order by value_numeric desc nulls last, observation_id limit 50""")
def _(spark, sf):
    return sv.geo_lookup(
        i.star_facts(spark, sf), i.dim_metric(spark, sf), i.dim_time(spark, sf), i.dim_geography(spark, sf),
        i.dim_document(spark, sf), "NATION_7",
    )


@check("preview", f"""with {STAR}, r as (select observation_id, value_numeric from f)
select *, (select count(*) from r) as rows_returned from r order by observation_id limit 30""")
def _(spark, sf):
    result = i.star_facts(spark, sf).select("observation_id", "value_numeric")
    return sv.preview(result, ["observation_id"])


@check("metric_growth", f"""with {STAR}, y as (select canonical_name, label, start_date, sum(cast(cast(value_numeric as varchar) as decimal(28,4))) as total
  from f join dm using (metric_id) join dt using (time_id) where value_numeric is not null group by canonical_name, label, start_date),
l as (select *, lag(total) over (partition by canonical_name order by start_date, label) as p from y)
select canonical_name, label, cast(cast(total as varchar) as double) as total, cast(cast(p as varchar) as double) as previous,
  cast(cast(total - p as varchar) as double) as change from l""")
def _(spark, sf):
    return sv.metric_growth(i.star_facts(spark, sf), i.dim_metric(spark, sf), i.dim_time(spark, sf))


TABLES_SQL = """select cast(l_orderkey as varchar) as document_id, concat(l_linenumber, '-', l_partkey, '-', l_suppkey) as table_id, l_partkey as table_index,
  case when l_linenumber > 1 then concat('Table ', l_partkey) end as table_title_raw, case when l_linenumber > 4 then l_returnflag end as sheet_name,
  cast(l_linenumber as bigint) as page_number from lineitem"""
CITED = f"""with {STAR}, et as ({TABLES_SQL}), ids as (select distinct document_id from f),
c as (select dd.document_id, title, source_url, department_id as department, table_title_raw as table_title, sheet_name, page_number from dd left join et using (document_id)
  where document_id in (select document_id from ids) qualify row_number() over (partition by dd.document_id order by table_index, table_id) = 1)"""


def cited(spark, sf):
    facts = i.star_facts(spark, sf)
    ids = facts.select("document_id").distinct()
    tables = table(spark, sf, "lineitem").selectExpr(
        "cast(l_orderkey as string) as document_id", "concat(l_linenumber, '-', l_partkey, '-', l_suppkey) as table_id",
        "l_partkey as table_index", "case when l_linenumber > 1 then concat('Table ', l_partkey) end as table_title_raw",
        "case when l_linenumber > 4 then l_returnflag end as sheet_name", "cast(l_linenumber as bigint) as page_number",
    )
    return sv.citations(ids, i.dim_document(spark, sf), tables)


@check("citations", f"{CITED} select * from c")
def _(spark, sf):
    return cited(spark, sf)


@check("citations_text", f"""{CITED} select document_id, concat_ws(chr(10), concat('- ', title), case when source_url <> '' then '  URL: ' || source_url end,
  case when department <> '' then '  Department: ' || department end, case when table_title <> '' then '  Table: ' || table_title end) as citation from c""")
def _(spark, sf):
    return sv.citation_text(cited(spark, sf))


AUDITED = """case cast(o_orderkey % 9 as int) when 0 then concat('select * from `cur.fact_observation` where value_numeric > ', o_custkey)
 when 1 then concat('SELECT 1 FROM `cur.dim_metric` LIMIT ', o_custkey * 10) when 2 then concat('DROP TABLE t', o_custkey)
 when 3 then concat('SELECT a FROM `raw.documents` WHERE id = ', o_custkey) when 4 then concat('  select x from `p.quality.observation_quality`; ')
 when 5 then concat('SELECT updated_at FROM `cur.t` limit 20 -- ', o_custkey) when 6 then concat('select 1; delete from x where y = ', o_custkey)
 when 7 then concat('with a as (select ', o_custkey, ') select * from a') else concat('SELECT `a`, limits FROM `quality.q` WHERE b = ', o_custkey) end"""


@check("query_audit", f"""with s as (select o_orderkey, {AUDITED} as sql from orders),
r as (select *, upper(sql) as u, list_transform(regexp_extract_all(sql, '`([^`]+)`', 1), lambda n: string_split(n, '.')) as refs from s),
v as (select *, case when not starts_with(trim(u), 'SELECT') then 'not_select'
  when regexp_matches(u, '\\b(INSERT|UPDATE|DELETE|DROP|CREATE|ALTER|TRUNCATE|MERGE|GRANT|REVOKE)\\b') then 'forbidden_keyword'
  when len(list_filter(refs, lambda p: len(p) >= 2 and (case when len(p) = 3 then p[2] else p[1] end) not in ('cur', 'quality'))) > 0 then 'closed_schema' end as reason from r),
l as (select *, case when not contains(u, 'LIMIT') then rtrim(rtrim(sql), ';') || chr(10) || 'LIMIT 1000'
  when try_cast(regexp_extract(u, 'LIMIT\\s+(\\d+)', 1) as bigint) > 1000 then regexp_replace(sql, '(?i)LIMIT\\s+\\d+', 'LIMIT 1000', 'g') else sql end as lim from v)
select o_orderkey, sql, reason is null as allowed, reason, case when reason is null then replace(replace(lim, '`cur.', '`open.cur.'), '`quality.', '`open.quality.') end as runnable from l""")
def _(spark, sf):
    texts = table(spark, sf, "orders").selectExpr("o_orderkey", f"{AUDITED} as sql")
    return sv.query_audit(texts, "open")
