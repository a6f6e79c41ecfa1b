"""Checks of the scalar functions, the classifier and the resolver."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.dictionaries import LABEL_COLUMNS, Dictionaries
from factloom.functions.keys import entity_key
from factloom.functions.numeric import parse_numeric
from factloom.functions.periods import with_period
from factloom.functions.text import (
    GEO_ID_NAMES, MEASURE_WORDS, attribute_type_name, detect_language, header_without_years, header_year,
    infer_geo_type, is_measure_year_header, normalize_header,
)
from factloom.operators.cells import find_column
from factloom.operators.classify import classify_and_resolve, classify_headers, classify_texts, flat_periods
from factloom.operators.quality import refused_periods
from factloom.operators.reshape import composite_labels, headers_of

from . import inputs as i
from .kit import blank_null, check, classify_ctes, entity, in_list, language, norm, number, period_ctes, q, spread, strip, table


@check("normalize_header", f"""
select doc_id, {norm('text')} as normalized from documents
union all select -1 - p_partkey, {norm(i.HEADER_TEXT)} from part""")
def _(spark, sf):
    texts = spread(spark, sf, "documents").select(F.col("doc_id"), normalize_header(F.col("text")).alias("normalized"))
    headers = spread(spark, sf, "part").selectExpr("-1 - p_partkey as doc_id", f"{i.HEADER_TEXT} as h")
    return texts.unionByName(headers.select("doc_id", normalize_header(F.col("h")).alias("normalized")))


@check("detect_language", f"""
select doc_id, {language('text')} as language from documents
union all select -1 - p_partkey, {language(i.HEADER_TEXT)} from part""")
def _(spark, sf):
    texts = spread(spark, sf, "documents").select("doc_id", detect_language(F.col("text")).alias("language"))
    headers = spread(spark, sf, "part").selectExpr("-1 - p_partkey as doc_id", f"{i.HEADER_TEXT} as h")
    return texts.unionByName(headers.select("doc_id", detect_language(F.col("h")).alias("language")))


NUMBER_TEXT = f"""case cast(l_linenumber as int) when 1 then concat('$ ', {i.money('l_extendedprice')}) when 2 then concat(l_suppkey, ' %')
 when 3 then 'x' when 4 then concat('1d', l_returnflag) when 5 then concat('-', l_suppkey, ',000.5e1') when 6 then '...'
 else concat('(', l_suppkey, ')') end"""


@check("parse_numeric", f"""
with n as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, {NUMBER_TEXT} as raw from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, {number('raw')} as strict, {number('raw')} as loose from n""")
def _(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    raw = spread(spark, sf, "lineitem").selectExpr(*keys, f"{NUMBER_TEXT} as raw")
    return raw.select(
        *keys, parse_numeric(F.col("raw")).alias("strict"), parse_numeric(F.col("raw"), False).alias("loose")
    )


@check("parse_time", f"""with src as (select o_orderkey, {i.TIME_LABEL} as raw from orders), {period_ctes('src', 'raw', 'p')}
select o_orderkey, raw, p_type as time_type, p_label as label, p_start as start_date, p_end as end_date,
  p_projection as is_projection, p_hint as scenario_hint, p_type is not null as is_time_like from p""")
def _(spark, sf):
    labels = spread(spark, sf, "orders").selectExpr("o_orderkey", f"{i.TIME_LABEL} as raw")
    parsed = with_period(labels, F.col("raw"), "period")
    return parsed.select("o_orderkey", "raw", *flat_periods(parsed), F.col("period").isNotNull().alias("is_time_like"))


Y, M = "year(l_shipdate)", "month(l_shipdate)"
TWO = lambda x: f"lpad(cast(({x}) % 100 as string), 2, '0')"
# Spellings of periods, taken and refused, and texts that are none, with the reason that each was made to have.
SPELLED = [
    (f"concat({Y}, '-', {TWO(Y + ' + 1')})", "case when year = 1999 then 'century_turn' end"),
    (f"concat(' ', {Y}, '-', {TWO(Y + ' + 3')})", "case when (year + 3) % 100 between 1 and 12 then 'year_and_month' else 'years_not_neighbours' end"),
    (f"concat({Y}, '-', {TWO(M)})", "case when (year + 1) % 100 <> month(l_shipdate) then 'year_and_month' end"),
    (f"cast({Y} + 200 as string)", "'year_out_of_range'"),
    (f"concat('SEPT ', {Y})", "'unknown_month'"),
    (f"concat('Q', quarter(l_shipdate), ' ', {Y})", "'quarter'"),
    ("cast(cast(l_shipdate as date) as string)", "'day'"),
    (f"concat('January 31, ', {Y})", "'day'"),
    (f"concat({Y}, ' to ', {Y} + 2)", "'range_of_years'"),
    (f"concat('March ', {Y} - 150)", "'year_out_of_range'"),
    (f"concat('Projection ', {Y}, '-', {Y} + 5)", "'years_not_neighbours'"),
    (f"concat('Population ', {Y})", "null"),
    ("l_returnflag", "null"),
    ("'1999-00'", "'century_turn'"),
    (f"concat({Y}, '/99')", "'other_form'"),
    (f"concat('Year ', {M}, ' of ', {M})", "'other_form'"),
    (f"case when {M} > 6 then '' end", "null"),
    (f"concat('Actual ', {Y})", "null"),
]
SPELLING = f"case cast(l_partkey % {len(SPELLED)} as int) {' '.join(f'when {n} then {made}' for n, (made, _) in enumerate(SPELLED))} end"
PERIOD_WORDS = """'january','jan','janvier','february','feb','février','march','mar','mars','april','apr','avril','may','mai','june','jun','juin','july','jul','juillet','august','aug','août',
 'september','sep','septembre','october','oct','octobre','november','nov','novembre','december','dec','décembre','janv','févr','mär','avr','juil','sept','déc','q','quarter','trimestre',
 'to','à','and','et','year','fiscal','fy','calendar','projection','forecast','actual','historical','baseline','prévision'"""


@check("refused_periods", f"""with t as (select {SPELLING} as text, case cast(l_partkey % {len(SPELLED)} as int) {' '.join(f'when {n} then {r}' for n, (_, r) in enumerate(SPELLED))} end as reason
  from (select *, year(l_shipdate) as year from lineitem)),
w as (select *, regexp_extract_all(lower(text), '[a-zà-öø-ÿœ]+|[0-9]+') as words from t where reason is not null),
s as (select *, coalesce(list_sum(list_transform(list_filter(words, lambda x: x in ({PERIOD_WORDS}) or regexp_matches(x, '^([0-9]{{4}}|[0-9]{{1,2}})$')), lambda x: length(x))), 0)
  / list_sum(list_transform(words, lambda x: length(x))) as share from w)
select text, round(cast(share as double), 4) as score, reason, count(*) as occurrences from s group by all""")
def _(spark, sf):
    return refused_periods(spread(spark, sf, "lineitem").selectExpr(f"{SPELLING} as spelled"), "spelled")


@check("dimension_keys", f"""
select 'metric' as kind, p_name as label, {entity('metric', 'p_name')} as id, count(*) as uses from part group by p_name
union all select 'geo', n_name, {entity('geo', 'n_name')}, count(*) from customer join nation on c_nationkey = n_nationkey group by n_name
union all select 'time', l, {entity('time', 'l')}, count(*) from (select {i.fiscal_label('o_orderdate')} as l from orders) group by l""")
def _(spark, sf):
    part, orders = spread(spark, sf, "part"), spread(spark, sf, "orders")
    people = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    labels = (
        part.selectExpr("'metric' as kind", "p_name as label")
        .unionByName(people.selectExpr("'geo' as kind", "n_name as label"))
        .unionByName(orders.selectExpr("'time' as kind", f"{i.fiscal_label('o_orderdate')} as label"))
    )
    counted = labels.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("uses"))
    ids = F.when(F.col("kind") == "metric", entity_key("metric", F.col("label"))).when(
        F.col("kind") == "geo", entity_key("geo", F.col("label"))
    ).otherwise(entity_key("time", F.col("label")))
    return counted.select("kind", "label", ids.alias("id"), "uses")


@check("resolve_attribute", f"""
with h as (select p_partkey, concat('@', p_type, '_of  ', p_name, case when p_size > 9 then ':' else '' end) as raw from part)
select p_partkey, replace(substr({norm('raw')}, 2), '_', ' ') as type_name,
  {entity('attr_type', f"replace(substr({norm('raw')}, 2), '_', ' ')")} as attribute_type_id from h""")
def _(spark, sf):
    raw = F.concat(F.lit("@"), "p_type", F.lit("_of  "), "p_name", F.when(F.col("p_size") > 9, ":").otherwise(""))
    headers = spread(spark, sf, "part").select("p_partkey", raw.alias("raw"))
    resolved = classify_and_resolve(headers, "raw", Dictionaries.default(spark))
    return resolved.select(
        "p_partkey", attribute_type_name(F.col("raw")).alias("type_name"), F.col("mapping.attribute_type_id").alias("attribute_type_id")
    )


GEO_CODE = """case cast(c_custkey % 4 as int) when 0 then lpad(cast(c_custkey as string), 7, '3') when 1 then lpad(cast(c_custkey as string), 5, '4')
 when 2 then concat('HR ', c_custkey) else c_mktsegment end"""


@check("infer_geo_type", f"""
select c_custkey, case when regexp_matches({GEO_CODE}, '^\\d{{7}}$') then 'dissemination_area'
  when regexp_matches({GEO_CODE}, '^\\d{{5}}$') then 'census_subdivision'
  when contains({GEO_CODE}, 'HR') or contains({GEO_CODE}, 'Health') then 'health_region' else 'unknown' end as geo_type from customer""")
def _(spark, sf):
    codes = table(spark, sf, "customer").selectExpr("c_custkey", f"{GEO_CODE} as code")
    return codes.select("c_custkey", infer_geo_type(F.col("code")).alias("geo_type"))


@check("classify_header", f"""with src as (select p_partkey, {i.HEADER_TEXT} as raw from part), {classify_ctes('src', 'raw', 'c')}
select p_partkey, normalized, cls as header_class, conf as confidence, method, hint from c""")
def _(spark, sf):
    headers = spread(spark, sf, "part").selectExpr("p_partkey", f"{i.HEADER_TEXT} as raw")
    return classify_headers(headers, "raw", Dictionaries.default(spark)).select("p_partkey", "normalized", "verdict.*")


# Headers and row labels of line items: one text fills a third of the rows, an empty or missing one another part of them.
HEADER_OF_LINE = f"case when l_suppkey % 3 = 0 then 'Ontario' when l_suppkey % 7 = 0 then '' when l_suppkey % 11 = 0 then null else {i.HEADER_TEXT} end"
LABEL_OF_LINE = "case when l_suppkey % 5 = 0 then p_brand else concat(year(l_shipdate), '') end"
LINE_KEY = "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey)"


@check("classify_distinct", f"""with src as (select {LINE_KEY} as k, unnest(['header', 'label']) as part, unnest([{HEADER_OF_LINE}, {LABEL_OF_LINE}]) as raw from lineitem join part on l_partkey = p_partkey),
{classify_ctes('src', 'raw', 'c')} select k, part, cls as header_class, method, metric_id, time_id, geography_id from c""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.expr("l_partkey = p_partkey")).selectExpr(
        f"{LINE_KEY} as k", f"{HEADER_OF_LINE} as header", f"{LABEL_OF_LINE} as label"
    )
    read = classify_texts(lines, {"header": "h", "label": "l"}, Dictionaries.default(spark))
    return read.select("k", F.expr("stack(2, 'header', h, 'label', l) as (part, c)")).select(
        "k", "part", "c.verdict.header_class", "c.verdict.method", "c.mapping.metric_id", "c.mapping.time_id", "c.mapping.geography_id"
    )


LABELS_SQL = f"select o_orderkey as k, {i.TIME_LABEL} as raw from orders union all select -1 - p_partkey, {i.HEADER_TEXT} from part"


@check("resolve_mapping", f"""with src as ({LABELS_SQL}), {classify_ctes('src', 'raw', 'c')}
select k, metric_id, time_id, geography_id, scenario_id, attribute_type_id, cls = 'junk' as is_junk from c""")
def _(spark, sf):
    labels = spread(spark, sf, "orders").selectExpr("o_orderkey as k", f"{i.TIME_LABEL} as raw").unionByName(
        spread(spark, sf, "part").selectExpr("-1 - p_partkey as k", f"{i.HEADER_TEXT} as raw")
    )
    return classify_and_resolve(labels, "raw", Dictionaries.default(spark)).select("k", "mapping.*")


VALUE_NAMES = ["value", "amount", "score100", "@obs_value"]


@check("find_column", f"""
with h as (select distinct table_id, source_column_number as n, {strip('lower(header_raw)')} as name from ({i.all_cells_sql()})),
r as (select table_id, n, list_position([{', '.join(q(v) for v in VALUE_NAMES)}], name) as rank from h)
select table_id, arg_min(n, rank * 1000 + n) as column_number from r where rank > 0 group by table_id""")
def _(spark, sf):
    return find_column(headers_of(i.all_cells(spark, sf)), VALUE_NAMES)


@check("census_year_columns", f"""
with h as (select distinct table_id, source_column_number as column_number, header_raw from ({i.CENSUS_GRID.sql()}))
select table_id, column_number, regexp_extract(header_raw, '((19|20)\\d{{2}})', 1) as year,
  trim(regexp_replace(regexp_replace(header_raw, '(19|20)\\d{{2}}', '', 'g'), '[,.]?\\s+$', ''), ' ,.') as measure
from h where regexp_matches(header_raw, '(19|20)\\d{{2}}') and not regexp_matches(lower(header_raw), '^({"|".join(GEO_ID_NAMES)})')
  and regexp_matches(lower(header_raw), '{"|".join(MEASURE_WORDS)}')""")
def _(spark, sf):
    header = F.col("header_raw")
    return headers_of(i.CENSUS_GRID.cells(spark, sf)).filter(is_measure_year_header(header)).select(
        "table_id", "column_number", header_year(header).alias("year"), header_without_years(header).alias("measure")
    )


@check("composite_label", f"""
with c as (select table_id, source_row_number, source_column_number as n, {blank_null('value_raw')} as v, {strip('lower(header_raw)')} as name
  from ({i.all_cells_sql(['dimensional', 'census'])}))
select table_id, source_row_number,
  coalesce(string_agg(case when {in_list('name', LABEL_COLUMNS)} then v end, ' | ' order by n), max(case when n = 0 then v end)) as label
from c group by table_id, source_row_number""")
def _(spark, sf):
    return composite_labels(i.all_cells(spark, sf, ["dimensional", "census"]))
