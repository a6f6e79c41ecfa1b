"""Published material made from the driver's tables: labels, headers, cells, files, facts.

Expressions are written once, in SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .kit import Grid, entity, q, spread, table

NL = "chr(10)"
DATE = "o_orderdate"


def two(x: str) -> str:
    return f"lpad(cast(({x}) % 100 as string), 2, '0')"


def fiscal_start(date: str) -> str:
    return f"(case when month({date}) >= 4 then year({date}) else year({date}) - 1 end)"


def fiscal_label(date: str) -> str:
    return f"concat({fiscal_start(date)}, '-', {two(fiscal_start(date) + ' + 1')})"


def money(x: str) -> str:
    return f"cast(cast({x} as decimal(18,2)) as string)"


def month_name(names: str, n: str) -> str:
    return f"split_part({q(names)}, ',', cast({n} as int))"


ENGLISH = "January,Feb.,March,Apr,MAY,June,Jul.,August,sep,October,Nov.,Dec"
FRENCH = "janvier,février,mars,avril,mai,juin,juillet,août,septembre,octobre,novembre,décembre"
FULL = "january,february,march,april,may,june,july,august,september,october,november,december"

TIME_LABEL = f"""case cast(o_orderkey % 10 as int)
 when 0 then {fiscal_label(DATE)} when 1 then concat({fiscal_start(DATE)}, '-', {fiscal_start(DATE)} + 1)
 when 2 then concat('Projection ', {fiscal_label(DATE)}) when 3 then cast(year({DATE}) as string)
 when 4 then concat({month_name(ENGLISH, f'month({DATE})')}, ' ', year({DATE}))
 when 5 then concat({month_name(FULL, f'month({DATE})')}, ' to ', {month_name(FULL, f'(month({DATE}) + 4) % 12 + 1')}, ' ', {fiscal_label(DATE)})
 when 6 then concat('Year 0', month({DATE})) when 7 then concat('forecast ', {fiscal_start(DATE)}, '–', {two(fiscal_start(DATE) + ' + 1')})
 when 8 then concat('  ', {month_name(FRENCH, f'month({DATE})')}, '  ', year({DATE}), ' ') else concat('bad ', o_orderstatus) end"""

HEADERS = [
    "concat('  ', upper(p_name), '  ( % ): ')", "'2019-20'", "'Projection 2024-2025'", "'Year 2'", "'Ontario'", "'qc'",
    "'@Geography'", "'@Sex_at_birth'", "'@DGUID'", "'Status'", "'VALUE'", "'@OBS_VALUE'", "'UOM'", "'per cent'",
    "'Population, 2016'", "'Total  revenues'", "'Forecast'", "'employmant'", "'Populatoin'", "'mployment'", "'Xopulation'", "concat(p_type, ' M$US')",
    "'April to June 2021-22'", "''", "concat('“', p_brand, '” — total')", "'Taux de chômage'",
]
HEADER_TEXT = "case cast(p_partkey % 26 as int) " + " ".join(
    f"when {i} then {h}" for i, h in enumerate(HEADERS)
) + " end"

# --- tables of every shape, as cells ----------------------------------------

PART_LABEL = """case cast(p_partkey % 7 as int) when 0 then 'Budgetary revenues' when 1 then 'Real GDP growth' when 2 then p_name
 when 3 then '  Program  expenses: ' when 4 then 'Ontario' when 5 then 'Code' else '' end"""
PART_TEXT = "case cast(p_partkey % 5 as int) when 0 then 'n/a' when 1 then '12.5 %' when 2 then '..' when 3 then '' else '(4)' end"

TIME_GRID = Grid("part", "fin", "concat('part-', p_brand)", "concat('tw-', p_brand)", "p_partkey", [
    ("", PART_LABEL),
    ("2021-22", "concat('$ ', p_size, ',', lpad(cast(p_partkey % 1000 as string), 3, '0'), '.5')"),
    ("2022-2023", PART_TEXT),
    ("Projection 2023-24", money("p_retailprice")),
    ("Year 2", "case when p_size > 25 then '-' else cast(p_size as string) end"),
    ("Notes", "p_type"),
])
GEO_GRID = Grid("orders", "fin", "concat('og-', o_orderpriority)", "concat('og-', o_orderpriority)", "o_orderkey", [
    ("Year", TIME_LABEL),
    ("Ontario", money("o_totalprice")),
    ("QC", "case when o_orderstatus = 'P' then 'x' else cast(o_custkey as string) end"),
    ("Total, Canada", "concat(o_custkey, '%')"),
])
DIMENSIONAL_GRID = Grid("orders", "fin", "concat('od-', o_orderstatus)", "concat('od-', o_orderstatus)", "o_orderkey", [
    ("CATEGORY", "o_orderstatus"),
    ("SUBJECT", "case when o_custkey % 11 = 0 then '' else concat(' ', o_orderpriority) end"),
    ("ITEM", "case when o_custkey % 3 = 0 then '' else 'Tax credit' end"),
    ("VALUE", f"case when o_custkey % 7 = 0 then '...' else {money('o_totalprice')} end"),
    ("2019-20", "cast(o_custkey as string)"),
    ("forecast 2020-21", "case when o_orderstatus = 'F' then 'F' else '7' end"),
])
LONG_GRID = Grid("orders", "statcan", "concat('ol-', o_orderpriority)", "concat('ol-', o_orderpriority)", "o_orderkey", [
    ("@TIME_PERIOD", f"case when o_custkey % 13 = 0 then '' else {TIME_LABEL} end"),
    ("@OBS_VALUE", f"case cast(o_custkey % 4 as int) when 0 then 'x' when 1 then '' else {money('o_totalprice')} end"),
    ("@Geography", "case cast(o_custkey % 5 as int) when 0 then 'Ontario' when 1 then '' when 2 then ' Quebec' else concat('35', o_custkey) end"),
])
CENSUS_GRID = Grid("customer", "statcan", "concat('cc-', c_mktsegment)", "concat('cc-', c_mktsegment)", "c_custkey", [
    ("DAUID2016", "case when c_nationkey = 3 then '' else lpad(cast(c_custkey as string), 7, '1') end"),
    ("Population, 2016", money("c_acctbal")),
    ("Average  income 2011, ", "case when c_nationkey % 2 = 0 then 'F' else cast(c_custkey as string) end"),
    ("Land area", "'9'"),
    ("POP2006", "cast(c_nationkey as string)"),
])
FINANCIAL_GRID = Grid("supplier", "tbs-sct", "concat('sf-', s_nationkey)", "concat('sf-', s_nationkey)", "s_suppkey", [
    ("Organization", "s_name"), ("Vote", "cast(s_nationkey as string)"),
    ("Amount", f"case when s_suppkey % 9 = 0 then 'n/a' else concat('$', {money('s_acctbal')}) end"),
])
SURVEY_GRID = Grid("customer", "tbs-sct", "concat('cs-', c_nationkey)", "concat('cs-', c_nationkey)", "c_custkey", [
    ("QUESTION", "c_mktsegment"), ("AGREE", "'1'"),
    ("SCORE100", "case when c_custkey % 6 = 0 then '' else cast(c_custkey % 100 as string) end"),
])
TAXONOMY_GRID = Grid("part", "statcan", "concat('px-', p_type)", "concat('px-', p_type)", "p_partkey", [
    ("Level", "cast(p_size as string)"), ("Code", "p_brand"), ("Class title", "p_name"),
])
GRIDS = {
    "time_columns": TIME_GRID, "geo_columns": GEO_GRID, "dimensional": DIMENSIONAL_GRID, "long": LONG_GRID,
    "census": CENSUS_GRID, "financial": FINANCIAL_GRID, "survey": SURVEY_GRID, "none": TAXONOMY_GRID,
}


def all_cells(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> DataFrame:
    parts = [GRIDS[n].cells(spark, sf_dir) for n in (names or GRIDS)]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together


def all_cells_sql(names: list[str] | None = None) -> str:
    return " union all ".join(GRIDS[n].sql() for n in (names or GRIDS))


# --- catalogue payloads ------------------------------------------------------

TITLE = """case cast(page_id % 12 as int) when 0 then 'Budget 2019 tables' when 1 then 'Main Estimates, 2020-21' when 2 then 'The Fiscal Monitor'
 when 3 then 'Economic and fiscal update 2021' when 4 then 'Survey of private sector forecasts' when 5 then 'Major transfers'
 when 6 then 'Proactive disclosure 1999' when 7 then 'PSES 2018' when 8 then 'InfoBase' when 9 then 'Food aid'
 when 10 then 'Debt charges 2034' else 'Labour' end"""
# (format, url, language json, name) of the resources of each dataset
RESOURCES = [
    ("'CSV'", "concat(split_part(url, '?', 1), '.csv')", """'["en"]'""", "concat('r', page_id)"),
    ("' xml '", "concat('/dataset/', page_id, '/data-fra.xml')", """'"en"'""", "''"),
    ("'html'", "url", """case when page_id % 3 = 0 then '["en","fr"]' when page_id % 3 = 1 then '["en"]' else '[]' end""", "'page'"),
    ("'PDF'", "concat(url, '.pdf')", "'\"fr\"'", "'pdf'"),
    ("'csv'", "concat('/dataset/', page_id, '/bundle.ZIP')", """'["en"]'""", "'zip'"),
    ("'json'", "''", "'null'", "'empty'"),
]


def _payload() -> str:
    resources = ", ',', ".join(
        f"""'{{"id":"x{i}","name":"', {name}, '","format":"', {fmt}, '","url":"', {url}, '","language":', {lang}, ',"size":', page_id, '}}'"""
        for i, (fmt, url, lang, name) in enumerate(RESOURCES)
    )
    english = f"case when page_id % 4 = 0 then '' else {TITLE} end"
    return (
        f"""concat('{{"id":"d', page_id, '","title":"Untitled ', page_id, '","title_translated":{{"en":"', {english}, """
        f"""'"}},"date_published":"2023-0', page_id % 9 + 1, '-1', page_id % 10, 'T10:00:00","resources":[', {resources}, ']}}')"""
    )


PAYLOAD = _payload()
PAGE_DEPARTMENT = "split_part(split_part(url, '/', 3), '.', 1)"


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, sf_dir, "pages").selectExpr(f"{PAGE_DEPARTMENT} as department_id", f"{PAYLOAD} as payload")


_ITEMS = " union all ".join(
    f"select department_id, p, json_extract(p, '$.resources[{i}]') as r from pl" for i in range(len(RESOURCES))
)
RESOURCE_SQL = f"""with pl as (select {PAGE_DEPARTMENT} as department_id, cast({PAYLOAD} as json) as p from pages),
items as ({_ITEMS}),
res as (select department_id, json_extract_string(p, '$.id') as dataset_id,
  coalesce(nullif(json_extract_string(p, '$.title_translated.en'), ''), json_extract_string(p, '$.title')) as title,
  json_extract_string(p, '$.date_published') as date_published, json_extract_string(r, '$.id') as resource_id,
  json_extract_string(r, '$.name') as name, json_extract_string(r, '$.format') as format,
  json_extract_string(r, '$.url') as url, json_extract(r, '$.language') as lang_json,
  cast(json_extract_string(r, '$.size') as bigint) as size from items)"""

# Addresses taken in before: the CSV resources of pages that share an id with a benchmark item.
# Every other one was taken in by another department, which does not count.
KNOWN_DEPARTMENT = f"case when page_id % 2 = 0 then {PAGE_DEPARTMENT} else 'elsewhere' end"
KNOWN_SQL = f"select {KNOWN_DEPARTMENT} as department_id, concat(split_part(url, '?', 1), '.csv') as source_url from pages where page_id in (select item_id from benchmark)"


def known_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, items = table(spark, sf_dir, "pages"), table(spark, sf_dir, "benchmark")
    return pages.join(items, F.col("page_id") == F.col("item_id"), "left_semi").selectExpr(
        f"{KNOWN_DEPARTMENT} as department_id", "concat(split_part(url, '?', 1), '.csv') as source_url"
    )


# --- raw documents from texts ------------------------------------------------

DOC_URL = "concat('https://', source, '.example.org/', lang, '/', n_chars, '.csv')"
DOC_STATUS = "case when n_chars % 11 = 0 then 'failed' else 'success' end"
DOC_FORMAT = "case lang when 'en' then 'csv' when 'fr' then 'xml' when 'de' then 'html' else 'json' end"


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per distinct address and content."""
    from factloom.functions.keys import checksum, document_id

    docs = spread(spark, sf_dir, "documents").selectExpr(
        "doc_id", "source as department_id", f"{DOC_URL} as source_url", f"{DOC_FORMAT} as file_format",
        f"{DOC_STATUS} as ingestion_status", "concat('Text ', lang, ' ', n_chars) as title", "text",
        "cast(text as binary) as content", "lang as language",
    )
    return docs.withColumn("checksum", checksum(F.col("content"))).withColumn(
        "document_id", document_id(F.col("source_url"), F.col("checksum"))
    )


RAW_SQL = f"""select doc_id, source as department_id, {DOC_URL} as source_url, {DOC_FORMAT} as file_format,
  {DOC_STATUS} as ingestion_status, concat('Text ', lang, ' ', n_chars) as title, text, lang as language, sha256(text) as checksum,
  substr(sha256({DOC_URL} || '|' || sha256(text)), 1, 32) as document_id from documents"""

# --- files with tables, one per order or part --------------------------------

CSV_BLOB = f"""concat('Item,', {fiscal_label(DATE)}, ',', year({DATE}), ',  ,Note', {NL}, '"Price, total",', {money('o_totalprice')}, ',"', o_custkey, ',5",drop,"said ""hi""', {NL},
 'there"', {NL}, ',,,,', {NL}, 'Priority 5" tall,', o_orderpriority, chr(13), {NL}, 'Long,1,2,3,4,5,6', {NL}, '  , ,', {NL}, {NL}, 'Last,', o_orderkey)"""

HTML_BLOB = """concat('<html><body><!-- <table><tr><td>no</td></tr></table> --><TABLE class="t"><tr><th>Item</th><th> Price &amp; s&#x69;&#122;e </th><th></th></tr>',
 '<tr><td>', p_name, ' <b>x</b> </td><td>', p_size, '&nbsp;</td><td>drop</td><td>wide</td></tr><tr><td> </td><td></td></tr>',
 '<tr><td>', p_type, '</td></tr></TABLE><p>between</p><table><tr><td>only</td></tr></table><table><tr><td>A&lt;b &eacute;&ndash;&#233;&amp;lt;</td></tr><tr><td>', p_brand, '</td></tr></table></body></html>')"""

SDMX_BLOB = """concat('<?xml version="1.0"?><m:Data xmlns:m="urn:m"><m:DataSet><m:Series GEO="', p_brand, '" UNIT="u"><m:Obs TIME_PERIOD="2019" OBS_VALUE="', p_size,
 '"/><m:Obs TIME_PERIOD="2020" OBS_VALUE="', p_partkey, '" UNIT="own" FLAG="a>&amp;&#98;"/></m:Series><m:Series GEO="all"><m:Obs TIME_PERIOD="2021"></m:Obs></m:Series></m:DataSet><m:DataSet/></m:Data>')"""
CODES_BLOB = """concat('<s:Structure xmlns:s="urn:s"><s:Codelist id="CL_', p_size, '"><s:Code value="1"><s:Name>', p_name, '</s:Name></s:Code><s:Code value="2"><s:Name><![CDATA[', p_type,
 ' <&amp;>]]></s:Name><s:Note/></s:Code></s:Codelist><s:Codelist id="EMPTY"></s:Codelist></s:Structure>')"""
GENERIC_BLOB = """concat('<root><meta a="1"/><row id="', p_partkey, '"><name>', p_name, '</name></row><!-- <row/> --><row id=''z>''><size>&#233;&lt;', p_size, '</size></row></root>')"""
SHEET_BLOB = """concat('<Workbook><Row>', p_name, '</Row></Workbook>')"""
BROKEN_BLOB = """concat('<root><row>', p_name, case when p_partkey % 10 = 4 then '</row>' else '<a></row></a></root>' end)"""
XML_BLOB = f"""case cast(p_partkey % 5 as int) when 0 then {SDMX_BLOB} when 1 then {CODES_BLOB} when 2 then {GENERIC_BLOB} when 3 then {SHEET_BLOB} else {BROKEN_BLOB} end"""


def blobs(spark: SparkSession, sf_dir: str, source: str, department: str, document: str, text: str) -> DataFrame:
    return spread(spark, sf_dir, source).selectExpr(
        f"{department} as department_id", f"{document} as document_id", "'' as title", f"{text} as text"
    )


def csv_blobs(spark, sf_dir):
    return blobs(spark, sf_dir, "orders", "'fin'", "cast(o_orderkey as string)", CSV_BLOB)


def html_blobs(spark, sf_dir):
    return blobs(spark, sf_dir, "part", "'fin'", "cast(p_partkey as string)", HTML_BLOB)


def xml_blobs(spark, sf_dir, text=XML_BLOB):
    return blobs(spark, sf_dir, "part", "'statcan'", "cast(p_partkey as string)", text)


# --- files in which elements stand within others of their name: one per order, from its lines ---

NESTED_HTML = """concat('<table><tr><th>Order</th><th>Lines</th><th> </th></tr><tr><td>', l_orderkey, '</td><td><TABLE border="0"><tr><th>No</th><th>Part</th></tr>',
 array_join(transform(line, x -> concat('<tr><td>', x.l_linenumber, '<td>', x.l_partkey, '</td></tr>')), ''), '</TABLE></td><td>drop</td></tr></table>')"""
NESTED_XML = """concat('<line><head>h</head>', array_join(transform(line, x -> concat(case when x.l_partkey % 2 = 0 then '<line' else '<x:line xmlns:x="u"' end, ' no="', x.l_linenumber, '"><part>', x.l_partkey,
 '</part>', case when x.l_linenumber % 2 = 0 then concat('<line no="inner">', x.l_suppkey, '<part>inner</part></line>') else '' end, case when x.l_partkey % 2 = 0 then '</line>' else '</x:line>' end)), ''), '</line>')"""


def line_blobs(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.expr("array_sort(collect_list(struct(l_linenumber, l_partkey, l_suppkey)))").alias("line")
    )
    return lines.selectExpr("'fin' as department_id", "cast(l_orderkey as string) as document_id", "'' as title", f"{text} as text")


# --- star schema over line items ---------------------------------------------

METRIC_NAME = "concat(p_type, ' ', p_brand)"
OBSERVATION = "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey)"
FACT_SQL = f"""select {OBSERVATION} as observation_id, r_name as department_id, cast(l_orderkey as varchar) as document_id,
  concat('t-', l_orderkey % 1000) as table_id, case when l_quantity > 49 then '' else {entity('metric', METRIC_NAME)} end as metric_id,
  case when l_discount > 0.09 then '' else {entity('time', fiscal_label('l_shipdate'))} end as time_id,
  case when l_tax < 0.02 then null else {entity('geo', 'n_name')} end as geography_id,
  case when l_linestatus = 'O' and l_linenumber = 7 then null when l_linenumber = 6 then floor(l_extendedprice) * 1e12 else l_extendedprice end as value_numeric,
  case when l_linestatus = 'O' and l_linenumber = 7 and l_returnflag = 'A' then 'x' end as value_text,
  case when l_returnflag = 'N' then 'CAD' when l_returnflag = 'R' and l_linenumber > 4 then 'USD' end as unit_raw,
  case when l_linenumber > 3 then l_discount * 10 end as confidence
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
  join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""


def star_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from factloom.functions.keys import entity_key

    t = lambda name: table(spark, sf_dir, name)
    joined = (
        t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        F.expr(OBSERVATION).alias("observation_id"), F.col("r_name").alias("department_id"),
        F.col("l_orderkey").cast("string").alias("document_id"), F.expr("concat('t-', l_orderkey % 1000)").alias("table_id"),
        F.when(F.col("l_quantity") > 49, "").otherwise(entity_key("metric", F.expr(METRIC_NAME))).alias("metric_id"),
        F.when(F.col("l_discount") > 0.09, "").otherwise(entity_key("time", F.expr(fiscal_label("l_shipdate")))).alias("time_id"),
        F.when(F.col("l_tax") >= 0.02, entity_key("geo", F.col("n_name"))).alias("geography_id"),
        F.expr("case when l_linestatus = 'O' and l_linenumber = 7 then null when l_linenumber = 6 then floor(l_extendedprice) * 1e12D else l_extendedprice end").alias("value_numeric"),
        F.expr("case when l_linestatus = 'O' and l_linenumber = 7 and l_returnflag = 'A' then 'x' end").alias("value_text"),
        F.expr("case when l_returnflag = 'N' then 'CAD' when l_returnflag = 'R' and l_linenumber > 4 then 'USD' end").alias("unit_raw"),
        F.expr("case when l_linenumber > 3 then l_discount * 10 end").alias("confidence"),
    )


DIM_METRIC_SQL = f"""select distinct {entity('metric', METRIC_NAME)} as metric_id, {METRIC_NAME} as canonical_name,
  p_type in ('ECONOMY', 'PROMO', 'SMALL') as is_additive from part"""
DIM_TIME_SQL = f"""select distinct {entity('time', fiscal_label('l_shipdate'))} as time_id, {fiscal_label('l_shipdate')} as label,
  make_date({fiscal_start('l_shipdate')}, 4, 1) as start_date from lineitem"""
DIM_GEO_SQL = f"select {entity('geo', 'n_name')} as geography_id, n_name as name_en, r_name as geo_type from nation join region on n_regionkey = r_regionkey"
DIM_DOCUMENT_SQL = """select cast(o_orderkey as varchar) as document_id, concat('Order ', o_orderkey, ' ', o_orderpriority) as title,
  case when o_custkey % 5 = 0 then '' else concat('https://example.org/', o_custkey) end as source_url, o_orderstatus as department_id from orders"""


def dim_metric(spark, sf_dir):
    from factloom.functions.keys import entity_key

    return table(spark, sf_dir, "part").selectExpr(
        f"{METRIC_NAME} as canonical_name", "p_type in ('ECONOMY', 'PROMO', 'SMALL') as is_additive"
    ).distinct().withColumn("metric_id", entity_key("metric", F.col("canonical_name")))


def dim_time(spark, sf_dir):
    from factloom.functions.keys import entity_key

    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{fiscal_label('l_shipdate')} as label", f"make_date({fiscal_start('l_shipdate')}, 4, 1) as start_date"
    ).distinct().withColumn("time_id", entity_key("time", F.col("label")))


def dim_geography(spark, sf_dir):
    from factloom.functions.keys import entity_key

    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        entity_key("geo", F.col("n_name")).alias("geography_id"), F.col("n_name").alias("name_en"),
        F.col("r_name").alias("geo_type"),
    )


def dim_document(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) as document_id", "concat('Order ', o_orderkey, ' ', o_orderpriority) as title",
        "case when o_custkey % 5 = 0 then '' else concat('https://example.org/', o_custkey) end as source_url",
        "o_orderstatus as department_id",
    )
