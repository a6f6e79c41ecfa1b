"""Checks of mapping candidates, reviews and dimension tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.dictionaries import DIMENSION_COLUMNS, Dictionaries
from factloom.functions.keys import entity_key, row_key
from factloom.operators import candidates as cand
from factloom.operators import dimensions as dims
from factloom.operators.classify import classify_and_resolve
from factloom.operators.quality import orphan_report, orphans

from . import inputs as i
from .kit import (
    GEO_ROWS, GEO_TERMS, METRIC_ROWS, METRIC_TERMS, blank_null, check, classify_ctes, entity, in_list, key, norm, q, spread, strip, table,
)
from .reshape import ORACLES, facts as _facts

TABLE = "concat('h-', p_brand, '-', p_type)"
HEADERS_SQL = f"""h as (select distinct p_type as department_id, {TABLE} as table_id, {i.HEADER_TEXT} as header_raw from part),
hh as (select *, {key('table_id', 'header_raw')} as header_id from h), {classify_ctes('hh', 'header_raw', 'c')}"""
KINDS = [
    ("metric", "metric_id"), ("time", "time_id"), ("geography", "geography_id"), ("scenario", "scenario_id"),
    ("attribute_type", "attribute_type_id"),
]
DIRECT = " union all ".join(
    f"select header_id, '{kind}' as canonical_entity_type, {column} as canonical_entity_id, method as candidate_method, conf as candidate_score "
    f"from c where {column} is not null" for kind, column in KINDS
)
FUZZY = f"""select header_id, 'metric' as canonical_entity_type, {entity('metric', 'entity')} as canonical_entity_id, 'fuzzy' as candidate_method,
  max(1 - levenshtein(normalized, term) / greatest(length(normalized), length(term))) as candidate_score
  from c join {METRIC_TERMS} m on levenshtein(normalized, term) <= 2 where method = 'fallback' group by header_id, entity
  having max(1 - levenshtein(normalized, term) / greatest(length(normalized), length(term))) >= 0.5"""
ALL = f"""{HEADERS_SQL}, cand as (select * from ({DIRECT}) union all select * from ({FUZZY})),
mc as (select *, case when candidate_score >= 0.8 then true end as approved_flag from cand where candidate_score >= 0.5 or candidate_method = 'fallback')"""
PRIORITY = "list_position([" + ", ".join(q(p) for p in cand.PRIORITY) + "], candidate_method)"


def resolved(spark, sf):
    headers = table(spark, sf, "part").selectExpr(
        "p_type as department_id", f"{TABLE} as table_id", f"{i.HEADER_TEXT} as header_raw"
    ).distinct().withColumn("header_id", row_key(F.col("table_id"), F.col("header_raw")))
    return classify_and_resolve(headers, "header_raw", Dictionaries.default(spark))


def all_candidates(spark, sf):
    return cand.mapping_candidates(resolved(spark, sf), Dictionaries.default(spark))


@check("mapping_candidates", f"with {ALL} select * from mc")
def _(spark, sf):
    return all_candidates(spark, sf)


@check("fuzzy_candidates", f"with {HEADERS_SQL} {FUZZY}")
def _(spark, sf):
    return cand.fuzzy_candidates(resolved(spark, sf), Dictionaries.default(spark))


# Words of the documents against the names of parts and the words of the benchmark, and long texts of both kinds.
WORDS_SQL = """select distinct w as text from (select unnest(string_split_regex(text, '[^a-z]+')) as w from documents where lang = 'en') where w <> ''
  union select distinct concat(p_brand, ' of the kind ', p_name, ' ', p_size % 3) from part"""
TERMS_SQL = """select distinct w as term from (select unnest(string_split_regex(text, '[^a-z]+')) as w from benchmark) where w <> ''
  union select distinct concat('xrand#', o_custkey % 30, ' of the kind ', p_name) from orders join part on o_orderkey = p_partkey"""


@check("fuzzy_all_pairs", f"""with x as ({WORDS_SQL}), t as ({TERMS_SQL})
select text, term, cast(levenshtein(text, term) as int) as edits from x join t on abs(length(text) - length(term)) <= 2 and levenshtein(text, term) <= 2""")
def _(spark, sf):
    words = lambda df: df.select(F.explode(F.split("text", "[^a-z]+")).alias("w")).filter("w <> ''")
    texts = words(spread(spark, sf, "documents").filter("lang = 'en'")).unionByName(
        table(spark, sf, "part").selectExpr("concat(p_brand, ' of the kind ', p_name, ' ', p_size % 3) as w")
    )
    terms = words(table(spark, sf, "benchmark")).unionByName(
        table(spark, sf, "orders").join(table(spark, sf, "part"), F.expr("o_orderkey = p_partkey"))
        .selectExpr("concat('xrand#', o_custkey % 30, ' of the kind ', p_name) as w")
    )
    return cand.near_terms(texts.withColumnRenamed("w", "text"), terms.withColumnRenamed("w", "term"))


RULES_SQL = f"""select distinct {norm('p_name')} as normalized, case when p_size > 25 then p_type end as department_id,
  case when p_size > 40 then 'budget' end as document_type, 'metric' as entity_type, {entity('metric', 'p_brand')} as entity_id from part"""


@check("best_mapping", f"""with {ALL}, rules as ({RULES_SQL}),
scoped as (select header_id, entity_type as canonical_entity_type, entity_id as canonical_entity_id,
  case when r.department_id is null then 'exact_rule' else 'scoped_rule' end as candidate_method, cast(1 as double) as candidate_score
  from (select header_id, {norm("replace(replace(header_raw, '%', ''), '(', '')")} as n, department_id, 'budget' as document_type from hh) x join rules r
  on rtrim(rtrim(x.n, ': )')) = r.normalized and (r.department_id is null or r.department_id = x.department_id) and (r.document_type is null or r.document_type = x.document_type)),
everything as (select header_id, canonical_entity_type, canonical_entity_id, candidate_method, candidate_score from mc union all select * from scoped)
select * from everything qualify row_number() over (partition by header_id, canonical_entity_type
  order by {PRIORITY}, candidate_score desc, canonical_entity_id) = 1""")
def _(spark, sf):
    from factloom.functions.text import normalize_header

    known = resolved(spark, sf)
    bare = normalize_header(F.replace(F.replace("header_raw", F.lit("%"), F.lit("")), F.lit("("), F.lit("")))
    headers = known.select(
        "header_id", "department_id", F.rtrim(F.rtrim(bare, F.lit(": )"))).alias("normalized"),
        F.lit("budget").alias("document_type"),
    )
    rules = table(spark, sf, "part").select(
        normalize_header(F.col("p_name")).alias("normalized"), F.when(F.col("p_size") > 25, F.col("p_type")).alias("department_id"),
        F.when(F.col("p_size") > 40, "budget").alias("document_type"), F.lit("metric").alias("entity_type"),
        entity_key("metric", F.col("p_brand")).alias("entity_id"),
    ).distinct()
    together = cand.mapping_candidates(known, Dictionaries.default(spark), cand.scoped_candidates(headers, rules))
    return cand.best_mapping(together)


@check("review_queue", f"""with {ALL} select mc.header_id, department_id, header_raw, canonical_entity_type, canonical_entity_id, candidate_method, candidate_score
from mc join hh on mc.header_id = hh.header_id where not coalesce(approved_flag, false) and candidate_score < 0.8 and department_id = 'ECONOMY'
""")
def _(spark, sf):
    return cand.review_queue(all_candidates(spark, sf), resolved(spark, sf), "ECONOMY")


DECISIONS = f"""select {key(TABLE, i.HEADER_TEXT)} as header_id, p_size % 2 = 0 as approved, concat('reviewer ', p_size) as reviewer, p_partkey as decided_at
  from part"""


@check("apply_reviews", f"""with {ALL}, d as (select * from ({DECISIONS}) qualify row_number() over (partition by header_id order by decided_at desc) = 1)
select mc.header_id, canonical_entity_type, canonical_entity_id, candidate_method, candidate_score, coalesce(approved, approved_flag) as approved_flag,
  reviewer as approved_by, decided_at as approved_at from mc left join d on mc.header_id = d.header_id""")
def _(spark, sf):
    part = table(spark, sf, "part").selectExpr("*", f"{TABLE} as t", f"{i.HEADER_TEXT} as h")
    decisions = part.select(
        row_key(F.col("t"), F.col("h")).alias("header_id"), F.expr("p_size % 2 = 0").alias("approved"),
        F.expr("concat('reviewer ', p_size)").alias("reviewer"), F.col("p_partkey").alias("decided_at"),
    )
    return cand.apply_reviews(all_candidates(spark, sf), decisions)


@check("mapping_qc", f"""with {HEADERS_SQL} select department_id, count(*) as headers_seen, count(*) filter (cls <> 'junk' and conf >= 0.8) as auto_mapped,
  count(*) filter (cls <> 'junk' and conf < 0.8 and conf >= 0.5) as review_required, count(*) filter (cls <> 'junk' and conf < 0.5) as unmapped,
  count(*) filter (cls = 'junk') as junk, round(count(*) filter (conf >= 0.5) / count(*), 6) as share_classified,
  round(count(*) filter (cls <> 'junk' and conf >= 0.8) / count(*), 6) as share_mapped from c group by department_id""")
def _(spark, sf):
    return cand.mapping_counts(resolved(spark, sf))


@check("mapping_warnings", f"""with {ALL} select header_id, canonical_entity_type, count(*) as candidates, count(distinct canonical_entity_id) as entities
from mc group by header_id, canonical_entity_type having count(distinct canonical_entity_id) > 1""")
def _(spark, sf):
    return cand.mapping_warnings(all_candidates(spark, sf))


# --- dimensions --------------------------------------------------------------

LABELS = f"select distinct label_raw from (select {i.TIME_LABEL} as label_raw from orders union all select {i.HEADER_TEXT} from part union all select p_name || ' | ' || p_type from part)"


def labels(spark, sf):
    part = table(spark, sf, "part")
    return (
        spread(spark, sf, "orders").selectExpr(f"{i.TIME_LABEL} as label_raw")
        .unionByName(part.selectExpr(f"{i.HEADER_TEXT} as label_raw"))
        .unionByName(part.selectExpr("p_name || ' | ' || p_type as label_raw"))
    )


@check("build_dims", f"""with l as ({LABELS}), {classify_ctes('l', 'label_raw', 'c')},
g as (select distinct {strip('label_raw')} as t from l where {strip('label_raw')} <> '')
select 'time' as dimension, time_id as id, min(p_label) as name, min(p_type) as kind, min(p_start) as start_date, max(p_end) as end_date, bool_and(p_projection) as flag
  from c where time_id is not null group by time_id
union all select 'metric', metric_id, min(coalesce(name_en, {strip('label_raw')})),
  min(coalesce(family, case when contains(label_raw, ' | ') then 'composite_dimensional' else 'unresolved' end)), null, null, coalesce(bool_or(is_additive), false)
  from c left join {METRIC_ROWS} m on m.entity = metric_key where metric_id is not null group by metric_id
union all select 'geography', {entity('geo', f"coalesce(x.code, {norm('t')})")} as gid, min(coalesce(r.name_en, t)), min(coalesce(r.geo_type, 'unknown')), null, null, null
  from g left join {GEO_TERMS} x on x.term = {norm('t')} left join {GEO_ROWS} r on r.code = x.code group by gid""")
def _(spark, sf):
    found, known = labels(spark, sf), Dictionaries.default(spark)
    time = dims.build_dim_time(found, known).selectExpr(
        "'time' as dimension", "time_id as id", "label as name", "time_type as kind", "start_date", "end_date", "is_projection as flag"
    )
    no_date = ["cast(null as date) as start_date", "cast(null as date) as end_date"]
    metric = dims.build_dim_metric(found, known).selectExpr(
        "'metric' as dimension", "metric_id as id", "canonical_name as name", "metric_family as kind", *no_date, "is_additive as flag"
    )
    geo = dims.build_dim_geography(found, known).selectExpr(
        "'geography' as dimension", "geography_id as id", "name_en as name", "geo_type as kind", *no_date, "cast(null as boolean) as flag"
    )
    return time.unionByName(metric).unionByName(geo)


STORED = "select c_custkey as k, c_name as name, c_mktsegment as segment, c_acctbal as balance from customer where c_acctbal > 2000"
INCOMING = "select c_custkey as k, case when c_nationkey > 12 then upper(c_name) end as name, c_acctbal * 2 as balance from customer where c_acctbal < 6000"


@check("dim_upsert", f"""select k, coalesce(n.name, s.name) as name, s.segment as segment, coalesce(n.balance, s.balance) as balance
from ({STORED}) s full join ({INCOMING}) n using (k)""")
def _(spark, sf):
    people = table(spark, sf, "customer")
    stored = people.filter("c_acctbal > 2000").selectExpr("c_custkey as k", "c_name as name", "c_mktsegment as segment", "c_acctbal as balance")
    incoming = people.filter("c_acctbal < 6000").selectExpr(
        "c_custkey as k", "case when c_nationkey > 12 then upper(c_name) end as name", "c_acctbal * 2 as balance"
    )
    return dims.upsert(stored, incoming, "k")


@check("build_dim_document", f"""with d as ({i.DIM_DOCUMENT_SQL}), f as ({i.FACT_SQL})
select document_id, department_id, title, source_url from d where document_id in (select document_id from f)""")
def _(spark, sf):
    return dims.build_dim_document(i.dim_document(spark, sf), i.star_facts(spark, sf)).select(
        "document_id", "department_id", "title", "source_url"
    )


BRIDGE_SQL = f"""d as (select table_id, source_row_number, {strip('lower(header_raw)')} as t, {blank_null('value_raw')} as v, {norm('value_raw')} as n from ({i.DIMENSIONAL_GRID.sql()})),
dd as (select *, {entity('attr_val', "concat(t, '|', n)")} as attribute_value_id from d where v is not null and {in_list('t', DIMENSION_COLUMNS)})"""


@check("attribute_bridge", f"""with {BRIDGE_SQL}, f as (select * from ({ORACLES['dimensional']})) select distinct observation_id, attribute_value_id from f join dd using (table_id, source_row_number)""")
def _(spark, sf):
    cells = i.DIMENSIONAL_GRID.cells(spark, sf)
    return dims.attribute_bridge(cells, _facts(spark, sf, ["dimensional"]))[0]


@check("attribute_values", f"""with {BRIDGE_SQL} select attribute_value_id, min({entity('attr_type', 't')}) as attribute_type_id, min(v) as value_en, min(n) as normalized_value
from dd group by attribute_value_id""")
def _(spark, sf):
    cells = i.DIMENSIONAL_GRID.cells(spark, sf)
    return dims.attribute_bridge(cells, _facts(spark, sf, ["dimensional"]))[1].drop("value_fr")


@check("seed_dims", f"""
select 'geography' as dimension, {entity('geo', 'n_name')} as id, n_name as name from nation
union all select distinct 'metric', {entity('metric', 'p_name')}, upper(p_name) from part
union all select distinct 'attribute_type', {entity('attr_type', 'p_type')}, p_type from part
union all select distinct 'attribute_value', {entity('attr_val', "concat(p_type, '|', p_brand)")}, p_brand from part
union all select 'scenario', {entity('scenario', 'c_mktsegment')}, c_mktsegment from customer group by c_mktsegment
union all select 'metric_in_use', m.metric_id, m.canonical_name from ({i.DIM_METRIC_SQL}) m""")
def _(spark, sf):
    part, none = table(spark, sf, "part"), F.array().cast("array<string>")
    metrics = part.select(
        F.col("p_name").alias("metric_key"), F.upper("p_name").alias("name_en"), F.lit("").alias("name_fr"), F.lit("x").alias("family"),
        F.lit("u").alias("unit"), F.lit(False).alias("is_additive"), F.array("p_name").alias("synonyms"),
    ).distinct()
    geographies = table(spark, sf, "nation").select(
        F.col("n_name").alias("code"), F.lit("nation").alias("geo_type"), F.col("n_name").alias("name_en"), F.lit("").alias("name_fr"), none.alias("synonyms")
    )
    scenarios = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("scenario_key"), F.array("c_mktsegment").alias("synonyms")).distinct()
    values = F.array_sort(F.collect_set(F.struct(F.col("p_brand").alias("key"), F.col("p_brand").alias("en"), F.lit("").alias("fr"))))
    attributes = part.groupBy(F.col("p_type").alias("type_key"), F.col("p_type").alias("type_name")).agg(values.alias("values"))
    known = Dictionaries.from_tables(spark, geographies, scenarios, metrics, attributes)
    seeded = dims.seed_dimensions(known)
    pick = lambda layer, kind, key_, name: seeded[layer].select(F.lit(kind).alias("dimension"), F.col(key_).alias("id"), F.col(name).alias("name"))
    return (
        pick("dim_geography", "geography", "geography_id", "name_en")
        .unionByName(pick("dim_metric", "metric", "metric_id", "canonical_name"))
        .unionByName(pick("dim_attribute_type", "attribute_type", "attribute_type_id", "attribute_type_name"))
        .unionByName(pick("dim_attribute_value", "attribute_value", "attribute_value_id", "value_en"))
        .unionByName(pick("dim_scenario", "scenario", "scenario_id", "scenario_name"))
        .unionByName(i.dim_metric(spark, sf).select(F.lit("metric_in_use").alias("dimension"), F.col("metric_id").alias("id"), F.col("canonical_name").alias("name")))
    )


@check("dictionary_tables", f"""with terms as (select lower(t) as term, min(p_name) as metric_key from (select p_name, unnest([p_name, concat(p_name, 's'), p_brand]) as t from part) group by lower(t)),
{classify_ctes('labels_', 'raw', 'c').replace('labels_', '(select p_partkey, case when p_size > 25 then p_brand else p_name end as raw from part)')}
select p_partkey, {entity('metric', 'coalesce(t.metric_key, normalized)')} as metric_id, case when t.metric_key is not null then 'metric_dictionary' else method end as method
from c left join terms t on t.term = normalized""")
def _(spark, sf):
    part, none = table(spark, sf, "part"), F.array().cast("array<string>")
    metrics = part.select(
        F.col("p_name").alias("metric_key"), F.col("p_name").alias("name_en"), F.lit("").alias("name_fr"), F.lit("x").alias("family"),
        F.lit("u").alias("unit"), F.lit(False).alias("is_additive"), F.array("p_name", F.concat("p_name", F.lit("s")), "p_brand").alias("synonyms"),
    )
    base = Dictionaries.default(spark)
    known = Dictionaries.from_tables(spark, base.geographies, base.scenarios, metrics)
    texts = part.selectExpr("p_partkey", "case when p_size > 25 then p_brand else p_name end as raw")
    return classify_and_resolve(texts, "raw", known).select(
        "p_partkey", F.col("mapping.metric_id").alias("metric_id"), F.col("verdict.method").alias("method")
    )


SPARSE_METRIC = f"select * from ({i.DIM_METRIC_SQL}) where canonical_name not like 'PROMO%'"


@check("orphan_facts", f"""with f as ({i.FACT_SQL})
select 'metric_id' as dimension_key, count(distinct metric_id) as missing_keys, count(*) as observations from f where metric_id <> '' and metric_id not in (select metric_id from ({SPARSE_METRIC}))
union all select 'geography_id', count(distinct geography_id), count(*) from f where geography_id is not null and geography_id not in (select geography_id from ({i.DIM_GEO_SQL}) where geo_type <> 'ASIA')
union all select 'listed', count(distinct metric_id), count(*) from f where metric_id <> '' and metric_id not in (select metric_id from ({SPARSE_METRIC}))""")
def _(spark, sf):
    facts = i.star_facts(spark, sf)
    metrics = i.dim_metric(spark, sf).filter("canonical_name not like 'PROMO%'")
    report = orphan_report(facts, {
        "metric_id": metrics, "time_id": i.dim_time(spark, sf), "geography_id": i.dim_geography(spark, sf).filter("geo_type != 'ASIA'"),
    })
    listed = orphans(facts, metrics, "metric_id").groupBy("metric_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.lit("listed").alias("dimension_key"), F.count(F.lit(1)).alias("missing_keys"), F.sum("n").alias("observations")
    )
    return report.unionByName(listed)


@check("additive_totals", f"""with f as ({i.FACT_SQL}) select canonical_name, department_id, cast(cast(sum(cast(cast(value_numeric as varchar) as decimal(28,4))) as varchar) as double) as total, count(*) as observations
from f join ({i.DIM_METRIC_SQL}) m using (metric_id) where is_additive and value_numeric is not null group by canonical_name, department_id""")
def _(spark, sf):
    return dims.additive_totals(i.star_facts(spark, sf), i.dim_metric(spark, sf), ["department_id"])
