"""Checks of table shapes, observations, quality and yield."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.dictionaries import LABEL_COLUMNS, Dictionaries
from factloom.functions.text import GEO_ID_NAMES, MEASURE_WORDS
from factloom.operators.cells import pivot_grid, table_dimensions
from factloom.operators.quality import conflicting_units, constraint_report, null_rates, score_observations
from factloom.operators.reshape import capped, headers_of, observations, table_specs
from factloom.plans.normalize import pending_tables, table_yield

from . import inputs as i
from .scratch import written
from .kit import GEO_TERMS, METRIC_TERMS, check, classify_ctes, entity, in_list, key, norm, number, period_ctes, q, strip

OUT = [
    "observation_id", "department_id", "document_id", "table_id", "metric_id", "time_id", "geography_id",
    "scenario_id", "value_numeric", "value_text", "source_row_number", "source_column_number",
]


def time_key(label: str | None) -> str:
    return entity("time", q(label)) if label else "''"


def emit(grid, joined: str, metric: str, row_time: str | None, geo: str, keep: str, columns, shape: str) -> str:
    """Union of one select per emitted column: (position, period label, scenario key, geography code, metric key)."""
    by_cell = shape not in ("long", "financial", "survey")
    parts = []
    for position, label, scenario, code, own_metric in columns:
        value = f"c{position}"
        ident = key("table_id", "r", str(position)) if by_cell else (
            key("table_id", "'survey'", "r") if shape == "survey" else key("table_id", "r")
        )
        with_text = shape in ("time_columns", "long")
        text = f"case when {number(value)} is null then {value} end" if with_text else "cast(null as varchar)"
        present = "true" if shape == "long" else (f"{value} is not null" if shape == "time_columns" else f"{number(value)} is not null")
        parts.append(f"""select {ident} as observation_id, department_id, document_id, table_id,
  {own_metric or metric} as metric_id, {row_time or time_key(label)} as time_id,
  {entity('geo', q(code)) if code else geo} as geography_id,
  {entity('scenario', q(scenario)) if scenario else 'cast(null as varchar)'} as scenario_id,
  {number(value)} as value_numeric, {text} as value_text, r as source_row_number,
  {f'cast({position} as bigint)' if by_cell else 'cast(null as bigint)'} as source_column_number
  from {joined} where {keep} and {present}""")
    return " union all ".join(parts)


NO_GEO = "cast(null as varchar)"
METRIC_ROW = "cls <> 'junk' and metric_id is not null"


def _read(grid, label: str) -> str:
    """Source rows with their label classified."""
    return f"""with w as ({grid.wide_sql()}), l as (select *, {label} as label_ from w),
d as (select distinct label_ as raw from l where label_ is not null), {classify_ctes('d', 'raw', 'c')},
j as (select * from l join c on label_ = raw)"""


def _geo(text: str) -> str:
    return entity("geo", f"coalesce(code, {norm(text)})")


EMPTY = "''"
ORACLES = {
    "time_columns": _read(i.TIME_GRID, "c0") + " " + emit(
        i.TIME_GRID, "j", "metric_id", None, NO_GEO, METRIC_ROW,
        [(1, "2021-22", None, None, None), (2, "2022-23", None, None, None), (3, "2023-24", "projection", None, None),
         (4, "Year 2", None, None, None)], "time_columns"),
    "geo_columns": _read(i.GEO_GRID, "c0") + " " + emit(
        i.GEO_GRID, "j", EMPTY, "time_id", NO_GEO, "time_id is not null",
        [(1, None, None, "ON", None), (2, None, None, "QC", None), (3, None, None, "CA", None)], "geo_columns"),
    "dimensional": _read(i.DIMENSIONAL_GRID, "coalesce(nullif(concat_ws(' | ', c1, c2), ''), c0)") + " " + emit(
        i.DIMENSIONAL_GRID, "j", "metric_id", None, NO_GEO, METRIC_ROW,
        [(3, "2019-20", None, None, None), (4, "2019-20", None, None, None), (5, "2020-21", "projection", None, None)], "dimensional"),
    "long": f"""with w as ({i.LONG_GRID.wide_sql()}), d as (select distinct c0 as raw from w where c0 is not null), {period_ctes('d', 'raw', 'p')},
j as (select w.*, p.p_label, g.code from w join p on c0 = raw left join {GEO_TERMS} g on g.term = {norm('c2')}) """ + emit(
        i.LONG_GRID, "j", EMPTY, f"coalesce({entity('time', 'p_label')}, '')", f"case when c2 is not null then {_geo('c2')} end", "true",
        [(1, None, None, None, None)], "long"),
    "census": f"""with j as (select w.*, g.code from ({i.CENSUS_GRID.wide_sql()}) w left join {GEO_TERMS} g on g.term = {norm('c0')}) """ + emit(
        i.CENSUS_GRID, "j", EMPTY, None, f"case when c0 is not null then {_geo('c0')} end", "true",
        [(1, "2016", None, None, entity("metric", "'population'")), (2, "2011", None, None, entity("metric", "'average income'")),
         (4, "2006", None, None, entity("metric", "'census_population'"))], "census"),
    "financial": f"with j as ({i.FINANCIAL_GRID.wide_sql()}) " + emit(
        i.FINANCIAL_GRID, "j", EMPTY, None, NO_GEO, "true", [(2, None, None, None, None)], "financial"),
    "survey": f"with j as ({i.SURVEY_GRID.wide_sql()}) " + emit(
        i.SURVEY_GRID, "j", EMPTY, None, NO_GEO, "true", [(2, None, None, None, None)], "survey"),
}
FACTS_SQL = " union all ".join(f"select * from ({sql})" for sql in ORACLES.values())


def facts(spark, sf, names=None):
    return observations(i.all_cells(spark, sf, names), Dictionaries.default(spark))


def _shape_check(name: str, shape: str) -> None:
    @check(name, ORACLES[shape])
    def _(spark, sf):
        return facts(spark, sf, [shape]).select(*OUT)


for _name, _shape in [
    ("wide_time_unpivot", "time_columns"), ("wide_geo_unpivot", "geo_columns"), ("dimensional_long", "dimensional"),
    ("sdmx_long", "long"), ("census_unpivot", "census"), ("financial_rows", "financial"), ("survey_rows", "survey"),
]:
    _shape_check(_name, _shape)


@check("fact_observation", FACTS_SQL)
def _(spark, sf):
    return facts(spark, sf).select(*OUT)


_named = lambda names: f"max({in_list('name', names)})"
_bare = lambda names: f"max({in_list('ltrim(name, chr(64))', names)})"


@check("route_shapes", f"""
with h as (select distinct department_id, table_id, source_column_number, header_raw from ({i.all_cells_sql()})),
{classify_ctes('h', 'header_raw', 'c')},
t as (select *, {strip('lower(header_raw)')} as name from c),
f as (select table_id, min(department_id) as d, count(*) filter (cls in ('time', 'time_range')) as nt, count(*) filter (cls = 'geography') as ng,
  {_named(['value', 'amount', 'montant'])} as fv, {_bare(['obs_value', 'value'])} as lv, {_bare(['time_period', 'ref_date'])} as lt,
  {_named(['amount', 'expenditure'])} as fs, {_named(['score100', 'score5'])} as sv,
  max(regexp_matches(header_raw, '(19|20)\\d{{2}}') and not regexp_matches(lower(header_raw), '^({"|".join(GEO_ID_NAMES)})')
    and regexp_matches(lower(header_raw), '{"|".join(MEASURE_WORDS)}')) as yr from t group by table_id)
select table_id, nt as time_columns, ng as geo_columns, case when d = 'statcan' then case when lv and lt then 'long' when yr then 'census' else 'none' end
  when d = 'tbs-sct' then case when fs then 'financial' when sv then 'survey' else 'none' end
  when fv then 'dimensional' when ng > nt and ng >= 2 then 'geo_columns' else 'time_columns' end as shape from f""")
def _(spark, sf):
    specs = table_specs(headers_of(i.all_cells(spark, sf)), Dictionaries.default(spark))
    return specs.select("table_id", "time_columns", "geo_columns", "shape")


CAP = 700


@check("observation_cap", f"""
select observation_id, table_id, source_row_number, source_column_number from ({FACTS_SQL})
qualify row_number() over (partition by table_id order by source_row_number, coalesce(source_column_number, 0), observation_id) <= {CAP}""")
def _(spark, sf):
    columns = ["observation_id", "table_id", "source_row_number", "source_column_number"]
    return capped(written(facts(spark, sf).select(*columns), "facts"), CAP)


@check("pivot_grid", f"select table_id, r as source_row_number, c0, c1, c2, c3 from ({i.GEO_GRID.wide_sql()})")
def _(spark, sf):
    from factloom.functions.text import blank_to_null

    cells = i.GEO_GRID.cells(spark, sf).withColumn("value_raw", blank_to_null(F.col("value_raw")))
    return pivot_grid(cells, [0, 1, 2, 3])


@check("table_dimensions", f"""
select table_id, max(source_row_number) + 1 as n_rows, max(source_column_number) + 1 as n_columns from ({i.all_cells_sql()}) group by table_id""")
def _(spark, sf):
    return table_dimensions(i.all_cells(spark, sf))


TABLES_SQL = f"select distinct table_id, document_id, department_id from ({i.all_cells_sql()})"


def tables(spark, sf):
    return i.all_cells(spark, sf).select("table_id", "document_id", "department_id").distinct()


@check("pending_tables", f"""
select t.table_id, t.document_id, t.department_id from ({TABLES_SQL}) t
where t.table_id not in (select table_id from ({ORACLES['dimensional']}) union all select table_id from ({ORACLES['survey']}))""")
def _(spark, sf):
    found = tables(spark, sf)
    documents = found.select("document_id", "department_id").distinct()
    return pending_tables(found, documents, facts(spark, sf, ["dimensional", "survey"]))


@check("table_yield", f"""
select department_id, count(*) as tables, count(n) as tables_with_observations, cast(coalesce(sum(n), 0) as bigint) as observations,
  round(count(n) / count(*), 6) as share from ({TABLES_SQL}) t
left join (select table_id, count(*) as n from ({FACTS_SQL}) group by table_id) f using (table_id) group by department_id""")
def _(spark, sf):
    return table_yield(tables(spark, sf), facts(spark, sf))


@check("normalize_stats", f"""
select department_id, count(*) as observations, count(distinct table_id) as tables, count(value_numeric) as numeric_values,
  count(value_text) as text_values, count(geography_id) as with_geography, count(nullif(time_id, '')) as with_time,
  count(nullif(metric_id, '')) as with_metric from ({FACTS_SQL}) group by department_id""")
def _(spark, sf):
    per_table = facts(spark, sf).groupBy("department_id", "table_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("value_numeric").alias("num"), F.count("value_text").alias("txt"),
        F.count("geography_id").alias("geo"), F.count(F.nullif("time_id", F.lit(""))).alias("tim"),
        F.count(F.nullif("metric_id", F.lit(""))).alias("met"),
    )
    return per_table.groupBy("department_id").agg(
        F.sum("n").alias("observations"), F.count(F.lit(1)).alias("tables"), F.sum("num").alias("numeric_values"),
        F.sum("txt").alias("text_values"), F.sum("geo").alias("with_geography"), F.sum("tim").alias("with_time"),
        F.sum("met").alias("with_metric"),
    )


@check("quality_score", f"""
with f as ({i.FACT_SQL}), r as (select *, metric_id = '' as a, time_id = '' as b, coalesce(confidence < 0.8, false) as c,
  value_numeric is null and value_text is null as d, coalesce(abs(value_numeric) > 1e15, false) as e,
  value_numeric is not null and unit_raw is null as g from f)
select observation_id, greatest(0.0::double, least(1.0::double, (((((1.0::double - case when a then 0.3::double else 0 end) - case when b then 0.2::double else 0 end)
    - case when c then 0.2::double else 0 end) - case when d then 0.3::double else 0 end) - case when e then 0.2::double else 0 end) - case when g then 0.05::double else 0 end)) as quality_confidence,
  concat_ws(',', case when a then 'MISSING_METRIC' end, case when b then 'MISSING_TIME' end, case when c then 'LOW_METRIC_CONFIDENCE' end,
    case when d then 'MISSING_VALUE' end, case when e then 'IMPLAUSIBLE_VALUE' end, case when g then 'MISSING_UNIT' end) as issue_codes,
  concat_ws('; ', case when a then 'No metric ID assigned' end, case when b then 'No time dimension assigned' end,
    case when c then printf('Mapping confidence %.2f below threshold', confidence) end, case when d then 'Neither numeric nor text value present' end,
    case when e then concat('Value ', cast(value_numeric as varchar), ' exceeds plausibility threshold') end) as issue_notes,
  'unreviewed' as review_status from r""")
def _(spark, sf):
    return score_observations(i.star_facts(spark, sf), F.col("confidence")).drop("reviewed_by", "reviewed_at")


@check("null_rates", f"""
with f as ({i.FACT_SQL}) select department_id, count(*) as observations,
  count(*) filter (coalesce(metric_id, '') = '') / count(*) as metric_id_missing, count(*) filter (coalesce(time_id, '') = '') / count(*) as time_id_missing,
  count(*) filter (coalesce(geography_id, '') = '') / count(*) as geography_id_missing, count(*) filter (value_numeric is null) / count(*) as value_numeric_missing
from f group by department_id""")
def _(spark, sf):
    return null_rates(i.star_facts(spark, sf), ["metric_id", "time_id", "geography_id", "value_numeric"])


@check("constraint_report", f"""
with f as ({i.FACT_SQL}), k as (select concat(document_id, '|', table_id, '|', metric_id) as k, geography_id, value_numeric from f)
select count(*) as rows, count(*) - count(geography_id) as null_geography_id, count(*) - count(value_numeric) as null_value_numeric,
  count(*) - count(distinct k) as duplicate_keys from k""")
def _(spark, sf):
    return constraint_report(
        i.star_facts(spark, sf), ["geography_id", "value_numeric"], ["document_id", "table_id", "metric_id"]
    )


@check("conflicting_units", f"""
with f as ({i.FACT_SQL}) select metric_id, count(distinct unit_raw) as units, count(*) as observations
from f where unit_raw is not null group by metric_id having count(distinct unit_raw) > 1""")
def _(spark, sf):
    return conflicting_units(i.star_facts(spark, sf))
