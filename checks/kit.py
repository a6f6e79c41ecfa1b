"""Registry of checked queries, and the pieces their reference SQL is built from.

Each check pairs a Spark query of the library with SQL for DuckDB that computes
the same result by its own route.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom import dictionaries as dic
from factloom.functions.text import (
    BLANKS, DASHES_QUOTES_MARK, ENGLISH_WORDS, FRENCH_LETTERS, FRENCH_WORDS, WS,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def register(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows get much work in the first stage; the driver's tables are single files, so they are always dealt out."""
    return table(spark, sf_dir, name).repartition(spark.sparkContext.defaultParallelism)


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


# --- expressions -------------------------------------------------------------

def strip(x: str) -> str:
    return f"trim({x}, {q(BLANKS)})"


def blank_null(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def norm(x: str) -> str:
    folded = f"translate(lower(coalesce({x}, '')), {q(DASHES_QUOTES_MARK)}, {q('----' + chr(39) * 2 + chr(34) * 2)})"
    spaced = strip(f"regexp_replace({folded}, {q(WS + '+')}, ' ', 'g')")
    percent = rf"regexp_replace({spaced}, '\( ?% ?\)', '(%)', 'g')"
    dollars = f"replace(replace({percent}, 'm$', 'millions $'), '$us', '$ us')"
    return f"regexp_replace({strip(f'rtrim({dollars}, {q(chr(58))})')}, ' +', ' ', 'g')"


def language(x: str) -> str:
    words = f"list_distinct(regexp_extract_all(lower({x}), '[a-z{FRENCH_LETTERS}]+'))"
    hits = lambda vocabulary: f"len(list_intersect({words}, [{', '.join(q(w) for w in vocabulary)}]))"
    return (
        f"case when coalesce({x}, '') = '' then 'unknown' "
        f"when not (regexp_matches(lower({x}), '[{FRENCH_LETTERS}]') or {hits(FRENCH_WORDS)} >= 2) then 'en' "
        f"when {hits(ENGLISH_WORDS)} >= 2 then 'bilingual' else 'fr' end"
    )


def number(x: str) -> str:
    bare = strip(f"translate({x}, ', $%', '')")
    return (
        rf"case when regexp_matches({bare}, '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$') "
        f"then try_cast({bare} as double) end"
    )


def key(*parts: str) -> str:
    """Row key over SQL expressions."""
    return "substr(sha256(" + " || '|' || ".join(f"cast({p} as varchar)" for p in parts) + "), 1, 32)"


def entity(kind: str, x: str) -> str:
    return f"substr(sha256({q(kind + '|')} || {strip(f'lower({x})')}), 1, 24)"


def values(rows: list[tuple], names: str) -> str:
    cell = lambda v: "null" if v is None else (str(v).lower() if isinstance(v, bool) else q(v))
    return f"(select * from (values {', '.join('(' + ', '.join(cell(v) for v in r) + ')' for r in rows)}) as v({names}))"


# --- dictionaries ------------------------------------------------------------

def _first_claims(pairs: list[tuple[str, str]]) -> list[tuple[str, str]]:
    claimed: dict[str, str] = {}
    for text, entity_name in pairs:
        claimed.setdefault(text.lower(), entity_name)
    return list(claimed.items())


GEO_TERMS = values(_first_claims([(t, c) for c, _, en, fr, syn in dic.GEOGRAPHIES for t in [c, en, fr, *syn]]), "term, code")
SCENARIO_TERMS = values(_first_claims([(t, k) for k, syn in dic.SCENARIOS for t in syn]), "term, entity")
METRIC_TERMS = values(_first_claims([(t, m[0]) for m in dic.METRICS for t in m[-1]]), "term, entity")
METRIC_ROWS = values([m[:6] for m in dic.METRICS], "entity, name_en, name_fr, family, unit, is_additive")
GEO_ROWS = values([g[:4] for g in dic.GEOGRAPHIES], "code, geo_type, name_en, name_fr")


def in_list(x: str, items: list[str]) -> str:
    return f"{x} in ({', '.join(q(i) for i in items)})"


def month_no(x: str) -> str:
    return f"""case when {x} in ('january', 'jan', 'janvier') then 1 when {x} in ('february', 'feb', 'février') then 2
  when {x} in ('march', 'mar', 'mars') then 3 when {x} in ('april', 'apr', 'avril') then 4 when {x} in ('may', 'mai') then 5
  when {x} in ('june', 'jun', 'juin') then 6 when {x} in ('july', 'jul', 'juillet') then 7 when {x} in ('august', 'aug', 'août') then 8
  when {x} in ('september', 'sep', 'septembre') then 9 when {x} in ('october', 'oct', 'octobre') then 10
  when {x} in ('november', 'nov', 'novembre') then 11 when {x} in ('december', 'dec', 'décembre') then 12 end"""


def period_ctes(source: str, text: str, out: str) -> str:
    """CTEs that add p_type, p_label, p_start, p_end, p_projection, p_hint to ``source``."""
    fiscal = q(r"^(\d{4})[-–—](\d{4}|\d{2})$")
    months = q(rf"^([a-zéûî]+)\.?{WS}+(\d{{4}})$")
    span = q(rf"^([a-zéûî]+){WS}+to{WS}+([a-zéûî]+){WS}+((\d{{4}})[-–](\d{{4}}|\d{{2}}))$")
    relative = q(rf"^year{WS}+0*(\d+)$")
    n = out
    follow = lambda a, b: (
        f"try_cast({a} as int) + 1 = try_cast(case when length({b}) = 2 then substr({a}, 1, 2) || {b} else {b} end as int)"
    )
    two = lambda x: f"lpad(cast(({x}) % 100 as varchar), 2, '0')"
    return f"""
{n}_a as (select *, {strip(f'lower({text})')} as t_ from {source}),
{n}_b as (select *, nullif(regexp_extract(t_, '^(projection|forecast|actual|historical|baseline|prévision)', 1), '') as w_ from {n}_a),
{n}_c as (select *, case when w_ is null then t_ else {strip('substr(t_, length(w_) + 1)')} end as b_ from {n}_b),
{n}_d as (select *, regexp_extract(b_, {fiscal}, 1) as fa_, regexp_extract(b_, {fiscal}, 2) as fb_,
    {month_no(f'regexp_extract(t_, {months}, 1)')} as m_, try_cast(regexp_extract(t_, {months}, 2) as int) as my_,
    regexp_extract(t_, {span}, 1) as r1_, regexp_extract(t_, {span}, 2) as r2_, regexp_extract(t_, {span}, 3) as ry_,
    regexp_extract(t_, {span}, 4) as ra_, regexp_extract(t_, {span}, 5) as rb_,
    regexp_extract(t_, {relative}, 1) as rel_ from {n}_c),
{n}_e as (select *, {month_no('r1_')} as rm1_, {month_no('r2_')} as rm2_,
    case when {follow('fa_', 'fb_')} then cast(fa_ as int) end as fy_,
    case when {follow('ra_', 'rb_')} then cast(ra_ as int) end as rfy_,
    case when regexp_matches(b_, '^\\d{{4}}$') and cast(b_ as int) between 1900 and 2100 then cast(b_ as int) end as cy_
    from {n}_d),
{n}_f as (select *, case when fy_ is not null then 'fiscal_year' when cy_ is not null then 'year'
      when m_ is not null and my_ between 1900 and 2100 then 'month'
      when rm1_ is not null and rm2_ is not null and rfy_ is not null then 'range'
      when rel_ <> '' then 'relative' end as kind_ from {n}_e),
{out} as (select * exclude (t_, b_, fa_, fb_, m_, my_, r1_, r2_, ry_, ra_, rb_, rel_, rm1_, rm2_, fy_, rfy_, cy_, kind_, w_),
    case when kind_ = 'relative' then 'range' else kind_ end as p_type,
    case kind_ when 'fiscal_year' then cast(fy_ as varchar) || '-' || {two('fy_ + 1')}
      when 'year' then cast(cy_ as varchar) when 'month' then cast(my_ as varchar) || '-' || {two('m_')}
      when 'range' then r1_ || ' to ' || r2_ || ' ' || ry_ when 'relative' then 'Year ' || rel_ end as p_label,
    case kind_ when 'fiscal_year' then make_date(fy_, 4, 1) when 'year' then make_date(cy_, 1, 1)
      when 'month' then make_date(my_, m_, 1) when 'range' then make_date(rfy_, rm1_, 1) end as p_start,
    case kind_ when 'fiscal_year' then make_date(fy_ + 1, 3, 31) when 'year' then make_date(cy_, 12, 31)
      when 'month' then last_day(make_date(my_, m_, 1))
      when 'range' then last_day(make_date(case when rm2_ >= rm1_ then rfy_ else rfy_ + 1 end, rm2_, 1)) end as p_end,
    case when kind_ is not null then coalesce(kind_ in ('fiscal_year', 'year')
      and w_ in ('projection', 'forecast', 'prévision'), false) end as p_projection,
    case when kind_ in ('fiscal_year', 'year') then w_ end as p_hint
    from {n}_f)"""


def classify_ctes(source: str, text: str, out: str) -> str:
    """CTEs that add normalized, cls, conf, method, hint and the five keys to ``source``."""
    n = out
    junk = in_list("normalized", dic.JUNK_HEADERS)
    rules = [
        ("normalized = ''", "junk", 1.0, "empty", "null"),
        (junk, "junk", 1.0, "junk_pattern", "null"),
        ("normalized in ('@obs_value', 'obs', 'value')", "metric", 0.9, "statcan_value_column", "'observation_value'"),
        ("normalized in ('@uom', 'uom', 'uom_id', '@scalar_factor', 'scalar_factor', 'scalar_id')", "unit", 0.95, "statcan_unit_column", "null"),
        ("p_type = 'range'", "time_range", 0.95, "time_parser", "p_hint"),
        ("p_type is not null", "time", 0.95, "time_parser", "p_hint"),
        ("g.code is not null", "geography", 0.95, "geo_dictionary", "null"),
        ("normalized = '@geography'", "geography", 0.95, "statcan_geo_attribute", "null"),
        ("s.entity is not null", "scenario", 0.95, "scenario_dictionary", "s.entity"),
        ("normalized like '@_%'", "attribute", 0.8, "statcan_dimension_attribute", "null"),
        ("m.entity is not null", "metric", 0.9, "metric_dictionary", "m.entity"),
        (f"regexp_matches(normalized, {q(dic.UNIT_PATTERN)})", "unit", 0.9, "unit_pattern", "null"),
    ]
    pick = lambda i, last: "case " + " ".join(
        f"when {r[0]} then {q(r[i]) if i in (1, 3) else r[i]}" for r in rules
    ) + f" else {last} end"
    return f"""{period_ctes(source, text, n + '_p')},
{n}_n as (select *, {norm(text)} as normalized from {n}_p),
{n}_j as (select x.*, g.code as geo_code, s.entity as scenario_key, m.entity as metric_key, h.entity as hint_key,
    {pick(1, "'metric'")} as cls, cast({pick(2, '0.3')} as double) as conf, {pick(3, "'fallback'")} as method, {pick(4, 'null')} as hint
    from {n}_n x left join {GEO_TERMS} g on g.term = normalized left join {SCENARIO_TERMS} s on s.term = normalized
    left join {METRIC_TERMS} m on m.term = normalized left join {SCENARIO_TERMS} h on h.term = p_hint),
{out} as (select *,
    case when cls = 'metric' then {entity('metric', 'coalesce(metric_key, normalized)')} end as metric_id,
    case when cls in ('time', 'time_range') then {entity('time', 'p_label')} end as time_id,
    case when cls = 'geography' then {entity('geo', 'coalesce(geo_code, normalized)')} end as geography_id,
    case when cls in ('time', 'time_range') and p_hint is not null then {entity('scenario', 'coalesce(hint_key, p_hint)')}
      when cls = 'scenario' then {entity('scenario', 'coalesce(scenario_key, normalized)')} end as scenario_id,
    case when cls = 'attribute' then {entity('attr_type', "replace(substr(normalized, 2), '_', ' ')")} end as attribute_type_id
    from {n}_j)"""


# --- grids: the same source table laid out as cells by both engines ----------

class Grid:
    """Rows of a table seen as rows of a published table: one header and one value expression per column.

    The expressions are SQL that both engines read alike.
    """

    def __init__(self, source: str, department: str, document: str, table_id: str, row: str, columns: list[tuple[str, str]]):
        self.source, self.department, self.columns = source, department, columns
        self.document, self.table_id, self.row = document, table_id, row

    def cells(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        wide = spread(spark, sf_dir, self.source).selectExpr(
            f"{q(self.department)} as department_id", f"{self.document} as document_id", f"{self.table_id} as table_id",
            f"cast({self.row} as bigint) as source_row_number",
            *[f"cast({v} as string) as _v{i}" for i, (_, v) in enumerate(self.columns)],
        )
        pairs = F.array(*[
            F.struct(F.lit(h).alias("header_raw"), F.col(f"_v{i}").alias("value_raw"))
            for i, (h, _) in enumerate(self.columns)
        ])
        return wide.select(
            "department_id", "document_id", "table_id", "source_row_number",
            F.col("_v0").alias("row_label_raw"), F.posexplode(pairs).alias("source_column_number", "_p"),
        ).select(
            "department_id", "document_id", "table_id", "source_row_number",
            F.col("source_column_number").cast("long"), "row_label_raw", "_p.*",
        )

    def sql(self) -> str:
        return " union all ".join(
            f"select {q(self.department)} as department_id, {self.document} as document_id, {self.table_id} as table_id, "
            f"cast({self.row} as bigint) as source_row_number, cast({i} as bigint) as source_column_number, "
            f"cast({self.columns[0][1]} as varchar) as row_label_raw, {q(h)} as header_raw, cast({v} as varchar) as value_raw "
            f"from {self.source}"
            for i, (h, v) in enumerate(self.columns)
        )

    def wide_sql(self) -> str:
        """One row per source row with columns c0, c1, …"""
        columns = ", ".join(f"{blank_null(f'cast({v} as varchar)')} as c{i}" for i, (_, v) in enumerate(self.columns))
        return (
            f"select {q(self.department)} as department_id, {self.document} as document_id, {self.table_id} as table_id, "
            f"cast({self.row} as bigint) as r, {columns} from {self.source}"
        )
