"""Look-ups over the star schema: coverage, lists, values, history, citations, query audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

MAX_ROWS = 1000
PREVIEW_ROWS = 30
MAX_LIST = 100


def capped_limit(requested: int | None, default: int, most: int = MAX_LIST) -> int:
    """A requested list length, brought into 1..most, as the tools of the interface ask for it."""
    return max(1, min(int(requested or default), most))


def for_department(df: DataFrame, department: str | None) -> DataFrame:
    """Restrict to a department; ``None`` and ``all`` mean no restriction."""
    if department is None or department == "all":
        return df
    return df.filter(F.col("department_id") == department)


def coverage_by_department(facts: DataFrame) -> DataFrame:
    """Observations, distinct metrics and distinct documents per department."""
    return _departments(folded_counts(facts))


def folded_counts(facts: DataFrame) -> DataFrame:
    """Observations per (department, metric), (department, document), period and area, in one pass.

    ``set`` tells which: 0 to 3. Each task folds its facts before the shuffle,
    and a department that holds a third of all rows is spread over its keys.
    """
    keys = ["department_id", "metric_id", "document_id", "time_id", "geography_id"]
    sets = [["department_id", "metric_id"], ["department_id", "document_id"], ["time_id"], ["geography_id"]]
    folded = facts.select(*keys, "observation_id").groupingSets([[F.col(c) for c in s] for s in sets], *keys).agg(
        F.grouping_id().alias("_id"), F.count(F.lit(1)).alias("_rows"), F.count("observation_id").alias("_n")
    )
    bit = {c: 1 << (len(keys) - 1 - n) for n, c in enumerate(keys)}
    which = F.create_map(*[F.lit(x) for n, s in enumerate(sets) for x in (sum(bit[c] for c in keys if c not in s), n)])
    return folded.withColumn("set", F.element_at(which, F.col("_id").cast("int"))).drop("_id")


def _departments(folded: DataFrame) -> DataFrame:
    of = lambda n, what: F.when(F.col("set") == n, what)
    return folded.filter("set in (0, 1)").groupBy("department_id").agg(
        F.sum(of(0, F.col("_rows"))).alias("observations"), F.count(of(0, F.col("metric_id"))).alias("distinct_metrics"),
        F.count(of(1, F.col("document_id"))).alias("documents"),
    )


def _counted(facts: DataFrame, key: str) -> DataFrame:
    """Observations per key; counts of ``folded_counts`` are taken as they are."""
    if "set" in facts.columns:
        own = {"metric_id": 0, "time_id": 2, "geography_id": 3}[key]
        return facts.filter((F.col("set") == own) & F.col(key).isNotNull()).groupBy(key).agg(F.sum("_n").alias("_n"))
    return facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("observation_id").alias("_n"))


def metric_counts(facts: DataFrame, dim_metric: DataFrame, search: str | None = None) -> DataFrame:
    """Observations per metric name, metrics with data only. Facts are counted per key before the join."""
    named = dim_metric.filter("canonical_name is not null and canonical_name != ''")
    if search:
        named = named.filter(F.lower("canonical_name").contains(search.lower()))
    return (
        _counted(facts, "metric_id").join(named.select("metric_id", "canonical_name"), "metric_id")
        .groupBy("canonical_name").agg(F.sum("_n").alias("obs"))
    )


def list_metrics(facts: DataFrame, dim_metric: DataFrame, search: str | None = None, limit: int | None = None) -> DataFrame:
    return metric_counts(facts, dim_metric, search).orderBy(F.desc("obs"), "canonical_name").limit(capped_limit(limit, 25))


def top_metrics(facts: DataFrame, dim_metric: DataFrame) -> DataFrame:
    return metric_counts(facts, dim_metric).orderBy(F.desc("obs"), "canonical_name").limit(30)


def time_counts(facts: DataFrame, dim_time: DataFrame) -> DataFrame:
    return (
        _counted(facts, "time_id").join(dim_time.select("time_id", "label"), "time_id")
        .groupBy("label").agg(F.sum("_n").alias("obs"))
    )


def list_time_periods(facts: DataFrame, dim_time: DataFrame, limit: int | None = None) -> DataFrame:
    return time_counts(facts, dim_time).orderBy(F.desc("obs"), "label").limit(capped_limit(limit, 40))


def list_geographies(facts: DataFrame, dim_geography: DataFrame, with_data: bool = False) -> DataFrame:
    """Observations per area; areas without data count zero unless ``with_data``."""
    how = "inner" if with_data else "left"
    return (
        dim_geography.select("geography_id", "name_en", "geo_type")
        .join(_counted(facts, "geography_id"), "geography_id", how)
        .groupBy("name_en", "geo_type").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("obs"))
    )


def describe_coverage(
    facts: DataFrame, dim_metric: DataFrame, dim_time: DataFrame, dim_geography: DataFrame
) -> DataFrame:
    """The four coverage summaries as one long result ``(section, name, detail, observations, documents)``, from one pass."""
    facts = folded_counts(facts)
    text = lambda c: (F.lit(None) if c is None else F.col(c)).cast("string")

    def section(name: str, df: DataFrame, label: str, detail: str | None, count: str, documents: str | None = None):
        return df.select(
            F.lit(name).alias("section"), text(label).alias("name"), text(detail).alias("detail"),
            F.col(count).alias("observations"),
            (F.lit(None) if documents is None else F.col(documents)).cast("long").alias("documents"),
        )

    return reduce(DataFrame.unionByName, [
        section("coverage_by_department", _departments(facts), "department_id", None, "observations", "documents"),
        section("top_30_metrics", top_metrics(facts, dim_metric), "canonical_name", None, "obs"),
        section("time_periods", time_counts(facts, dim_time), "label", None, "obs"),
        section("named_geographies_with_data", list_geographies(facts, dim_geography, True), "name_en", "geo_type", "obs"),
    ])


def _largest(
    facts: DataFrame, dim_metric: DataFrame, dim_time: DataFrame, dim_document: DataFrame, order: list[Column], limit: int,
    metric: Column | None = None, period: Column | None = None, areas: DataFrame | None = None,
) -> DataFrame:
    """The first facts that pass all filters, with names and sources.

    Filters come first, as joins with the few dimension rows that pass them;
    titles and addresses are fetched for the rows that are left.
    """
    metrics = dim_metric.select("metric_id", F.col("canonical_name").alias("metric"))
    times = dim_time.select("time_id", F.col("label").alias("year"))
    columns = ["observation_id", "metric_id", "time_id", "geography_id", "document_id", "value_numeric"]
    found = facts.select(*columns)
    if areas is not None:
        found = found.join(areas, "geography_id")
    found = found.join(metrics if metric is None else metrics.filter(metric), "metric_id")
    found = found.join(times, "time_id", "left") if period is None else found.join(times.filter(period), "time_id")
    found = found.join(dim_document.select("document_id"), "document_id", "left_semi")
    first = found.orderBy(*order).limit(limit)
    return first.join(dim_document.select("document_id", "title", "source_url"), "document_id").orderBy(*order)


VALUE_COLUMNS = ["metric", "year", "value_numeric", "title", "source_url"]


def metric_lookup(facts, dim_metric, dim_time, dim_document, name: str, period: str, limit: int = 20) -> DataFrame:
    """Largest values of a metric in a period, with their sources."""
    order = [F.desc_nulls_last("value_numeric"), F.col("observation_id")]
    return _largest(
        facts, dim_metric, dim_time, dim_document, order, limit, metric=F.col("metric") == name, period=F.col("year") == period
    ).select(*VALUE_COLUMNS)


def metric_history(facts, dim_metric, dim_time, dim_document, contains: str, limit: int = 50) -> DataFrame:
    """Values of metrics whose name contains a text, latest period first."""
    order = [F.desc_nulls_last("year"), F.desc("value_numeric"), F.col("observation_id")]
    valued = facts.filter("value_numeric is not null")
    return _largest(valued, dim_metric, dim_time, dim_document, order, limit, metric=F.col("metric").contains(contains)).select(*VALUE_COLUMNS)


def geo_lookup(facts, dim_metric, dim_time, dim_geography, dim_document, name: str, limit: int = 50) -> DataFrame:
    """Observations of an area, largest first."""
    areas = dim_geography.filter(F.col("name_en") == name).select("geography_id", F.col("name_en").alias("geography"))
    order = [F.desc_nulls_last("value_numeric"), F.col("observation_id")]
    return _largest(facts, dim_metric, dim_time, dim_document, order, limit, areas=areas).select(
        "metric", "year", "geography", "value_numeric", "title", "source_url"
    )


def preview(result: DataFrame, order: list[Column | str], rows: int = PREVIEW_ROWS) -> DataFrame:
    """First rows of a result, each with the size of the whole result."""
    total = result.agg(F.count(F.lit(1))).scalar()
    return result.orderBy(*order).limit(rows).withColumn("rows_returned", total)


def metric_growth(facts: DataFrame, dim_metric: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Total per metric and year and its change on the period before.

    The window runs over one row per metric and period, after aggregation.
    """
    folded = facts.filter("value_numeric is not null").groupBy("metric_id", "time_id").agg(
        F.sum(F.col("value_numeric").cast("decimal(28,4)")).alias("_sum")
    )
    yearly = (
        folded.join(dim_metric.select("metric_id", "canonical_name"), "metric_id")
        .join(dim_time.select("time_id", "label", "start_date"), "time_id")
        .groupBy("canonical_name", "label", "start_date").agg(F.sum("_sum").alias("total"))
    )
    before = F.lag("total").over(Window.partitionBy("canonical_name").orderBy("start_date", "label"))
    return yearly.select(
        "canonical_name", "label", F.col("total").cast("double").alias("total"),
        before.cast("double").alias("previous"), (F.col("total") - before).cast("double").alias("change"),
    )


def citations(document_ids: DataFrame, dim_document: DataFrame, extracted_tables: DataFrame) -> DataFrame:
    """Source of each document, with its first table.

    The first table is an aggregate minimum, combined before the shuffle, so a
    document with very many tables is no hot spot.
    """
    wanted = document_ids.select("document_id").distinct()
    fields = ["table_title_raw", "sheet_name", "page_number"]
    first = extracted_tables.join(wanted, "document_id", "left_semi").groupBy("document_id").agg(
        F.min_by(F.struct(*fields), F.struct("table_index", "table_id")).alias("t")
    )
    return (
        dim_document.join(wanted, "document_id", "left_semi").join(first, "document_id", "left")
        .select(
            "document_id", "title", "source_url", F.col("department_id").alias("department"),
            F.col("t.table_title_raw").alias("table_title"), "t.sheet_name", "t.page_number",
        )
    )


def citation_text(cited: DataFrame) -> DataFrame:
    """One readable block per citation."""
    line = lambda label, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(label), F.col(c)))
    return cited.select(
        "document_id",
        F.concat_ws(
            "\n", F.concat(F.lit("- "), F.coalesce("title", F.lit(""))), line("  URL: ", "source_url"),
            line("  Department: ", "department"), line("  Table: ", "table_title"),
        ).alias("citation"),
    )


# Words a read-only query must not contain, and schemas it may read.
FORBIDDEN_WORDS = ["INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "ALTER", "TRUNCATE", "MERGE", "GRANT", "REVOKE"]
OPEN_SCHEMAS = ["cur", "quality"]


def query_audit(queries: DataFrame, project: str, sql: str = "sql") -> DataFrame:
    """Verdict on each query text, and the text to run: row cap set, tables qualified.

    A text is refused unless it starts with SELECT; when it contains a
    forbidden word anywhere; or when a back-ticked name lies outside the open
    schemas. ``LIMIT`` counts as present wherever the word occurs.
    """
    text = F.col(sql)
    upper = F.upper(text)
    names = F.regexp_extract_all(text, F.lit("`([^`]+)`"), F.lit(1))
    schema = lambda parts: F.when(F.size(parts) == 3, parts[1]).otherwise(parts[0])
    closed = F.exists(
        names,
        lambda n: (F.size(F.split(n, r"\.")) >= 2) & ~schema(F.split(n, r"\.")).isin(OPEN_SCHEMAS),
    )
    reason = (
        F.when(~F.btrim(upper, F.lit(" \t\r\n")).startswith("SELECT"), "not_select")
        .when(upper.rlike(r"\b(?:" + "|".join(FORBIDDEN_WORDS) + r")\b"), "forbidden_keyword")
        .when(closed, "closed_schema")
    )
    limit = F.regexp_extract(upper, r"LIMIT\s+(\d+)", 1)
    too_many = (F.length(limit) > 9) | (limit.try_cast("long") > MAX_ROWS)
    with_limit = (
        F.when(
            ~upper.contains("LIMIT"),
            F.concat(F.regexp_replace(F.regexp_replace(text, r"\s+$", ""), ";+$", ""), F.lit(f"\nLIMIT {MAX_ROWS}")),
        )
        .when((limit != "") & too_many, F.regexp_replace(text, r"(?i)LIMIT\s+\d+", f"LIMIT {MAX_ROWS}"))
        .otherwise(text)
    )
    qualified = reduce(
        lambda t, s: F.replace(t, F.lit(f"`{s}."), F.lit(f"`{project}.{s}.")), OPEN_SCHEMAS, with_limit
    )
    audited = queries.withColumn("reason", reason)
    return audited.select(
        *queries.columns, F.col("reason").isNull().alias("allowed"), "reason",
        F.when(F.col("reason").isNull(), qualified).alias("runnable"),
    )
