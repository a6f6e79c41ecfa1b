"""Catalogue payloads to resources, eligibility verdicts and document records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import checksum, document_id

HOST = "https://open.canada.ca"

# Formats taken in, and address endings that are left out.
SUPPORTED_FORMATS = ["csv", "xls", "xlsx", "xml", "json", "html"]
SKIPPED_ENDINGS = [".zip", ".gz", ".tar", ".rar", ".7z", ".pdf", ".doc", ".docx"]
FRENCH_ENDINGS = ["-fra.csv", "-fra.xml", "-fra.xlsx", "-fra.xls"]

# Title patterns in order, with the type they stand for.
DOCUMENT_TYPES = [
    ("budget", "budget"),
    ("estimate", "estimates"),
    ("fiscal monitor", "fiscal_monitor"),
    ("economic (?:and fiscal )?(?:update|statement)", "economic_update"),
    ("survey.*forecast", "economic_survey"),
    ("transfer", "transfer_tables"),
    ("proactive disclosure", "proactive_disclosure"),
    ("employee survey|pses", "employee_survey"),
    ("infobase|covid", "expenditure_tracking"),
    ("aid|iati", "international_aid"),
]

DATASET_SCHEMA = (
    "id string, title string, title_translated struct<en:string,fr:string>, date_published string, "
    "resources array<struct<id:string,name:string,format:string,url:string,language:string,size:bigint>>"
)


def catalogue_resources(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per resource of each dataset; the English title is preferred."""
    kept = [c for c in payloads.columns if c != payload]
    datasets = payloads.select(*kept, F.from_json(payload, DATASET_SCHEMA).alias("d"))
    title = F.coalesce(F.nullif("d.title_translated.en", F.lit("")), "d.title", F.lit(""))
    return datasets.select(
        *kept, F.col("d.id").alias("dataset_id"), title.alias("title"), F.col("d.date_published").alias("date_published"),
        F.explode("d.resources").alias("r"),
    ).select(*kept, "dataset_id", "title", "date_published", "r.*").withColumnRenamed("id", "resource_id")


def resource_format(declared: Column) -> Column:
    return F.lower(F.trim(F.coalesce(declared, F.lit(""))))


def resource_language(declared: Column) -> Column:
    """A list with both languages is ``bilingual``, another list gives its first entry, text stays."""
    as_list = F.from_json(declared, "array<string>")
    is_list = F.coalesce(declared.startswith("["), F.lit(False))
    both = F.array_contains(as_list, "en") & F.array_contains(as_list, "fr")
    return (
        F.when(is_list & both, "bilingual")
        .when(is_list, F.coalesce(F.try_element_at(as_list, F.lit(1)), F.lit("unknown")))
        .otherwise(F.coalesce(declared, F.lit("unknown")))
    )


def resource_url(url: Column, host: str = HOST) -> Column:
    return F.when(url.startswith("/"), F.concat(F.lit(host), url)).otherwise(url)


def source_address() -> Column:
    """The full address of a landed resource."""
    return resource_url(F.col("url"))


def document_type(title: Column) -> Column:
    lower = F.lower(F.coalesce(title, F.lit("")))
    chain = F.when(lower.rlike(DOCUMENT_TYPES[0][0]), DOCUMENT_TYPES[0][1])
    for pattern, kind in DOCUMENT_TYPES[1:]:
        chain = chain.when(lower.rlike(pattern), kind)
    return chain.otherwise("other")


def title_year(title: Column) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(title, F.lit("")), r"(20\d{2})", 1), F.lit(""))


def published_date(text: Column) -> Column:
    return F.substring(text, 1, 10).try_cast("date")


def _ends_with_any(text: Column, endings: list[str]) -> Column:
    return text.rlike("(?:" + "|".join(e.replace(".", r"\.") for e in endings) + ")$")


def known_urls(resources: DataFrame, documents: DataFrame) -> DataFrame:
    """Mark resources whose address was taken in before by the same department."""
    seen = documents.select(F.col("department_id").alias("_department"), F.col("source_url").alias("_seen")).distinct()
    same = F.col("department_id").eqNullSafe(F.col("_department")) & (F.col("source_url") == F.col("_seen"))
    return resources.join(seen, same, "left").withColumn("is_known", F.col("_seen").isNotNull()).drop("_department", "_seen")


def with_eligibility(
    resources: DataFrame, documents: DataFrame | None = None, max_bytes: int | None = None,
    formats: list[str] | None = None, host: str = HOST,
) -> DataFrame:
    """Add ``source_url``, ``file_format``, ``language`` and a ``verdict`` with its ``reason``.

    Verdicts: ``duplicate``, ``skipped``, ``failed`` (the download brought no
    content) or ``eligible``. Resources without an address are dropped. ``size``
    and ``content`` are looked at where present; only with ``max_bytes`` are
    large files skipped.
    """
    staged = (
        resources.filter(F.coalesce("url", F.lit("")) != "")
        .withColumn("source_url", resource_url(F.col("url"), host))
        .withColumn("file_format", resource_format(F.col("format")))
        .withColumn("language", resource_language(F.col("language")))
    )
    staged = known_urls(staged, documents) if documents is not None else staged.withColumn("is_known", F.lit(False))
    lower = F.lower("source_url")
    no = F.lit(False)
    size = F.col("size") if "size" in resources.columns else F.lit(None).cast("long")
    packed = missing = no
    if "content" in resources.columns:
        size = F.coalesce(F.length("content"), size)
        missing = F.col("content").isNull()
        packed = F.col("file_format").isin("csv", "xml") & (F.hex(F.substring("content", 1, 2)) == "504B")
    reason = (
        F.when(F.col("is_known"), "known_url")
        .when(~F.col("file_format").isin(formats or SUPPORTED_FORMATS), "format")
        .when(_ends_with_any(lower, SKIPPED_ENDINGS), "ending")
        .when(F.col("language") != "en", "language")
        .when(_ends_with_any(lower, FRENCH_ENDINGS), "french_file")
        .when(no if max_bytes is None else F.coalesce(size > max_bytes, no), "too_large")
        .when(F.coalesce(packed, no), "packed_content")
        .when(missing, "no_content")
    )
    return staged.withColumn("reason", reason).withColumn(
        "verdict",
        F.when(F.col("reason") == "known_url", "duplicate").when(F.col("reason") == "no_content", "failed")
        .when(F.col("reason").isNotNull(), "skipped").otherwise("eligible"),
    ).drop("is_known")


def document_records(landed: DataFrame, base_uri: str = "gs://raw") -> DataFrame:
    """Eligible resources with ``content`` to document records; without content there is no record."""
    digest = checksum(F.col("content"))
    year = F.coalesce(title_year(F.col("title")), F.lit("unknown"))
    name = F.coalesce(F.nullif("name", F.lit("")), "resource_id", F.lit("unknown"))
    filename = F.when(F.col("file_format") != "", F.concat_ws(".", name, F.col("file_format"))).otherwise(name)
    keyed = landed.filter("verdict = 'eligible' and content is not null").withColumn("checksum", digest).withColumn(
        "document_id", document_id(F.col("source_url"), F.col("checksum"))
    )
    return keyed.select(
        "document_id", "department_id", F.col("department_id").alias("department_code"),
        F.format_string(
            base_uri.replace("%", "%%") + "/department=%s/year=%s/document_id=%s/%s",
            F.col("department_id"), year, F.col("document_id"), filename,
        ).alias("gcs_uri"),
        "source_url", "title", document_type(F.col("title")).alias("document_type"), "file_format", "language",
        published_date(F.col("date_published")).alias("published_date"), "checksum",
        year.alias("year"), F.lit("open.canada.ca").alias("source_system"), F.lit("success").alias("ingestion_status"),
    )


def ingest_counts(judged: DataFrame, by: str = "department_id") -> DataFrame:
    verdict = F.col("verdict")
    return judged.groupBy(by).agg(
        F.count_if(verdict == "eligible").alias("success"), F.count_if(verdict == "skipped").alias("skipped"),
        F.count_if(verdict == "duplicate").alias("duplicate"), F.count_if(verdict == "failed").alias("failed"),
    )


def status_counts(documents: DataFrame) -> DataFrame:
    return documents.groupBy("ingestion_status", "file_format").agg(F.count(F.lit(1)).alias("documents"))
