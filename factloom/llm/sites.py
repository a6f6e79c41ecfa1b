"""Line dedup by site-relative frequency, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import stored

#: A line goes when more than this share of its host's pages hold it; a line of one page alone repeats nothing.
RATIO, MIN_PAGES = 0.1, 2
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
HIDDEN = r"(?is)<(?:script|style)\b[^>]*>.*?</(?:script|style)\s*>|<!--.*?-->"
BLOCK = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p"
    r"|pre|section|select|table|tbody|td|tfoot|th|thead|title|tr|ul)(?:[\s/][^>]*)?>"
)
TAG = r"<[^>]*>"
EDGES = " \t\r\f"


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute address; empty where there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), HOST, 1), F.lit(""))


def html_lines(html: Column) -> Column:
    """Visible text as lines: one for each block element or line feed, trimmed, none empty."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " ")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), TAG, "")
    return text_lines(text)


def text_lines(text: Column) -> Column:
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(F.transform(lines, lambda x: F.btrim(x, F.lit(EDGES))), lambda x: x != "")


def _digest(line: Column) -> Column:
    """128 bits of a line, so that no two lines of a host are taken for one."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def without_boilerplate(
    pages: DataFrame, id_col: str = "page_id", host: Column | None = None, lines: Column | None = None,
    ratio: float = RATIO, min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``id, host, n_lines, n_dropped, text`` of every page, without the lines that its host repeats.

    A line counts once for a page. It is dropped from all pages of a host when
    ``min_pages`` or more and over ``ratio`` of them hold it; the lines that stay
    are joined by line feeds. Pages without a host (null or relative address)
    keep all lines. Null html has no lines; repeated rows, also with the same or
    a null id, count as pages of their own. Other columns are not read. No rows:
    no rows.

    Only digests are shuffled, folded first, so a host with most pages and a
    line on most of them are many small rows. A host's list of dropped lines is
    bounded by its mean page length over ``ratio``, whatever its size; it is
    joined to the pages by host, broadcast only if Spark finds the table small.
    """
    host = host_of(F.col("url")) if host is None else host
    lines = html_lines(F.col("html")) if lines is None else lines
    split = stored(pages.select(F.col(id_col).alias("id"), host.alias("host"), lines.alias("lines")), "site-lines")
    hosts = stored(split.groupBy("host").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") >= min_pages), "site-hosts")
    held = split.where("host <> ''").select("host", F.explode(F.array_distinct(F.transform("lines", _digest))).alias("line"))
    counted = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") >= min_pages)
    dropped = stored(
        counted.join(hosts, "host").where(F.col("held") > F.lit(ratio) * F.col("total"))
        .groupBy("host").agg(F.collect_list("line").alias("dropped")), "site-boilerplate",
    )
    kept = F.filter("lines", lambda x: ~F.coalesce(F.array_contains(F.col("dropped"), _digest(x)), F.lit(False)))
    return split.join(dropped, "host", "left").select("id", "host", "lines", kept.alias("kept")).select(
        "id", "host", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` without the lines that their hosts repeat."""
    done = without_boilerplate(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return done.select(F.col("id").alias("page_id"), "host", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


OP3_SQL = f"""
with cut as (
  select page_id, coalesce(regexp_extract(lower(url), {_q(HOST)}, 1), '') as host,
    regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), {_q(HIDDEN)}, ' ', 'g'), {_q(BLOCK)}, chr(10), 'g'), {_q(TAG)}, '', 'g') as t,
    row_number() over () as r
  from pages),
split as (select page_id, r, host,
  list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(12))), lambda x: x <> '') as lines from cut),
held as (select distinct r, host, unnest(lines) as line from split where host <> ''),
hosts as (select host, count(*) as total from split group by host),
dropped as (select held.host, line from held join hosts using (host) group by held.host, line, total
  having count(*) >= {MIN_PAGES} and count(*) > {RATIO} * total),
lists as (select host, list(line) as gone from dropped group by host),
kept as (select page_id, split.host, lines, list_filter(lines, lambda x: not coalesce(list_contains(gone, x), false)) as stay
  from split left join lists on split.host = lists.host)
select page_id, host, len(lines)::bigint as n_lines, (len(lines) - len(stay))::bigint as n_dropped,
  sha256(coalesce(array_to_string(stay, chr(10)), '')) as text_sha256
from kept
"""
