"""Source divergence audit: how the words of each source of a language differ from its other sources and from the whole.

Texts are tokenized by one translate table: ``bytes.translate`` lower-cases the
letters A-Z and blanks whatever separates words in one pass, ``bytes.split`` cuts
the words, and a ``Counter`` for every document gives its frequencies. The counts
are sparse rows that Spark adds up; probabilities are whole numbers in billionths.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import python_batches, stored, texts_of

#: Documents of a language that must hold a kept term; what is added to every count; terms listed of a group.
MIN_DOCS, ADDED, TOP = 30, 5, 50
SCALE = 1_000_000_000
#: Bytes that stay are letters (A-Z as a-z) and everything beyond ASCII; the rest is blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Rows a task holds before it hands them on; sources and terms that meet in one task's group.
HELD_ROWS, SOURCES, TERMS = 200_000, 256, 8_192


def term_counts(docs: DataFrame, text_col: str = "text", group_cols: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """``lang, source, term, docs, count`` of every term of every group: documents that hold it, and occurrences.

    A task adds up what it meets and hands it on when it holds ``HELD_ROWS``
    terms, so frequent words and large groups are folded before the shuffle.
    """
    python_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (docs_of, counts) in groups.items():
                n = len(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.DictionaryArray.from_arrays(pa.array(np.zeros(n, np.int32)), pa.array([x])).dictionary_decode() for x in (lang, source)
                ] + [pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(map(docs_of.__getitem__, counts)), pa.int64()), pa.array(list(counts.values()), pa.int64())],
                    ["lang", "source", "term", "docs", "count"])
            groups.clear()

        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for key, text in zip(keys, texts_of(batch.column(2))):
                found = Counter(text.translate(TABLE).split())
                if key not in groups:
                    groups[key] = Counter(), Counter()
                docs_of, counts = groups[key]
                held -= len(counts)
                counts.update(found)
                docs_of.update(found.keys())
                held += len(counts)
                if held >= HELD_ROWS:
                    yield from rows()
                    held = 0
        yield from rows()

    lang, source = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in group_cols)
    parts = docs.select(lang.alias("lang"), source.alias("source"), F.col(f"`{text_col}`").alias("text")).where("text is not null").mapInArrow(
        run, "lang string, source string, term string, docs long, count long"
    )
    return parts.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"))


def probability(count: Column, total: Column, terms: Column, added: int) -> Column:
    """``1 + floor(SCALE * (count + added) / (total + added * terms))`` in exact decimals."""
    share = (count + added).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", share, (total + added * terms).cast("decimal(19,0)")) + 1


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    min_docs: int = MIN_DOCS, added: int = ADDED, top: int = TOP, sources: int = SOURCES, terms: int = TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far the term probabilities of each source lie from others'.

    A language keeps the terms in at least ``min_docs`` of its documents. ``pair``
    rows give the distance to each other source of the language, summed over all
    kept terms; ``term`` rows the ``top`` terms that a source has more of than the
    language has. Ranks go by value, then by item in byte order. Null text,
    language and source count as empty; a group without terms has pairs. Repeated
    rows are counted each time. Other columns are not read. No rows: no rows.

    Zero counts are never laid out for all terms and pairs of sources: the terms
    of a language are dealt to chunks of about ``terms`` by a hash and its sources
    to blocks of about ``sources``; a chunk and two blocks are one task's group.
    What two sources without a term differ by is the same for all such terms and
    is counted once, by their number.
    """
    spark = docs.sparkSession
    counted = stored(term_counts(docs, text_col, (lang_col, source_col)), "audit-counts")
    of_lang = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("lang_count"))
    kept = stored(of_lang.where(F.col("docs") >= min_docs).select("lang", "term", "lang_count"), "audit-terms")
    langs = stored(kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_count").alias("lang_total")), "audit-langs")
    entries = stored(counted.join(kept, ["lang", "term"]).select("lang", "source", "term", "count", "lang_count"), "audit-entries")
    lang, source = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (lang_col, source_col))
    every = docs.select(lang.alias("lang"), source.alias("source")).distinct()
    groups = stored(
        every.join(entries.groupBy("lang", "source").agg(F.sum("count").alias("total")), ["lang", "source"], "left").join(langs, "lang", "left")
        .join(every.groupBy("lang").agg(F.count("*").alias("in_lang")), "lang")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"), "lang_total",
                F.ceil(F.col("in_lang") / sources).cast("int").alias("blocks"))
        .withColumn("none", F.when(F.col("terms") > 0, probability(F.lit(0), F.col("total"), F.col("terms"), added)).otherwise(0))
        .withColumn("block", F.pmod(F.xxhash64("source"), "blocks").cast("int"))
        .withColumn("chunks", F.greatest(F.ceil(F.col("terms") / terms), F.lit(1)).cast("int")), "audit-groups",
    )
    likely = entries.join(groups, ["lang", "source"]).withColumn("p", probability(F.col("count"), F.col("total"), F.col("terms"), added))
    more = likely.withColumn("value", F.col("p") - probability(F.col("lang_count"), F.col("lang_total"), F.col("terms"), added)).where("value > 0")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked_terms = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value").withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    # every source stands in all chunks of its language, with its probability of a term it does not have
    blank = groups.withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)"))).select(
        "lang", "chunk", "block", "blocks", "source", F.lit(None).cast("string").alias("term"), F.col("none").alias("p"))
    held = likely.select("lang", F.pmod(F.xxhash64("term"), "chunks").cast("int").alias("chunk"), "block", "blocks", "source", "term", "p")
    met = blank.unionByName(held).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "lang", "chunk", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "source", "term", "p")

    def differ(group: pa.Table) -> pa.Table:
        names, at = np.unique(np.array(group.column("source").to_pylist(), dtype=object), return_inverse=True)
        p, term = group.column("p").to_numpy(), group.column("term").combine_chunks().dictionary_encode()
        blank = group.column("term").is_null().to_numpy()
        base, block = np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=np.int64)
        base[at[blank]], block[at] = p[blank], group.column("block").to_numpy()
        table = np.repeat(base[:, None], len(term.dictionary), axis=1)
        table[at[~blank], term.indices.to_numpy(zero_copy_only=False)[~blank].astype(np.int64)] = p[~blank]
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        out = {"lang": [], "source": [], "item": [], "more": []}
        for k in np.flatnonzero(block == i):
            others = np.flatnonzero(block == j)
            others = others[others > k] if i == j else others
            beyond = np.abs(table[others] - table[k]).sum(axis=1) - np.abs(base[others] - base[k]) * table.shape[1]
            for column, values in zip(out.values(), ([group.column("lang")[0].as_py()] * len(others), [names[k]] * len(others), names[others], beyond)):
                column.extend(values)
        return pa.table({c: pa.array(v, pa.int64() if c == "more" else pa.string()) for c, v in out.items()})

    beyond = met.groupBy("lang", "chunk", "i", "j").applyInArrow(differ, "lang string, source string, item string, more long")
    sums = beyond.groupBy("lang", "source", "item").agg(F.sum("more").alias("more"))
    mine = groups.select("lang", "source", "none", "terms")
    theirs = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("item_none"))
    distance = sums.join(mine, ["lang", "source"]).join(theirs, ["lang", "item"]).select(
        "lang", "source", "item", (F.col("more") + F.col("terms") * F.abs(F.col("none") - F.col("item_none"))).alias("value"))
    both = distance.unionByName(distance.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    ranked_pairs = both.withColumn("rank", F.row_number().over(by_value)).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    return ranked_pairs.unionByName(ranked_terms)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of all ``documents`` differ within each language."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = rf"""
with docs as (select row_number() over () as no, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
words as (select no, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as word from docs),
counted as (select lang, source, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term, no, count(*) as n from words group by all),
kept as (select lang, term, sum(n)::hugeint as q_count from counted group by lang, term having count(distinct no) >= {MIN_DOCS}),
langs as (select lang, count(*) as v, sum(q_count) as q_total from kept group by lang),
groups as (select distinct lang, source from docs),
dense as (
  select g.lang, g.source, k.term, k.q_count, coalesce(sum(c.n), 0)::hugeint as n
  from groups g join kept k using (lang) left join counted c on c.lang = g.lang and c.source = g.source and c.term = k.term
  group by all
),
likely as (
  select d.*, 1 + ({SCALE}::hugeint * (n + {ADDED})) // (sum(n) over (partition by d.lang, source) + {ADDED} * v)::hugeint as p,
    1 + ({SCALE}::hugeint * (q_count + {ADDED})) // (q_total + {ADDED} * v)::hugeint as q
  from dense d join langs using (lang)
),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum(abs(x.p - y.p)), 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join likely x on x.lang = a.lang and x.source = a.source left join likely y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by all
),
terms as (select lang, source, 'term' as part, term as item, (p - q)::bigint as value from likely where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
  from (select * from pairs union all select * from terms)
)
select * from ranked where part = 'pair' or rank <= {TOP}
"""
