"""Merkle manifest of a data set: a tree for each group of rows, and one over their roots.

The tree is built level by level with a slot pivot. Node ``n`` of a level has
parent ``n div FANOUT`` and slot ``n mod FANOUT``; conditional aggregates spread
the children of a parent over ``FANOUT`` columns. The columns put together and
hashed are the parent; put together without a child's own column they are its
siblings. A group of rows with one key has at most ``FANOUT`` members at any
level, so a large group of documents is many keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import stored

FANOUT = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the texts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[str], **instead: Column) -> Column:
    """Hash of a row's fields; ``instead`` gives other values for some of them."""
    return digest(*[field(instead.get(c, F.col(f"`{c}`"))) for c in fields])


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``n``, their place from 0 within ``tree`` by ``order``, and ``size``, the rows of the tree; written.

    Rows are dealt by ranges of tree and order and written with their place in
    the part; counts by (tree, part) give what lies before, so no task sees a
    whole tree and the running sums are over one row for a tree and part.
    """
    laid = stored(
        rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
        .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), f"{name}-laid",
    )
    parts = laid.groupBy("tree", "part").agg(F.count("*").alias("held"), F.min("at").alias("first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = stored(parts.select(
        "tree", "part", (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("held").over(whole).alias("size"),
    ), f"{name}-parts")
    return laid.join(placed, ["tree", "part"]).withColumn("n", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def pivoted(nodes: DataFrame, kept: list[str]) -> DataFrame:
    """``tree, n, size`` of every parent of ``nodes`` (``tree, n, size, hash`` and ``kept``), its children in columns ``c0`` and on.

    A column is null where the last parent of a level has no such child. ``size``
    counts the parents of the tree.
    """
    slot, child = F.pmod("n", F.lit(FANOUT)), F.struct("hash", *kept)
    columns = [F.max(F.when(slot == k, child)).alias(f"c{k}") for k in range(FANOUT)]
    return nodes.groupBy("tree", F.expr(f"n div {FANOUT}").alias("n"), F.ceil(F.col("size") / FANOUT).alias("size")).agg(*columns)


def hash_of(k: int) -> Column:
    return F.coalesce(F.col(f"c{k}")["hash"], F.lit(""))


def parents(pivot: DataFrame) -> DataFrame:
    """``tree, n, size, hash`` of the parents themselves."""
    return pivot.select("tree", "n", "size", digest(*[hash_of(k) for k in range(FANOUT)]).alias("hash"))


def steps_down(pivot: DataFrame, above: DataFrame) -> DataFrame:
    """A row for every child in ``pivot``: its own fields and ``path``, from its level to the root.

    ``above`` has the ``path`` of the parents by tree and n. A step is the text of
    the siblings to the left of the own slot and of those to the right.
    """
    def step(k: int) -> Column:
        left, right = ([hash_of(j) for j in range(FANOUT) if j < k], [hash_of(j) for j in range(FANOUT) if j > k])
        return F.struct(F.concat(F.lit(""), *left).alias("left"), F.concat(F.lit(""), *right).alias("right"))

    slots = F.array(*[F.struct(F.lit(k).alias("slot"), F.col(f"c{k}").alias("child"), step(k).alias("step")) for k in range(FANOUT)])
    joined = pivot.join(above.select("tree", "n", "path"), ["tree", "n"])
    each = joined.select("tree", "n", "path", F.explode(slots).alias("s")).where("s.child is not null")
    return each.select("tree", (F.col("n") * FANOUT + F.col("s.slot")).alias("n"), "s.child.*", F.concat(F.array("s.step"), F.col("path")).alias("path"))


def levels(nodes: DataFrame, name: str, kept: list[str]) -> tuple[list[DataFrame], list[DataFrame]]:
    """Nodes of every level of all trees, and the pivots between levels; written. The driver learns the size of the largest tree, nothing else."""
    heights, pivots = [nodes], []
    largest = nodes.agg(F.max("size")).collect()[0][0] or 0
    while largest > 1:
        pivots.append(stored(pivoted(heights[-1].where("size > 1"), [] if pivots else kept), f"{name}-level"))
        heights.append(parents(pivots[-1]))
        largest = -(-largest // FANOUT)
    return heights, pivots


def roots(heights: list[DataFrame]) -> DataFrame:
    """``tree, hash`` of the last node of every tree."""
    return reduce(DataFrame.unionByName, [h.where("size = 1").select("tree", "hash") for h in heights])


def paths(heights: list[DataFrame], pivots: list[DataFrame], above: DataFrame, kept: list[str]) -> DataFrame:
    """``tree, n, hash, path`` and ``kept`` of the lowest nodes; ``above`` (``tree, path``) is how each tree goes on beyond its last node."""
    def lasts(k: int) -> DataFrame:
        return heights[k].where("size = 1").join(above, "tree").select("tree", "n", "hash", *([] if k else kept), "path")

    found = lasts(len(pivots))
    for k in range(len(pivots) - 1, -1, -1):
        found = steps_down(pivots[k], found).unionByName(lasts(k))
    return found


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda at, step: digest(step["left"], at, step["right"]))


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(
    docs: DataFrame, fields: list[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", changed: Column | None = None
) -> DataFrame:
    """``group, id, leaf, subroot, root, path, changed`` of every row.

    A leaf is the hash of ``fields``. The leaves of a group, in order of id (null
    first, ties by leaf), are the lowest nodes of its tree; a level's nodes are
    hashed in runs of ``FANOUT`` until one is left, the subroot. The subroots in
    order of group (null first, then by bytes) are the lowest nodes of the tree
    that gives the root. ``path`` has a step for every level from the leaf to the
    root, with the hashes to the left and to the right of the own one; ``fold``
    leads a leaf up along it. ``changed``, an expression over the columns of
    ``docs``, is carried along for checks (null: not changed).

    Texts are read once and hashed in place; what is shuffled are hashes and ids.
    Repeated rows are leaves of their own, with equal hashes; which of them stands
    first makes no difference. Nulls count as ``-``. Columns not named are not
    read. One row: its leaf is the root, its path empty. No rows: no rows.
    """
    kept = ["id", "changed"]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("")).alias("tree"), F.col(f"`{id_col}`").alias("id"),
        leaf(fields).alias("hash"), (F.lit(None).cast("string") if changed is None else changed).alias("changed"),
    ).withColumn("tie", F.monotonically_increasing_id())
    low = numbered(leaves, ["id", "hash", "tie"], "merkle").select("tree", "n", "size", "hash", *kept)
    heights, pivots = levels(low, "merkle", kept)
    subroots = stored(roots(heights), "merkle-subroots")
    top = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "hash"), ["group"], "merkle-top")
    tops, top_pivots = levels(top.select("tree", "n", "size", "hash", "group"), "merkle-top", ["group"])
    end = docs.sparkSession.sql("select '' as tree, cast(array() as array<struct<left: string, right: string>>) as path")
    above = stored(
        paths(tops, top_pivots, end, ["group"]).join(roots(tops).withColumnRenamed("hash", "root"), "tree")
        .select(F.col("group").alias("tree"), "path", F.col("hash").alias("subroot"), "root"), "merkle-above",
    )
    found = paths(heights, pivots, above.select("tree", "path"), kept).join(above.select("tree", "subroot", "root"), "tree")
    group = F.when(F.col("tree") != "", F.substr("tree", F.lit(2)))
    return found.select(group.alias("group"), "id", F.col("hash").alias("leaf"), "subroot", "root", "path", "changed")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its proof, and what becomes of the root where capitals are lower-cased."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    small = leaf(FIELDS, text=F.translate("text", _CAPITALS, _SMALL))
    found = manifest(docs, changed=F.when(touched, small))
    folded = found.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return folded.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _sql() -> str:
    """The same in DuckDB: levels written out, enough for groups of 16 million rows."""
    def value(c: str) -> str:
        return f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')"

    def leaf_of(text: str) -> str:
        return "sha256(" + " || ".join(value(text if c == "text" else c) for c in FIELDS) + ")"

    def tree(low: str, prefix: str, top: int) -> list[str]:
        """Levels ``{prefix}0`` (``tree, n, hash``) to ``{prefix}{top}``; a level has no nodes of trees that ended below it."""
        made = [f"{prefix}0 as ({low})"]
        for k in range(top):
            made.append(
                f"{prefix}{k + 1} as (select tree, n // {FANOUT} as n, sha256(string_agg(hash, '' order by n)) as hash from {prefix}{k} "
                f"where tree in (select tree from {prefix}{k} group by tree having count(*) > 1) group by tree, n // {FANOUT})"
            )
        ends = " union all ".join(f"select tree, min(hash) as hash from {prefix}{k} group by tree having count(*) = 1" for k in range(top + 1))
        return [*made, f"{prefix}_end as ({ends})"]

    def climb(start: str, prefix: str, top: int, name: str) -> list[str]:
        """From ``start`` (``id, tree, n, cur, proof``) up all levels: ``{name}`` with ``cur`` and ``proof`` at the end."""
        made, held = [], start
        for k in range(top):
            others = f"select tree, n // {FANOUT} as up, list(hash order by n) as hashes, min(n) as first, max(w.c) as c from {prefix}{k} join (select tree, count(*) as c from {prefix}{k} group by tree) w using (tree) group by tree, n // {FANOUT}"
            left, right = "array_to_string(hashes[1:p.n - first], '')", "array_to_string(hashes[p.n - first + 2:], '')"
            made.append(
                f"{name}{k} as (select p.* exclude (n, cur, proof), p.n // {FANOUT} as n, case when o.c > 1 then sha256({left} || p.cur || {right}) else p.cur end as cur, "
                f"case when o.c > 1 then p.proof || {left} || {right} else p.proof end as proof "
                f"from {held} p left join ({others}) o on o.tree = p.tree and o.up = p.n // {FANOUT})"
            )
            held = f"{name}{k}"
        return [*made, f"{name} as (select * from {held})"]

    small = f"translate(text, '{_CAPITALS}', '{_SMALL}')"
    crc = (
        "xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(range(1, strlen(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i, 1))::ubigint)), "
        "lambda a, b: xor(a >> 8, crc_table[((xor(a, b) & 255) + 1)::bigint])), 4294967295::ubigint)"
    )
    step = "list_reduce(list_prepend(i::ubigint, range(8)::ubigint[]), lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384::ubigint) else a >> 1 end)"
    parts = [
        f"crc_of as (select list({step} order by i) as crc_table from range(256) t(i))",
        f"leaves as (select doc_id, coalesce('=' || lang, '') as tree, {leaf_of('text')} as leaf, case when ({crc}) % 3 = 0 then {leaf_of(small)} end as changed from documents, crc_of)",
        "placed as (select row_number() over () as id, *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as n from leaves)",
        *tree("select tree, n, leaf as hash from placed", "low", 8),
        "tops as (select tree as grp, hash, row_number() over (order by tree) - 1 as n from low_end)",
        *tree("select '' as tree, n, hash from tops", "top", 5),
        "p0 as (select id, doc_id, leaf, tree, n, coalesce(changed, leaf) as cur, '' as proof from placed)",
        *climb("p0", "low", 8, "mid"),
        "q0 as (select m.id, m.doc_id, m.leaf, t.hash as subroot, '' as tree, t.n as n, m.cur, m.proof from mid m join tops t on t.grp = m.tree)",
        *climb("q0", "top", 5, "done"),
    ]
    return "with " + ",\n".join(parts) + (
        "\nselect doc_id, leaf, subroot, e.hash as root, sha256(proof) as proof_sha256, cur as folded_root, cur = e.hash as verified from done, top_end e"
    )


OP12_SQL = _sql()
