import hashlib
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from factloom.llm.merkle import fold, manifest, op12_merkle, siblings

from .conftest import rows_of


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(hashes):
    """Root, and for every leaf the siblings and sides of each level."""
    level, at, steps = list(hashes), list(range(len(hashes))), [[] for _ in hashes]
    while len(level) > 1:
        for k, p in enumerate(at):
            run = level[p // 8 * 8 : p // 8 * 8 + 8]
            steps[k].append((run[: p % 8], run[p % 8 + 1 :]))
        level, at = [sha(*level[k : k + 8]) for k in range(0, len(level), 8)], [p // 8 for p in at]
    return level[0], steps


def brute(rows):
    """``doc_id, leaf, subroot, root, proof, folded, verified`` of rows of (doc_id, source, lang, n_chars, text)."""
    leaf_of = lambda r: sha(*map(field, r))
    order = sorted(rows, key=lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf_of(r)))
    groups = [list(g) for _, g in groupby(order, key=lambda r: r[2])]
    subs = [tree([leaf_of(r) for r in g]) for g in groups]
    root, tops = tree([s for s, _ in subs])
    out = []
    for g, (sub, steps), top in zip(groups, subs, tops):
        for r, mine in zip(g, steps):
            at = leaf_of(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                at = leaf_of((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for left, right in mine + top:
                at = sha(*left, at, *right)
            out.append((r[0], leaf_of(r), sub, root, sha(*[x for left, right in mine + top for x in left + right]), at, at == root))
    return sorted(out, key=str)


def result(spark, tmp_path, rows):
    docs = rows_of(spark, [(i, t, lang, s) for i, s, lang, _, t in rows]).withColumn("n_chars", F.length("text").cast("long")).repartition(5)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return sorted((tuple(r) for r in op12_merkle(spark, str(tmp_path)).collect()), key=str)


def made(rows):
    return [(i, s, lang, None if t is None else len(t), t) for i, s, lang, t in rows]


@pytest.mark.parametrize("size", [1, 2, 8, 9, 65, 520])
def test_proofs_of_groups_of_many_sizes(spark, tmp_path, size):
    rows = made([(n, f"s{n % 3}", "en", f"Text {n}") for n in range(size)])
    assert result(spark, tmp_path, rows) == brute(rows)


def test_odd_rows(spark, tmp_path, texts):
    rows = made([(n, None if n % 4 == 0 else "ß", [None, "", "de", "É"][n % 4], t) for n, t in enumerate(texts)])
    rows += made([(n, "s", f"lang {n}", "One Word") for n in range(100, 120)] + [(None, None, None, None), (7, "a", "de", "x"), (7, "a", "de", "Y"), (7, "a", "de", "Y")])
    rows += made([(200, "s", "de", "A" * 3_000_000)])
    got = result(spark, tmp_path, rows)
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_folds_and_no_rows(spark):
    docs = spark.createDataFrame([(n, "g", n % 2) for n in range(20)], "key long, tree string, n int")
    found = manifest(docs, ["key", "n"], "key", "tree").withColumn("folded", fold(F.col("leaf"), F.col("path"))).withColumn("said", siblings(F.col("path")))
    rows = found.collect()
    assert len(rows) == 20 and all(r.folded == r.root for r in rows) and len({r.root for r in rows}) == 1
    assert {len(r.said) for r in rows} <= {64 * (7 + 2), 64 * (3 + 2)}
    assert manifest(docs.where("false"), ["key"], "key", "tree").count() == 0
