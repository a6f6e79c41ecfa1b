import numpy as np
import pytest

from factloom.llm.partitions import balanced_start, cut_graph, first_of, nearest, search


def fits(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, queries, k):
    """``(query id, rank, id, score)`` over distinct valid rows."""
    rows, queries = ({(i, tuple(x + 0.0 for x in v)) for i, v in part if i is not None and fits(v)} for part in (rows, queries))
    out = []
    for q, v in queries:
        near = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, w)))), i) for i, w in rows if len(w) == len(v) and (i, w) != (q, v))
        out += [(q, n + 1, i, s) for n, (s, i) in enumerate(near[:k])]
    return sorted(out)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x", 1.0, "y") for i, v in rows], f"vec_id long, embedding array<{kind}>, part string, hash double, ids string").repartition(3)


def check(got, want, share=1.0):
    mine = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got)
    assert [m[:2] for m in mine] == [w[:2] for w in want]
    assert len({m[::2] for m in mine} & {w[::2] for w in want}) >= share * len({w[::2] for w in want})
    if share == 1.0:
        assert [m[2] for m in mine] == [w[2] for w in want] and np.allclose([m[3] for m in mine], [w[3] for w in want], rtol=1e-12, atol=0)


@pytest.mark.parametrize("tiles", [dict(), dict(tile_rows=7, tile_queries=3)])
def test_odd_rows_ties_and_copies_are_exact(spark, tiles):
    rng = np.random.default_rng(4)
    rows = [(n, [float(x) for x in rng.integers(-2, 3, 3)]) for n in range(60)]  # many ties and copies
    rows += [(n, [1.0, 1.0, 1.0]) for n in range(100, 140)] + [(7, rows[7][1]), (8, [9.0, 9.0, 9.0]), (None, [1.0, 2.0, 2.0])]
    rows += [(200, None), (201, []), (202, [0.0, -0.0, 0.0]), (203, [1.0, None, 1.0]), (204, [float("nan"), 1.0, 1.0]), (205, [float("inf"), 1.0, 1.0])]
    rows += [(210, [1.0, 0.0]), (211, [1.0, -0.0]), (212, [3.0, 4.0]), (213, [1.0])]
    asked = [r for r in rows if r[0] is not None and r[0] % 5 in (0, 1, 2, 3)]
    got = search(frame(spark, rows), frame(spark, asked), k=4, **tiles).collect()
    check(got, brute(rows, asked, 4))


def test_parts_hold_the_neighbours(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 12))
    rows = [(n, [float(np.float32(x)) for x in centres[n % 40] + rng.normal(size=12) * 0.3]) for n in range(1500)]
    asked = rows[::25]
    got = search(frame(spark, rows), frame(spark, asked), parts=16).collect()
    want = brute(rows, asked, 10)
    check(got, want, 0.9)
    exact = {(q, i): s for q, _, i, s in brute(rows, asked, 1500)}
    assert all(abs(exact[r.query_id, r.vec_id] - r.score) < 1e-12 for r in got)
    assert sorted(map(tuple, search(frame(spark, rows), frame(spark, asked), parts=16).collect())) == sorted(map(tuple, got))


def test_huge_components_and_no_rows(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, -1e200]), (3, [1e-200, 1e-200]), (4, [2.0, 1.0]), (5, [1.0, 1.0])]
    got = {(r.query_id, r["rank"]): r.vec_id for r in search(frame(spark, rows, "double"), frame(spark, rows, "double"), k=2).collect()}
    assert got[5, 1] == 4 and got[4, 1] == 5 and len(got) == 10
    none = frame(spark, [])
    assert search(none, none).count() == 0 and search(frame(spark, rows), none).count() == 0 and search(none, frame(spark, rows)).count() == 0
    assert search(frame(spark, [(100, [1.0])]), frame(spark, [(100, [1.0])])).count() == 0


def test_cut_is_balanced_and_follows_links():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(100, 4)) + 8 * c for c in np.eye(4)])
    away = ((points[:, None] - points) ** 2).sum(axis=2)
    links = np.argsort(away, axis=1)[:, 1:6]
    start = balanced_start(points, 4)
    assert np.bincount(start).tolist() == [100] * 4
    label = cut_graph(links, rng.permutation(np.repeat(np.arange(4), 100)), 4)
    assert np.bincount(label, minlength=4).max() <= 105
    lost = lambda x: int((x[links] != x[:, None]).sum())
    assert lost(cut_graph(links, start, 4)) <= lost(start) and lost(label) < 1500


def test_nearest_keeps_ties():
    rows = np.array([[1.0, 0], [0, 1], [-1, 0], [0, -1], [5, 5]])
    i, j, away = (np.concatenate(x) for x in zip(*nearest(np.zeros((1, 2)), rows, 2)))
    assert sorted(j.tolist()) == [0, 1, 2, 3] and away.tolist() == [1.0] * 4
    assert first_of(np.array([0, 0, 1, 0]), np.array([2.0, 1, 1, 1]), np.array([1, 9, 1, 3]), 2).tolist() == [3, 1, 2]
