import numpy as np
import pytest

from factloom.llm.vectors import near_vectors, products, quantised, tile_links, unit


def brute(rows, threshold=0.95):
    """n_links by row, component by id."""
    def ok(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [k for k, (i, v) in enumerate(rows) if i is not None and ok(v)]
    links, label = [0] * len(rows), {i: i for i, _ in rows if i is not None}
    for a in good:
        for b in good:
            if a < b and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    p, q = label[rows[a][0]], label[rows[b][0]]
                    label = {k: min(p, q) if v in (p, q) else v for k, v in label.items()}
    return links, label


def test_bounds_are_rigorous_and_products_exact():
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(200, 48)) * 10.0 ** rng.integers(-150, 150, (200, 1))
    vectors[100:] = vectors[:100] + np.linalg.norm(vectors[:100], axis=1, keepdims=True) * rng.normal(size=(100, 48)) * 0.045
    units = unit(vectors)
    codes, scale, bound = quantised(units)
    assert np.all(np.linalg.norm(units - codes * scale[:, None], axis=1) <= bound)
    exact = codes.astype(np.int64) @ codes.astype(np.int64).T
    assert np.array_equal(products(codes, codes), exact)
    real = units @ units.T
    assert np.all(scale[:, None] * scale * exact + (1 + bound[:, None]) * bound + bound[:, None] >= real)
    side = (codes, scale, bound, units)
    got = {(int(a), int(b)) for i, j in tile_links(side, side, 0.95, True) for a, b in zip(i, j)}
    want = {(i, j) for i in range(200) for j in range(i + 1, 200) if units[i] @ units[j] >= 0.95}
    assert got == want and want
    wide = np.full((2, 3000), 127, dtype=np.int8)
    assert products(wide, wide)[0, 1] == 3000 * 127 * 127


@pytest.mark.parametrize("block_rows", [4, 4096])
def test_links_and_components(spark, block_rows):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 16))
    rows = [(n, [float(np.float32(x)) for x in centres[n % 6] + rng.normal(size=16) * 0.12]) for n in range(40)]
    rows += [(40, rows[3][1]), (41, rows[3][1]), (41, rows[3][1]), (42, [x * 2 for x in rows[3][1]]), (43, None), (44, []), (45, [0.0, -0.0]),
             (46, [1.0, None]), (47, [float("nan"), 1.0]), (48, [float("inf"), 1.0]), (49, [1.0, 0.0]), (50, [1.0, -0.0]), (None, rows[0][1]), (51, [-1.0, 0.0])]
    frame = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<float>, node string, hash double").repartition(3)
    got = near_vectors(frame, block_rows=block_rows).collect()
    links, label = brute(rows)
    assert any(links[:40])
    want = [(i or -1, n, -1 if i is None else label[i], i is not None and label[i] == i) for (i, _), n in zip(rows, links)]
    assert sorted((r.id or -1 if r.id != 0 else -1, r.n_links, r.component_id if r.component_id is not None else -1, r.kept) for r in got) == sorted(want)


def test_no_rows(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0
