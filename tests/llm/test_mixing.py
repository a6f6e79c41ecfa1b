import re
from collections import Counter

import numpy as np
import pytest

from factloom.llm.mixing import Quota, mix, plan_mix, quotas_of, shard_quotas, sized, targets

from .conftest import rows_of

SOURCES = ["b", None, "a", "B", "", "z", "b", "b"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    every = [*texts, *[" ".join(["w"] * (n % 17 + 3)) + f" {n}" for n in range(300)]]
    rows = [(n, t, None, SOURCES[n % len(SOURCES)]) for n, t in enumerate(every)]
    return rows_of(spark, [*rows, (None, "no id here", None, "a"), rows[0], (None, None, None, None)]).repartition(3)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_share_out_the_excess():
    assert targets([], []) == [] and targets([0, 0], [5, 2]) == [0, 0]
    assert targets([100, 100], [5, 2]) == pytest.approx([200, 100])
    got = targets([10, 1000, 400], [5, 2, 1])
    assert got == pytest.approx([20, 2095 * 2 / 3, 2095 / 3]) and sum(got) == pytest.approx(1.5 * 1410)


def test_splitting_tree_deals_every_draw_once(spark):
    quotas = [Quota("a", 1, blocks=7, rounds=1, last=3, cut=5), Quota("b", 1, blocks=40, rounds=2), Quota("c", 0, blocks=1)]
    for shards in (1, 5, 8):
        rows = shard_quotas(spark, quotas, shards, seed=3).collect()
        draws = Counter((r.source_no, d) for r in rows for d in range(r["first"], r["first"] + r.n))
        assert set(draws.values()) == {1} and set(draws) == {(0, d) for d in range(11)} | {(1, d) for d in range(80)}
        sizes = Counter()
        for r in rows:
            sizes[r.shard] += r.n
        assert max(sizes.values()) - min(sizes.values()) <= 1
        assert rows == shard_quotas(spark, quotas, shards, seed=3).collect()


@pytest.mark.parametrize("block_words", [50, 1 << 17])
def test_mix_takes_near_the_targets(spark, docs, block_words):
    mixed = mix(docs, block_words=block_words, shard_words=500).collect()
    again = mix(docs.repartition(5), block_words=block_words, shard_words=500).collect()
    assert sorted(map(repr, mixed)) == sorted(map(repr, again))
    rows = docs.collect()
    held, longest = Counter(), Counter()
    for r in rows:
        held[r.source] += words(r.text)
        longest[r.source] = max(longest[r.source], words(r.text))
    order = sorted(held, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, targets([held[s] for s in order], [(5.0, 2.0, 1.0)[k % 3] for k in range(len(order))])))
    taken = Counter()
    for r in mixed:
        taken[r.source] += words(r.text)
    for s in order:
        assert abs(taken[s] - want[s]) <= max(longest[s], 1)
    times, copies = Counter((r.doc_id, r.text) for r in mixed), Counter((r.doc_id, r.text) for r in rows)
    assert all(n <= 2 * copies[k] for k, n in times.items()) and all(words(k[1]) for k in times)
    assert mixed[0].asDict().keys() == {*docs.columns, "mix_shard"} and len({r.mix_shard for r in mixed}) > 1


def test_blocks_are_disjoint_and_complete(spark, docs):
    frame, quotas, shards = plan_mix(docs, "doc_id", "text", "source", 50, 500, 0)
    assert frame.count() == docs.count() and shards > 1 and max(q.blocks for q in quotas) > 5
    for q in quotas:
        for step, shift in zip(q.steps, q.shifts):
            assert sorted((b * step + shift) % q.blocks for b in range(q.blocks)) == list(range(q.blocks))


def test_no_rows(spark):
    empty = rows_of(spark, [])
    assert mix(empty).count() == 0 and quotas_of(sized(empty, "doc_id", "text", "source")) == []
    only = rows_of(spark, [(1, None, None, None), (2, "", None, "a")])
    assert mix(only).count() == 0
    assert np.isfinite([q.target for q in quotas_of(sized(only, "doc_id", "text", "source"))]).all()
