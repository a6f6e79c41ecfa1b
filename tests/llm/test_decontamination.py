import random
import re

import numpy as np
import pytest

from factloom.llm import tokens
from factloom.llm.decontamination import decontaminated, leaks, tiles, windows

from .conftest import WORDS, rows_of


def greedy(text, item, smallest):
    """Tiling by trying every pair of places."""
    in_text, in_item, out = set(), set(), []
    while True:
        best, where = smallest - 1, []
        for t in range(len(text)):
            for k in range(len(item)):
                n = 0
                while t + n < len(text) and k + n < len(item) and t + n not in in_text and k + n not in in_item and text[t + n] == item[k + n]:
                    n += 1
                if n > best:
                    best, where = n, []
                if n == best and n >= smallest:
                    where.append((t, k))
        if not where:
            return out
        for t, k in where:
            if not in_text & {*range(t, t + best)} and not in_item & {*range(k, k + best)}:
                in_text |= {*range(t, t + best)}
                in_item |= {*range(k, k + best)}
                out.append((t, k, best))


def test_tiling_by_hand_and_by_brute_force():
    item = list(range(20))
    assert tiles(item[10:] + [99] + item[:10], item) == [(0, 10, 10), (11, 0, 10)]  # reordered
    assert tiles(item + item, item) == [(0, 0, 20)] and tiles([], item) == [] and tiles(item, []) == [] and tiles(item[:4], item) == []
    rng = random.Random(1)
    for _ in range(200):
        text, part = [rng.randrange(3) for _ in range(30)], [rng.randrange(3) for _ in range(12)]
        assert tiles(text, part, 3) == greedy(text, part, 3)
    assert [k for _, k in windows([1, 2, 3, 1, 2], [False, False, True, False, False], 2)] == [0, 3]


def test_long_texts_are_hashed_in_pieces_without_cutting_words(monkeypatch):
    texts = [("Ab c " * 50 + "x" * 70 + " é").encode(), b"", b"...", b"one"]
    whole = tokens.hashed_words(texts)
    monkeypatch.setattr(tokens, "_CHARS", 30)
    assert all(np.array_equal(a, b) for a, b in zip(whole, tokens.hashed_words(texts))) and len(whole[0]) == 103


@pytest.fixture(scope="module")
def bench():
    rng = random.Random(9)
    common = rng.choices(WORDS, k=8)  # a phrase of every item
    items = [(n, " ".join(common + rng.choices(WORDS, k=24))) for n in range(12)]
    return [*items, (12, items[3][1].upper() + "!"), (13, None), (14, "... "), (15, "two words"), (None, "null item of some five words"), (0, items[0][1])]


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_leaks_are_those_of_brute_force(spark, texts, bench):
    rng = random.Random(10)
    fill = lambda n: " ".join(rng.choices(WORDS, k=n))
    held = []
    for n, text in bench[:12]:
        w = text.split()
        held += [f"{fill(50)} {text} {fill(20)}", f"{fill(5)}, {' '.join(w[20:])}. {fill(9)} {' '.join(w[:20])}", " ".join(w[:10]), " ".join(w[8:19]).upper(), text.replace(" ", ", ")]
    rows = [(n, t, None, None) for n, t in enumerate([*texts, *held, "Here: TWO words.", "null item of some five words", fill(3000) + " " + bench[5][1]])]
    rows += [(None, bench[2][1], None, None), rows[30], rows[30]]
    docs = rows_of(spark, rows).repartition(3)
    benchmark = spark.createDataFrame([(*b, "x", "y") for b in bench], "item_id long, text string, seed string, words string")
    got = leaks(docs, benchmark)
    named = {}
    for i, t in bench:
        if i is not None and words(t):
            named[tuple(words(t))] = min(i, named.get(tuple(words(t)), i))
    want = {}
    for key, text, *_ in rows:
        w = words(text)
        for item, i in named.items():
            least = min(5, len(item))
            if len(w) > 500 and not any(tuple(w[k : k + least]) in {item[j : j + least] for j in range(len(item))} for k in range(len(w))):
                continue
            number = {x: k for k, x in enumerate(dict.fromkeys([*item, *w]))}
            covered = sum(n for *_, n in tiles([number[x] for x in w], [number[x] for x in item], least))
            if 2 * covered >= len(item):
                want[(key, text, i)] = covered
    assert len(want) > 30
    got = got.collect()
    assert sorted((r.id or -1, r.item_id, r.covered) for r in got) == sorted((k or -1, i, n) for (k, _, i), n in want.items())
    for r in got:  # tiles are places in the text
        text = words(next(t for k, t, *_ in rows if k == r.id and (k, t, r.item_id) in want))
        item = next(w for w, i in named.items() if i == r.item_id)
        assert all(tuple(text[t.doc_start : t.doc_start + t.length]) == item[t.item_start : t.item_start + t.length] for t in r.tiles)
    kept = decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(k or -1 for k, t, *_ in rows if not any((k, t) == w[:2] for w in want))


def test_empty_tables(spark, bench):
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    none, docs = rows_of(spark, []), rows_of(spark, [(1, bench[0][1], None, None)])
    assert leaks(none, benchmark).count() == 0 and decontaminated(none, benchmark).count() == 0
    assert leaks(docs, benchmark.limit(0)).count() == 0 and decontaminated(docs, benchmark.limit(0)).count() == 1
