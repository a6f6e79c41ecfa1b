"""Pairs of near texts against plain edit distances."""

import random

import pytest

from factloom.operators.candidates import SHORT_TERM, near_terms


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def changed(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text) + 1)
        text = rng.choice([text[:at] + "é" + text[at:], text[:at] + text[at + 1:], text[:at] + "b" + text[at + 1:]])
    return text


@pytest.mark.parametrize("most", [1, 2, 3])
def test_near_terms_are_those_of_all_pairs(spark, most):
    rng = random.Random(most)
    terms = ["", "a", "ab", "été", "aaaaaaaa", "word " * 200]
    terms += ["".join(rng.choice("abé ") for _ in range(n)) for n in [3, 5, SHORT_TERM - 3, *range(SHORT_TERM - 1, SHORT_TERM + 5), 60]]
    texts = terms + [changed(rng, t, n) for t in terms for n in range(1, most + 2) for _ in range(3)] + ["x" + t[1:] for t in terms]
    df = lambda name, values: spark.createDataFrame([(v, 1) for v in [*values, None, *values]], f"{name} string, edits int")
    got = sorted(map(tuple, near_terms(df("text", texts), df("term", terms), most).collect()))
    want = sorted((a, b, d) for a in set(texts) for b in set(terms) for d in [edits(a, b)] if d <= most)
    assert got == want
    assert near_terms(df("text", texts), df("term", []), most).filter("term is not null").count() == 0
