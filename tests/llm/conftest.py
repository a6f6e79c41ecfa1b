import random

import pytest

#: Columns whose names clash with those that the operators make themselves.
EXTRA = ["id", "fp", "k1", "k2", "hash", "size", "row", "label", "block", "draw", "shard", "score", "spans", "count", "lines", "word"]


def rows_of(spark, rows):
    """``documents`` from (doc_id, text, lang, source), with clashing columns."""
    made = [(*r, *[f"x{k}" for k in range(len(EXTRA))]) for r in rows]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in EXTRA))


WORDS = [a + b + c for a in ("ka", "lo", "mi", "ne", "pu", "ra") for b in ("sta", "ven", "dor", "li") for c in ("", "n", "ska")]


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, shared passages, and every odd case."""
    rng = random.Random(5)
    words = lambda n: " ".join(rng.choices(WORDS, k=n))
    base, passage = words(120), words(40)
    near = base.split()
    near[60] = "changed"
    out = [base, base, " ".join(near), base.upper(), words(30) + " " + passage + " " + words(30), passage + "\n" + words(10),
           words(5) + " " + passage, None, "", None, "  \t\n ", "one", "one two", "...", "a" * 250, "ab " * 200, "é" * 130 + " ßü " * 40,
           words(4000), words(30), words(30)]
    return out
