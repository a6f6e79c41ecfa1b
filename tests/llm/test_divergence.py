import re
from collections import Counter, defaultdict

import pytest

from factloom.llm.divergence import SCALE, audit, term_counts

from .conftest import WORDS, rows_of


def words_of(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]


def brute(rows, min_docs, added, top):
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        found = Counter(words_of(text))
        docs[lang or ""].update(found.keys())
        counts[lang or "", source or ""].update(found)
    out = []
    for lang in {k[0] for k in counts}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        whole = Counter()
        mine = {s: c for (x, s), c in counts.items() if x == lang}
        for c in mine.values():
            whole.update(c)

        def p(c):
            total = sum(c[t] for t in kept) + added * len(kept)
            return {t: 1 + SCALE * (c[t] + added) // total for t in kept}

        probs, q = {s: p(c) for s, c in mine.items()}, p(whole)
        for s in mine:
            pairs = sorted((-sum(abs(probs[s][t] - probs[o][t]) for t in kept), o.encode(), o) for o in mine if o != s)
            terms = sorted((q[t] - probs[s][t], t.encode(), t) for t in kept if mine[s][t] and probs[s][t] > q[t])[:top]
            out += [(lang, s, part, x[2], -x[0], n + 1) for part, found in (("pair", pairs), ("term", terms)) for n, x in enumerate(found)]
    return sorted(out)


def made(texts):
    import random

    rng = random.Random(8)
    rows = [(n, t, ["xx", "yy", None, ""][n % 4], [None, "", "s1", "s2", "s3"][n % 5]) for n, t in enumerate(texts * 3)]
    rows += [(n, " ".join(rng.choices(WORDS[n % 7 :], k=rng.randint(1, 60))), "xx", f"s{n % 9}") for n in range(200, 400)]
    rows += [(500, None, "zz", "s1"), (501, "12 --", "zz", "s2"), (502, "ÀÉ Straße STRASSE a\x00b [\\]^_` {|}~\x7f 日本 İ", "xx", "odd"), (503, "Big " * 400_000, "xx", "long")]
    return rows + rows[:20]


@pytest.mark.parametrize("sizes", [dict(), dict(sources=3, terms=10)])
def test_equals_brute_force(spark, texts, sizes):
    rows = made(texts)
    got = audit(rows_of(spark, rows).repartition(4), min_docs=3, top=5, **sizes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 5, 5)


def test_no_kept_terms_and_no_rows(spark, texts):
    rows = made(texts)[:30]
    got = audit(rows_of(spark, rows), min_docs=1000).collect()
    assert sorted(map(tuple, got)) == brute(rows, 1000, 5, 50) and all(r.value == 0 and r.part == "pair" for r in got)
    assert audit(rows_of(spark, [])).count() == 0


def test_counts_of_documents_and_occurrences(spark):
    rows = [(1, "a b A", "x", "s"), (2, "a", "x", "s"), (3, None, "x", "s"), (4, "", "x", None)]
    got = {(r.source, r.term): (r.docs, r["count"]) for r in term_counts(rows_of(spark, rows)).collect()}
    assert got == {("s", "a"): (2, 3), ("s", "b"): (1, 1)}
