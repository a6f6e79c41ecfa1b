import random

import numpy as np
import pytest

from factloom.llm import suffixes
from factloom.llm.suffixes import anchors, repeats, suffix_sort, without_repeats

from .conftest import rows_of


def brute(rows, window=100):
    """Removed positions by (id, text), from a table of all windows."""
    docs = sorted({(-1 if i is None else i, t) for i, t in ((r[0], (r[1] or "").encode()) for r in rows)})
    first = {}
    for i, t in docs:
        for p in range(len(t) - window + 1):
            first[t[p : p + window]] = min(first.get(t[p : p + window], (i, p)), (i, p))
    out = {}
    for i, t in docs:
        mask = bytearray(len(t))
        for p in range(len(t) - window + 1):
            if first[t[p : p + window]] < (i, p):
                mask[p : p + window] = b"\1" * window
        out[i, t] = mask
    return out


def test_every_window_has_the_anchor_of_its_bytes():
    rng = random.Random(1)
    shared = bytes(rng.choices(b"ab", k=150))
    texts = [b"", bytes(rng.choices(b"abc", k=400)) + shared, shared + b"x" * 300, b"short", shared[:99], shared[:100]]
    by_window = {}
    for piece in (1 << 20, 150):
        text, hashes, place, nearest, furthest = anchors(texts, piece=piece)
        seen = {}
        for t, h, p, lo, hi in zip(text.tolist(), hashes.tolist(), place.tolist(), nearest.tolist(), furthest.tolist()):
            for o in range(lo, hi + 1):
                window = texts[t][p - o : p - o + 100]
                assert len(window) == 100 and (t, p - o) not in seen
                seen[t, p - o] = 1
                assert by_window.setdefault(window, (h, o)) == (h, o)
        assert len(seen) == sum(max(0, len(t) - 99) for t in texts)
    assert len(anchors([])[0]) == len(anchors([b"", b"abc"])[0]) == 0


def test_suffix_sort_is_that_of_python(monkeypatch):
    rng = np.random.default_rng(2)
    for broken in (False, True):
        if broken:  # hashes that always collide: the bytes decide
            monkeypatch.setattr(suffixes, "powers", lambda n: (np.zeros(n, dtype=np.uint64),) * 2)
        for n, width in ((1, 8), (2, 8), (37, 100), (300, 33)):
            group = np.sort(rng.integers(0, 5, n))
            strings = rng.integers(0, 2, (n, width)).astype(np.uint8)
            strings[:, 9:] *= rng.integers(0, 2, (n, 1)).astype(np.uint8)
            order, common = suffix_sort(group, strings)
            want = sorted(range(n), key=lambda k: (group[k], strings[k].tobytes(), k))
            assert [(group[k], strings[k].tobytes()) for k in order] == [(group[k], strings[k].tobytes()) for k in want]
            for k in range(1, n):
                a, b = strings[order[k - 1]], strings[order[k]]
                if group[order[k - 1]] == group[order[k]]:
                    assert common[k] == (np.append(a != b, True)).argmax()
                else:
                    assert common[k] == -1


def test_repeats_of_one_anchor():
    rows = [b"l" * 5 + b"A" * 100, b"m" * 5 + b"A" * 100, b"m" * 5 + b"A" * 100]
    row, start, end = repeats(np.zeros(3, dtype=np.int64), np.array([1, 2, 2]), np.array([5, 5, 50]), np.zeros(3, dtype=np.int64), np.array([5, 5, 5]), rows, 100)
    assert [*zip(row.tolist(), start.tolist(), end.tolist())] == [(1, 5, 105), (2, 45, 150)]


@pytest.mark.parametrize("group_rows", [8192, 3])
def test_what_stays_is_that_of_brute_force(spark, texts, group_rows):
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    passage, line = letters(130), letters(101)
    more = [letters(rng.randrange(40)) + passage + letters(rng.randrange(60)) for _ in range(25)]
    more += [line + letters(3) + line, passage[:99], passage[20:] + line[:60], "ab" * 150, "xy" * 60 + passage, passage * 3, letters(9000) + line]
    rows = [(n, t, None, None) for n, t in enumerate([*more, *texts])]
    rng.shuffle(rows)
    rows += [(None, passage, None, None), rows[0], rows[0], (2, letters(20) + more[2], None, None)]
    got = without_repeats(rows_of(spark, rows).repartition(4), group_rows=group_rows).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    texts_of = {}
    for i, t, *_ in rows:
        texts_of.setdefault(i, set()).add((t or "").encode())
    assert sum(bool(r.spans) for r in got) > 25
    for r in got:
        mask = bytearray(r.n_bytes)
        for s in r.spans:
            assert 0 <= s.start < s.end <= r.n_bytes
            mask[s.start : s.end] = b"\1" * (s.end - s.start)
        assert any(
            mask == want[-1 if r.id is None else r.id, t] and bytes(r.kept) == bytes(c for c, m in zip(t, mask) if not m)
            for t in texts_of[r.id] if len(t) == r.n_bytes
        )
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_no_rows(spark):
    assert without_repeats(rows_of(spark, [])).count() == 0
    assert [(r.n_bytes, r.spans) for r in without_repeats(rows_of(spark, [(1, None, None, None)])).collect()] == [(0, [])]
