"""Words of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD: list[np.ndarray] = []
_POWERS: list[np.ndarray] = []
#: Characters hashed together; arrays over characters are dropped after each piece.
_CHARS = 1 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b)]), dtype=np.uint64) for b in (_BASE, _INVERSE)]
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Polynomial prefix hashes: entry k covers the first k values."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def spans(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values from start to end, alike wherever they stand."""
    return (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of a hash over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_table() -> np.ndarray:
    if not _WORD:
        _WORD.append(np.frombuffer(bytes(chr(c).isalnum() for c in range(0x110000)), dtype=bool))
    return _WORD[0]


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased runs of letters and digits of all texts, and the text each stands in."""
    words, owners, held, of, size = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)], [], [], 0

    def flush() -> None:
        codes = [np.frombuffer(p.lower().encode("utf-32-le"), dtype=np.uint32) for p in held]
        gap = np.zeros(1, dtype=np.uint32)
        every = np.concatenate([x for c in codes for x in (c, gap)])
        word = word_table()[every]
        edge = np.diff(word.view(np.int8), prepend=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        piece = np.searchsorted(np.cumsum([len(c) + 1 for c in codes]), start, side="right")
        words.append(mixed(spans(prefix_sums(every), start, end) + (end - start).astype(np.uint64)))
        owners.append(np.array(of, dtype=np.int64)[piece])
        held.clear()
        of.clear()

    for k, text in enumerate(texts):
        text, lo = text.decode("utf-8", "replace"), 0
        while lo < len(text):
            hi = min(len(text), lo + _CHARS)
            while hi < len(text) and text[hi - 1].isalnum():  # no word is cut
                hi += 1
            held.append(text[lo:hi])
            of.append(k)
            size, lo = size + hi - lo, hi
            if size >= _CHARS:
                flush()
                size = 0
    if held:
        flush()
    return np.concatenate(words), np.concatenate(owners)


def hashed_grams(words: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n``-word shingles and the position of their first word; none crosses texts."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        total = mixed(total * _BASE + words[at + k])
    return total, at
