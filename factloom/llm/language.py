"""Language ID with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram's vector binds
(multiplies) its letters' vectors, each permuted (rotated) by its distance from
the end. A document's vector bundles (adds) the vectors of its n-grams, and a
language's prototype those of its documents. The language whose prototype has
the largest cosine with the document wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import python_batches, texts_of, tidied

DIM, GRAM, SEED = 512, 3, 2016
UNKNOWN = "und"
#: Documents' unit vectors are added as whole numbers of this fraction, so sums do not depend on their order.
UNIT = 1 << 16
#: Floor of the score: this share of what all but the lowest of the held-out rows reach; with fewer rows there is none.
FLOOR, LOW, FEW = 0.5, 0.02, 100
#: Characters counted together, and n-grams multiplied together.
_CHARS, _COLUMNS = 400_000, 8192
_SPACE = 0
_LETTERS: dict[int, np.ndarray] = {}
_TABLE: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Whether a code point is a letter."""
    if not _TABLE:
        _TABLE.append(np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), dtype=bool))
    return _TABLE[0]


def letter_vector(code: int, dim: int, seed: int) -> np.ndarray:
    """The letter's +1/-1 vector; a generator seeded by its code point makes it, for any script."""
    key = hash((code, dim, seed))
    if key not in _LETTERS:
        _LETTERS[key] = np.random.default_rng([seed, code]).integers(0, 2, dim).astype(np.float32) * 2 - 1
    return _LETTERS[key]


def gram_vectors(grams: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """Bound vectors of n-grams given as rows of code points."""
    letters, at = np.unique(grams, return_inverse=True)
    at = at.reshape(grams.shape)
    vectors = np.stack([letter_vector(int(c), dim, seed) for c in letters]) if len(letters) else np.zeros((0, dim), np.float32)
    out = np.ones((len(grams), dim), dtype=np.float32)
    for k in range(grams.shape[1]):
        out *= np.roll(vectors, grams.shape[1] - 1 - k, axis=1)[at[:, k]]
    return out


def letters_of(text: bytes) -> np.ndarray:
    """Code points of the lower-cased letters; runs of anything else are one space, also at both ends."""
    whole, pieces = text.decode("utf-8", "replace"), []
    for lo in range(0, len(whole), 1 << 20):
        codes = np.frombuffer(whole[lo : lo + (1 << 20)].lower().encode("utf-32-le"), dtype=np.uint32)
        pieces.append(np.where(letter_table()[codes], codes, np.uint32(_SPACE)))
    kept = np.concatenate(pieces) if pieces else np.zeros(0, dtype=np.uint32)
    if not kept.any():
        return np.zeros(0, dtype=np.uint32)
    edge = np.zeros(1, dtype=np.uint32)
    padded = np.concatenate([edge, kept, edge])
    return padded[np.concatenate([[True], (padded[1:] != _SPACE) | (padded[:-1] != _SPACE)])]


def profiles(texts: list[bytes], gram: int, dim: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit document vectors (rows; zero where a text has no letter) and which texts have letters."""
    out, known = np.zeros((len(texts), dim), dtype=np.float64), np.zeros(len(texts), dtype=bool)
    pieces: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush() -> None:
        np.add.at(out, [k for k, _ in pieces], _bundle([c for _, c in pieces], gram, dim, seed))
        pieces.clear()

    for k, text in enumerate(texts):
        codes = letters_of(text)
        known[k] = len(codes) > 0
        for lo in range(0, len(codes), _CHARS):  # a long text is counted in pieces that overlap by all but one letter of an n-gram
            pieces.append((k, codes[lo : lo + _CHARS + gram - 1]))
            held += len(pieces[-1][1])
            if held > _CHARS:
                flush()
                held = 0
    if pieces:
        flush()
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norms, out=out, where=norms > 0).astype(np.float32), known


def _bundle(codes: list[np.ndarray], gram: int, dim: int, seed: int) -> np.ndarray:
    """Sum of the n-gram vectors of each piece of text."""
    sizes = np.array([max(0, len(c) - gram + 1) for c in codes])
    total = np.zeros((len(codes), dim), dtype=np.float64)
    if not sizes.any():
        return total
    alphabet, at = np.unique(np.concatenate(codes), return_inverse=True)
    base, index = len(alphabet), np.zeros(int(sizes.sum()), dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum([len(c) for c in codes])[:-1]])
    heads = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(len(index))
    for k in range(gram):
        index = index * base + at[heads + k]
    if base**gram <= 1 << 22:
        seen = np.flatnonzero(np.bincount(index, minlength=base**gram))
        places = np.zeros(base**gram, dtype=np.int64)
        places[seen] = np.arange(len(seen))
        column = places[index]
    else:
        seen, column = np.unique(index, return_inverse=True)
    doc = np.repeat(np.arange(len(codes)), sizes)
    grams = np.stack([alphabet[seen // base ** (gram - 1 - k) % base] for k in range(gram)], axis=1)
    order = None if len(seen) <= _COLUMNS else np.argsort(column, kind="stable")
    for lo in range(0, len(seen), _COLUMNS):
        hi = min(len(seen), lo + _COLUMNS)
        if order is None:
            d, c = doc, column
        else:  # of the documents only those with n-grams in this run of columns
            part = order[np.searchsorted(column, lo, sorter=order) : np.searchsorted(column, hi, sorter=order)]
            d, c = doc[part], column[part]
        rows, d = np.unique(d, return_inverse=True)
        counts = np.bincount(d * (hi - lo) + (c - lo), minlength=len(rows) * (hi - lo)).reshape(len(rows), hi - lo)
        total[rows] += counts.astype(np.float32) @ gram_vectors(grams[lo:hi], dim, seed)
    return total


@dataclass
class Languages:
    """Learned prototypes: one vector for each language."""

    names: list[str]
    vectors: np.ndarray
    gram: int = GRAM
    seed: int = SEED

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and score (cosine, 0 to 1) of each text; ties go to the first name in order."""
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        docs, known = profiles(texts, self.gram, self.vectors.shape[1], self.seed)
        cosines = docs @ self.vectors.T
        best = cosines.argmax(axis=1)
        score = np.where(known, np.clip(cosines[np.arange(len(texts)), best].astype(float), 0.0, 1.0), 0.0)
        return [self.names[b] if k else UNKNOWN for b, k in zip(best, known)], score


def _sums(labelled: DataFrame, text_col: str, key: Column, gram: int, dim: int, seed: int) -> dict[str, np.ndarray]:
    """Sum of the unit vectors of the texts of each non-null key."""
    python_batches(labelled.sparkSession)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            docs, _ = profiles(texts_of(batch.column(0)), gram, dim, seed)
            whole = np.rint(docs * UNIT).astype(np.int64)
            for lang in set(langs):
                sums[lang] = sums.get(lang, 0) + whole[langs == lang].sum(axis=0)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v for v in sums.values()], pa.list_(pa.int64()))], ["lang", "vector"])

    parts = labelled.select(F.col(text_col), key.alias("key")).where(F.col("key").isNotNull()).mapInArrow(tidied(bundle), "lang string, vector array<long>")
    sums = (
        parts.select("lang", F.posexplode("vector").alias("k", "v")).groupBy("lang", "k").agg(F.sum("v").alias("v"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("kv")).select("lang", "kv.v").collect()
    )
    return {r.lang: np.array(r.v, dtype=np.float64) for r in sums}


def _model(sums: dict[str, np.ndarray], gram: int, dim: int, seed: int) -> Languages:
    rows = sorted((name, v) for name, v in sums.items() if any(v))
    vectors = np.array([v / np.linalg.norm(v) for _, v in rows], dtype=np.float32).reshape(len(rows), dim)
    return Languages([name for name, _ in rows], vectors, gram, seed)


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", gram: int = GRAM, dim: int = DIM, seed: int = SEED) -> Languages:
    """Prototypes from all rows of ``labelled`` with a language and a letter.

    Each task bundles the unit vectors of its documents by language; the sums are
    added up by (language, dimension), folded before the shuffle. What comes to
    the driver is the model: one vector for each language. Without labelled rows
    no language is learned and every text is ``und``.
    """
    return _model(_sums(labelled, text_col, F.col(lang_col).cast("string"), gram, dim, seed), gram, dim, seed)


def length_class(text_col: str = "text") -> Column:
    """Texts of a class are at most twice as long as each other."""
    return F.floor(F.log2(F.greatest(F.length(text_col), F.lit(1)))).cast("int")


def learn_with_floors(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", gram: int = GRAM, dim: int = DIM, seed: int = SEED
) -> tuple[Languages, dict[str, list[float]]]:
    """Prototypes from all labelled rows, and for each language the score that a text of a length class must have.

    The floors are fitted on the held-out labelled rows with prototypes of the
    others: ``FLOOR`` times the score that all but ``LOW`` of a language's rows of
    that length reach, where it was told rightly. A class with fewer than
    ``FEW`` such rows has the floor of the next shorter one, and the shortest
    none (0): short texts and small languages are not judged by their score.
    """
    held = F.coalesce(held_out(id_col), F.lit(False))
    lang = F.col(lang_col).cast("string")
    sums = _sums(labelled, text_col, F.concat(F.when(held, "1").otherwise("0"), lang), gram, dim, seed)
    parts = [{k[1:]: v for k, v in sums.items() if k[0] == part} for part in "01"]
    others, whole = parts[0], {k: parts[0].get(k, 0) + parts[1].get(k, 0) for k in parts[0].keys() | parts[1].keys()}
    tried = labelled.where(held & lang.isNotNull()).select(lang.alias("lang"), length_class(text_col).alias("length"), F.col(text_col).alias("text"))
    rows = (
        identify(tried, _model(others, gram, dim, seed)).where("lang_pred = lang").groupBy("lang", "length")
        .agg(F.count("*").alias("n"), F.percentile_approx("score", LOW, 10_000).alias("low")).where(F.col("n") >= FEW).collect()
    )
    floors: dict[str, list[float]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.length)):
        mine = floors.setdefault(r.lang, [])
        mine += [mine[-1] if mine else 0.0] * (r.length - len(mine)) + [FLOOR * r.low]
    return _model(whole, gram, dim, seed), floors


def score_floor(floors: dict[str, list[float]], text_col: str = "text") -> Column:
    """The floor for ``lang_pred`` and the length of the text; 0 where there is none."""
    if not floors:
        return F.lit(0.0)
    table = F.create_map(*[x for lang, mine in floors.items() for x in (F.lit(lang), F.array(*map(F.lit, mine)))])
    mine = table[F.col("lang_pred")]
    return F.coalesce(F.get(mine, F.least(length_class(text_col), F.size(mine) - 1)), F.lit(0.0))


def identify(docs: DataFrame, model: Languages, text_col: str = "text", kept: list[str] | None = None) -> DataFrame:
    """The columns ``kept`` of ``docs`` (all, if not given) with ``lang_pred`` and ``score``; columns of these names are replaced.

    Null texts and texts without a letter are ``und`` with score 0. The
    prediction sees nothing but the text. Repeated rows stay; no rows: no rows.
    """
    python_batches(docs.sparkSession)
    kept = [c for c in (docs.columns if kept is None else kept) if c not in ("lang_pred", "score")]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema.add("lang_pred", "string").add("score", "double")
    n = len(kept)
    at, sent = (kept.index(text_col), []) if text_col in kept else (n, [F.col(f"`{text_col}`").alias("text to judge")])  # the text goes to the workers once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = model.predict(texts_of(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(langs, pa.string()), pa.array(scores)], names=[*kept, "lang_pred", "score"])

    return docs.select(*[F.col(f"`{c}`") for c in kept], *sent).mapInArrow(tidied(run), schema)


def held_out(id_col: str = "doc_id"):
    """Rows that no model learns from: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.where(~F.coalesce(held_out(), F.lit(False))))
    return identify(docs.withColumn("held_out", F.coalesce(held_out(), F.lit(False))), model, kept=["doc_id", "held_out"])
