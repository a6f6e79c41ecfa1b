import zlib
from collections import Counter

import numpy as np

from factloom.llm.language import Languages, gram_vectors, held_out, identify, learn, letter_vector, letters_of, profiles

from .conftest import rows_of

SPEECH = {
    "en": "the quick brown fox jumps over the lazy dog while other animals watch from the river and think about their dinner",
    "de": "der schnelle braune fuchs springt über den faulen hund während andere tiere vom fluss aus zuschauen und nachdenken",
    "el": "η γρήγορη καφέ αλεπού πηδά πάνω από το τεμπέλικο σκυλί ενώ άλλα ζώα κοιτούν από το ποτάμι",
}


def test_profile_is_the_bundle_of_bound_permuted_letters():
    text = "Ab, b-a!  ÄB"
    codes = [0, *[ord(c) for c in "ab"], 0, ord("b"), 0, ord("a"), 0, ord("ä"), ord("b"), 0]
    assert letters_of(text.encode()).tolist() == codes
    dim, want = 64, np.zeros(64)
    for k in range(len(codes) - 2):
        bound = np.ones(64)
        for j in range(3):
            bound = bound * np.roll(letter_vector(codes[k + j], dim, 1), 2 - j)
        want += bound
    got, known = profiles([text.encode(), b"", b"12 3", "é".encode()], 3, dim, 1)
    assert np.allclose(got[0], want / np.linalg.norm(want), atol=1e-6)
    assert known.tolist() == [True, False, False, True] and not got[1].any() and not got[2].any()
    assert set(np.unique(gram_vectors(np.array([[97, 98, 99]]), dim, 1))) <= {-1.0, 1.0}


def test_long_and_many_lettered_texts_count_whole(monkeypatch):
    from factloom.llm import language

    rng = np.random.default_rng(1)
    long = "".join(chr(c) for c in rng.integers(0x4E00, 0x6E00, 3000)) + " " + SPEECH["en"] * 20
    whole, _ = profiles([long.encode(), SPEECH["de"].encode()], 3, 64, 1)
    monkeypatch.setattr(language, "_CHARS", 100)
    monkeypatch.setattr(language, "_COLUMNS", 50)
    assert np.allclose(profiles([long.encode(), SPEECH["de"].encode()], 3, 64, 1)[0], whole, atol=1e-5)


def test_languages_are_learned_and_told_apart(spark):
    rows = [(n, " ".join(s.split()[n % 7 :] + s.split()[: n % 7]), lang, None) for k, (lang, s) in enumerate(SPEECH.items()) for n in range(40 * k, 40 * k + 40)]
    rows += [(200, None, "en", None), (201, "  12 - ", "de", None), (202, "the dog", None, None), (None, SPEECH["el"], None, None), (202, "the dog", None, None)]
    docs = rows_of(spark, rows).repartition(3)
    model = learn(docs.where(~held_out()))
    assert model.names == ["de", "el", "en"] and np.allclose(np.linalg.norm(model.vectors, axis=1), 1, atol=1e-5)
    assert np.array_equal(model.vectors, learn(docs.where(~held_out()).repartition(5)).vectors)
    got = identify(docs, model)
    assert got.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]  # a column of that name is replaced
    got = got.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.lang_pred == r.lang for r in got if r.lang and r.doc_id < 200)
    assert {(r.lang_pred, r.score) for r in got if r.doc_id in (200, 201)} == {("und", 0.0)}
    assert [r.lang_pred for r in got if r.doc_id is None] == ["el"] and Counter(r.lang_pred for r in got if r.doc_id == 202) == {"en": 2}
    flags = {r.doc_id: r.held for r in docs.where("doc_id is not null").select("doc_id", held_out().alias("held")).collect()}
    assert all(flags[k] == (zlib.crc32(str(k).encode()) % 4 == 2) for k in flags)


def test_nothing_to_learn(spark):
    empty = rows_of(spark, [])
    model = learn(empty)
    assert model.names == [] and identify(empty, model).count() == 0
    assert [r.lang_pred for r in identify(rows_of(spark, [(1, "some text", None, None)]), model).collect()] == ["und"]
    tied = Languages(["a", "b"], np.ones((2, 8), dtype=np.float32) / np.sqrt(8))
    assert tied.predict([b"any"])[0] == ["a"]
