import corpus_pipeline
from factloom.llm.queries import ORACLE, QUERIES
from factloom.llm.records import read_records

from .conftest import WORDS, rows_of


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


def test_stages_take_effect_one_after_another(spark, tmp_path, texts, monkeypatch):
    import random

    rng = random.Random(12)
    item = " ".join(rng.choices(WORDS, k=20))
    rows = [(n, t, "xx" if n % 2 else "yy", "s" + str(n % 3)) for n, t in enumerate(texts)] + [(100, f"start {item} end", "xx", None), (101, "clean " * 3 + "words only", None, "s1")]
    docs = rows_of(spark, rows).select("doc_id", "text", "lang", "source")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    held, at = {}, spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        held[name] = at.collect()
        if name != "token_records":
            assert at.columns == docs.columns
            at = spark.createDataFrame(held[name], at.schema)
    ids = {name: [r.doc_id for r in rows] for name, rows in held.items()}
    blank = {n for n, t, *_ in rows if not any(c.isalpha() for c in t or "")}
    assert sorted(ids["language_id"]) == sorted(n for n, *_ in rows if n not in blank)
    assert set(ids["language_id"]) - set(ids["simhash_near_dedup"]) == {1, 3} | set(ids["language_id"]) - set(ids["simhash_near_dedup"])
    assert {0, 100, 101} <= set(ids["simhash_near_dedup"]) and not {1, 3} & set(ids["simhash_near_dedup"])
    assert sorted(set(ids["simhash_near_dedup"]) - set(ids["benchmark_decontamination"])) == [100]
    assert set(ids["source_mixing"]) <= set(ids["benchmark_decontamination"]) and 2 >= max(ids["source_mixing"].count(k) for k in ids["source_mixing"]) > 1
    assert sorted(ids["token_records"]) == sorted(ids["source_mixing"])


def test_no_documents(spark, tmp_path):
    rows_of(spark, []).select("doc_id", "text", "lang", "source").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert callable(read_records)


SPEECH = {"en": "the quick brown fox jumps over lazy dog while other animals watch from river and think about their dinner".split(),
          "de": "der schnelle braune fuchs springt über den faulen hund während andere tiere vom fluss aus zuschauen und nachdenken".split()}


def test_the_language_told_decides(spark, tmp_path):
    import random

    rng = random.Random(3)
    say = lambda lang, n: " ".join(rng.choices(SPEECH[lang], k=n))
    clean = [(n, say(lang, 60), lang, "s") for n, lang in enumerate(["en", "de"] * 500)]
    clean += [(2000, say("de", 80), None, "s"), (2001, say("de", 80), "en", "s"), (2002, "dog", "en", "s")]
    greek = " ".join(rng.choices("η γρήγορη καφέ αλεπού πηδά πάνω από το τεμπέλικο σκυλί ενώ άλλα ζώα".split(), k=80))
    junk = [(3000, greek, None, "s"), (3001, "x " + "#$% 12 -- ;; " * 40, "en", "s"), (3002, "12 --", "en", "s")]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string").repartition(3)
    kept = {r.doc_id: r.lang for r in corpus_pipeline.known_language(spark, docs, str(tmp_path)).collect()}
    assert set(kept) == {n for n, *_ in clean}
    assert kept[2000] == kept[2001] == "de" and all(kept[n] == lang for n, _, lang, _ in clean[:1000])


def test_without_labels_documents_with_letters_stay(spark, tmp_path):
    rows = [(1, "some text", None, "s"), (2, "12 --", None, "s"), (3, None, None, "s"), (4, "日本", None, "s"), (5, "", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert sorted(r.doc_id for r in corpus_pipeline.known_language(spark, docs, str(tmp_path)).collect()) == [1, 4]


def test_records_keep_the_mixed_order(spark, tmp_path):
    import random

    rng = random.Random(21)
    rows = [(n, " ".join(rng.choices(WORDS, k=rng.randint(5, 60))), "xx", f"s{n % 3}") for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    corpus_pipeline.mixed_sources(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / "mixed"))
    mixed = spark.read.parquet(str(tmp_path / "mixed"))
    index = corpus_pipeline.token_records(spark, mixed, str(tmp_path)).collect()
    said = [r.doc_id for r in sorted(index, key=lambda r: r.start)]
    assert said == [r.doc_id for r in mixed.collect()] and said != sorted(said)
    twice = [k for k in set(said) if said.count(k) == 2]
    assert twice and sum(said[said.index(k) + 1] == k for k in twice) < len(twice) / 4  # copies lie apart
