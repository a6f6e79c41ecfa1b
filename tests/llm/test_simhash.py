import numpy as np
import xxhash

from factloom.llm.simhash import first_of_each, fingerprint, fingerprints, near_duplicates, near_links, trie_pairs

from .conftest import rows_of


def classes(fps, errors=2):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= errors:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def by_hand(text):
    words = [w for w in text.lower().replace(b"\n", b" ").replace(b"\t", b" ").split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_by_hand(texts):
    for text in texts:
        raw = (text or "").encode()
        assert fingerprint(raw) == by_hand(raw)


def test_trie_finds_the_pairs_of_brute_force():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    keys = np.unique(np.concatenate([centres] + [centres ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(6)]))
    found = {(int(a), int(b)) for x, y in trie_pairs(keys, np.array([0, len(keys)]), 64, 2) for a, b in zip(x, y)}
    assert found == {(i, j) for j in range(len(keys)) for i in range(j) if bin(int(keys[i] ^ keys[j])).count("1") <= 2}


def test_near_links_join_the_classes_of_brute_force_also_in_chunks(spark):
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    keys = np.unique(np.concatenate([centres] + [centres ^ (np.uint64(1) << rng.integers(0, 64, 12, dtype=np.uint64)) for _ in range(9)]))
    frame = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "fp long")
    label = classes([int(k) for k in keys])
    for group_rows in (20_000, 3):
        links = [(np.int64(r.fp).view(np.uint64), np.int64(r.other).view(np.uint64)) for r in near_links(frame, group_rows=group_rows).collect()]
        got = list(range(len(keys)))
        at = {int(k): n for n, k in enumerate(keys)}
        for a, b in links:
            x, y = got[at[int(a)]], got[at[int(b)]]
            got = [min(x, y) if v in (x, y) else v for v in got]
        assert got == label


def test_classes_of_documents(spark, texts):
    rows = [(n, t, None, None) for n, t in enumerate(texts)] + [(None, texts[0], None, None), (1, texts[1], None, None)]
    docs = rows_of(spark, rows).repartition(3)
    near = near_duplicates(docs).collect()
    assert len(near) == len(rows)
    fps = [by_hand((t or "").encode()) for t in texts]
    label = classes(fps)
    for r in near:
        if r.id is not None:
            assert r.component_id == label[r.id] and r.fp & (1 << 64) - 1 == fps[r.id]
    assert {r.component_id for r in near if r.id is None} == {0}
    kept = first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({n for n, c in enumerate(label) if n == c})
    assert kept.where("doc_id is null").count() == 1


def test_no_rows(spark):
    empty = rows_of(spark, [])
    assert near_duplicates(empty).count() == 0 and first_of_each(empty).count() == 0 and fingerprints(empty).count() == 0
