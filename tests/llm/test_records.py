import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from factloom.llm.records import Encoder, frame, frames, masked_sum, read_records, write_records

from .conftest import rows_of

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


ODD = ["It's 12,5% of <|endoftext|> THIS, isn't it?", "★ star ★", "naïve Straße, ÉCOLE... éa", "a b c\x1cd", "x" * 3000, "Σίσυφος ΣΑΣ.", "<|ENDOFTEXT|> end.", "foo.bar, baz!? ok",
       "it's we've I'll $'s a'$b 's't ''re x'1 'S 1'st 92.142.22.65 a$$$ b&&&c ..-- é.é. ★.a a★. =\u0338a a=\u0338 a\u0301. 3\u0301x ²x x² Ⅳ. v1.2.3-rc_4", "\n \t", "a\x00b \x7f c\x85d\u00a0e"]


def test_long_texts_are_cut_after_white_space(tokenizer, monkeypatch):
    import random

    import factloom.llm.records as records

    rng = random.Random(3)
    every = [" ".join(rng.choices([o for o in ODD if "<|" not in o], k=30)), "y" * 500, " " * 300, "Ä" * 90 + " B."]
    monkeypatch.setattr(records, "PIECE", 64)
    monkeypatch.setattr(records, "MEMO_WORDS", 20)  # words are forgotten in between
    coder = Encoder(open(PATH, encoding="utf-8").read(), by_words=True)
    got = [np.frombuffer(b, dtype="<u2").tolist() for b in coder.encode([t.encode() for t in every])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in every]


def test_random_texts_give_the_ids_of_the_whole_text(tokenizer):
    import random

    rng = random.Random(17)
    signs = list("abzAZ09 .,;'\"$&-\n\t") + ["'s", "'T", "'Re", "é", "É", "\u0301", "\u0338", "ß", "★", "¼", "日", "\u00a0", "İ", "ſ", "\u2028", "K", "x" * 40]
    every = ["".join(rng.choices(signs, k=rng.randint(1, 80))) for _ in range(3000)]
    coder = Encoder(open(PATH, encoding="utf-8").read(), by_words=True)
    got = [np.frombuffer(b, dtype="<u2").tolist() for b in coder.encode([t.encode() for t in every])]
    assert [t for t, ids in zip(every, got) if ids != tokenizer.encode(t, add_special_tokens=False).ids] == []


def test_words_in_turn_give_the_ids_of_the_whole_text(tokenizer, texts):
    coder = Encoder(open(PATH, encoding="utf-8").read(), by_words=True)
    every = [t or "" for t in texts] + ODD
    got = [np.frombuffer(b, dtype="<u2").tolist() for b in coder.encode([t.encode() for t in every])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in every]


def test_capitals_with_marks_of_their_own_give_the_ids_of_the_whole_text(tokenizer):
    bare = ["H\u0331", "T\u0308", "J\u030c", "W\u030a", "Y\u030a", "H\u05b0\u0331", "h\u0331", "E\u0301", "ÀÉ", "RÉ"]
    every = bare + [f"{b}a Word, {b}. x{b}B{b}! {b.lower()}" for b in bare] + [" ".join(bare) + " PLAIN"]
    coder = Encoder(open(PATH, encoding="utf-8").read(), by_words=True)
    got = [np.frombuffer(b, dtype="<u2").tolist() for b in coder.encode([t.encode() for t in every])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in every]


def test_frames_round_trip_and_refuse_damage():
    data = b"".join(frame(k, np.arange(n, dtype="<u2").tobytes(), 2) + b"\n" for k, n in ((5, 3), (None, 0), (-1, 10), (10, 10)))
    rows = list(frames(data))
    assert [(k, i.tolist()) for _, _, k, i in rows] == [(5, [0, 1, 2]), (None, []), (-1, list(range(10))), (10, list(range(10)))]
    assert [o for o, *_ in rows] == [0, *np.cumsum([n + 1 for _, n, *_ in rows])[:-1]]
    for at in range(len(data)):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(frames(bytes(bad)))
    assert masked_sum(b"") == 0xA282EAD8


def test_shards_hold_every_text(spark, tmp_path, tokenizer, texts):
    rows = [(n, t, None, None) for n, t in enumerate(texts + ODD)] + [(3, texts[3], None, None), (None, "no id", None, None)]
    index = write_records(rows_of(spark, rows).repartition(4), str(tmp_path / "a"), PATH, by_words=True).collect()
    index = sorted(index, key=lambda r: r.start)
    want = {r[:2]: np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4") for r in rows}
    assert [r.id for r in index] == sorted((r[0] for r in rows), key=lambda k: -1 if k is None else k)
    assert sorted((r.id or -1, r.n_tokens, r.ids_crc32) for r in index) == sorted((r[0] or -1, len(want[r[:2]]), zlib.crc32(want[r[:2]].tobytes())) for r in rows)
    assert [r.start for r in index] == [0, *np.cumsum([r.n_tokens for r in index])[:-1]]
    read = read_records(spark, str(tmp_path / "a")).collect()
    assert sorted((r.id or -1, tuple(r.ids)) for r in read) == sorted((r[0] or -1, tuple(want[r[:2]].tolist())) for r in rows)
    for r in index:  # a record is where the index says
        shard = next((tmp_path / "a" / "shards").glob(f"part-{r.shard:05d}*")).read_bytes()
        assert next(frames(shard[r.offset : r.offset + r.length + 1]))[2] == r.id


def test_no_rows(spark, tmp_path):
    assert write_records(rows_of(spark, []), str(tmp_path / "b"), PATH).count() == 0


def test_reading_shards_drops_the_encoder_and_copies_no_shard():
    import pyarrow as pa

    import factloom.llm.records as records

    data = b"".join(frame(k, np.arange(n, dtype="<u2").tobytes(), 2) + b"\n" for k, n in ((5, 3), (6, 10)))
    held = pa.array([data], pa.binary())[0].as_buffer()
    rows = list(frames(held))
    assert [(k, i.tolist()) for _, _, k, i in rows] == [(5, [0, 1, 2]), (6, list(range(10)))]
    low, high = held.address, held.address + held.size
    assert all(low <= i.ctypes.data < high for _, _, _, i in rows)
    records._ENCODERS[0, False] = None
    records.drop_encoders()
    assert not records._ENCODERS
