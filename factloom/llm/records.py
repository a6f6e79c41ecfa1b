"""Token ids as length-delimited binary records in shards, with a separate offset index.

A shard is a file of frames in ascending id order. A frame is, little-endian::

    u64 length of the payload | u32 masked checksum of those 8 bytes
    payload: i64 id | u8 1 if the id is null | u8 bytes per token (2 or 4) | tokens
    u32 masked checksum of the payload | one line feed

The checksum is CRC-32, masked by a rotation and a constant as in record files
that hold checksums of data with checksums. The line feed is the row end of the
writer: Spark's own text writer lays the frames down, so shards go to any store
it can write, and a lost task leaves no half file. The index is a table with
shard, number, offset, length, id, tokens before the record, tokens and the
CRC-32 of the tokens as 32-bit integers; a reader that shuffles takes any
record by shard and offset.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import give_back, python_batches, shared_folder, texts_of, tidied

END_ID = 1
_HEAD, _SUM, _LEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qBB")
#: Words a worker remembers the ids of; beyond, those that were not met again since the last time are forgotten.
MEMO_WORDS = 1 << 18
#: Bytes of text that words are cut from together; text of a shard, at most, where rows are dealt out anew.
PIECE, SHARD_BYTES = 1 << 20, 128 << 20
_MARKS = "★♥•€§"
_SPACES = b" \t\n\v\f\r"
_SPACE, _APOSTROPHE, _WIDE = 0, 4, 5
#: Kinds of bytes: white space, letters, digits, other ASCII, the apostrophe, parts of other characters.
_KIND = np.array([
    _SPACE if b in _SPACES else _WIDE if b > 127 else _APOSTROPHE if b == 39 else 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3 for b in range(256)
], dtype=np.uint8)
_ENCODERS: dict[tuple[int, bool], Encoder] = {}


def masked_sum(data: bytes | memoryview) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(key: int | None, ids: bytes, width: int) -> bytes:
    """One record without its line feed."""
    payload = _LEAD.pack(key or 0, key is None, width) + ids
    head = _HEAD.pack(len(payload))
    return head + _SUM.pack(masked_sum(head)) + payload + _SUM.pack(masked_sum(payload))


def frames(data: bytes | pa.Buffer) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """``offset, length, id, tokens`` of every record of a shard; a wrong checksum raises."""
    at, view = 0, memoryview(data)  # a shard is read where it lies, without a copy
    while at < len(view):
        head = bytes(view[at : at + 8])
        size = _HEAD.unpack(head)[0]
        if _SUM.unpack_from(view, at + 8)[0] != masked_sum(head):
            raise ValueError(f"bad length checksum at {at}")
        payload = view[at + 12 : at + 12 + size]
        if _SUM.unpack_from(view, at + 12 + size)[0] != masked_sum(payload) or view[at + 16 + size] != 10:
            raise ValueError(f"bad record checksum at {at}")
        key, null, width = _LEAD.unpack_from(payload)
        yield at, 16 + size, None if null else key, np.frombuffer(payload, dtype=f"<u{width}", offset=_LEAD.size)
        at += 17 + size


def pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``PIECE`` bytes, cut after white space."""
    lo = 0
    while len(text) - lo > PIECE:
        hi = lo + PIECE
        while hi < len(text) and text[hi - 1] not in _SPACES:
            hi += 1
        yield text[lo:hi]
        lo = hi
    yield text[lo:]


def words_of(parts: list[bytes]) -> tuple[pa.BinaryArray, np.ndarray]:
    """All words of the parts in turn, and how many stand before each part and after the last.

    Words end at ASCII white space, and where ASCII letters, digits and other
    signs meet each other, but for the apostrophe. A-Z become lower case, but for
    letters before a character outside ASCII: the tokenizer composes marks before
    it lower-cases.
    """
    raw = np.frombuffer(b"\n".join([*parts, b""]), dtype=np.uint8)
    capital = (raw >= 65) & (raw <= 90)
    capital[:-1] &= raw[1:] < 128
    low = raw + capital * np.uint8(32)
    kind = _KIND[low]
    space = kind == _SPACE
    meet = kind[1:] != kind[:-1]
    plain = (kind != _APOSTROPHE) & (kind != _WIDE)
    start = np.flatnonzero(np.concatenate([~space[:1], meet & plain[1:] & plain[:-1] & ~space[1:] | space[:-1] & ~space[1:]]))
    filled = np.cumsum(~space, dtype=np.int32)
    offsets = np.append(filled[start] - 1, filled[-1:]).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(low[~space])])
    return words, np.searchsorted(start, np.cumsum([0, *(len(p) + 1 for p in parts)]))


class Encoder:
    """Ids of whole texts as little-endian bytes.

    ``by_words`` suits a tokenizer that lower-cases, drops white space, never
    joins across it, and cuts where letters, digits and signs meet (contractions
    apart): ids of a text are then those of its words in turn, and each worker
    encodes a word once. Texts with the marks of special tokens, and any
    doubtful word, are encoded directly.
    """

    def __init__(self, source: str, by_words: bool) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.by_words = by_words
        self.forget(np.zeros(0, dtype=bool))
        self.mark, self.mark_id = next(
            ((m, ids[0]) for m in _MARKS if len(ids := self.direct([m])[0]) == 1), ("", 0)
        )

    def direct(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def packed(self, ids) -> bytes:
        return np.asarray(ids, dtype=f"<u{self.width}").tobytes()

    def forget(self, keep: np.ndarray) -> None:
        """Keep these of the known words: the words, where their ids begin and how many they are, the ids, and whether they were met."""
        if not len(keep):
            self.known, self.ids = pa.array([], pa.binary()), np.zeros(0, dtype=f"<u{self.width}")
            self.starts, self.sizes, self.met = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32), keep
            return
        self.known, self.ids = self.known.filter(pa.array(keep)), self.ids[np.repeat(keep, self.sizes)]
        self.sizes = self.sizes[keep]
        self.starts, self.met = np.cumsum(self.sizes, dtype=np.int32) - self.sizes, np.zeros(len(self.sizes), dtype=bool)

    def learn(self, words: pa.BinaryArray) -> None:
        texts, ids, sizes = [w.decode() for w in words.to_pylist()], [], []
        for k in range(0, len(texts), 2000):
            part = texts[k : k + 2000]
            if not any(self.mark in w for w in part):
                found = np.asarray(self.direct([f" {self.mark} ".join(part)])[0], dtype=self.ids.dtype)
                cut = np.flatnonzero(found == self.mark_id)
                if len(cut) == len(part) - 1:
                    ids.append(found[found != self.mark_id])
                    sizes.append(np.diff(cut, prepend=-1, append=len(found)) - 1)
                    continue
            each = self.direct(part)  # the mark stands in a word, or the words do not part at it
            ids.append(np.array([i for e in each for i in e], dtype=self.ids.dtype))
            sizes.append(np.array([len(e) for e in each]))
        self.known, self.ids = pa.concat_arrays([self.known, words]), np.concatenate([self.ids, *ids])
        self.sizes = np.concatenate([self.sizes, *sizes]).astype(np.int32)
        self.starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes
        self.met = np.concatenate([self.met, np.zeros(len(words), dtype=bool)])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_words or not self.mark:
            return [self.packed(ids) for ids in self.direct([t.decode() for t in texts])]
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, bytes]] = []
        size = 0

        def flush() -> None:
            for (k, _), ids in zip(held, self.by_word([p for _, p in held])):
                out[k].append(ids)
            held.clear()

        for k, text in enumerate(texts):
            if b"<|" in text:
                out[k].append(self.packed(self.direct([text.decode()])[0]))
                continue
            for piece in pieces(text):
                held.append((k, piece))
                size += len(piece)
                if size >= PIECE:
                    flush()
                    size = 0
        flush()
        return [b"".join(x) for x in out]

    def by_word(self, parts: list[bytes]) -> list[bytes]:
        """Ids of every part: those of its words in turn, looked up once for each distinct word."""
        if not parts:
            return []
        words, border = words_of(parts)
        if len(self.known) > MEMO_WORDS:
            self.forget(self.met if self.met.sum() <= MEMO_WORDS // 2 else self.met[:0])
        coded = words.dictionary_encode()
        held = len(self.known)
        place = pc.index_in(coded.dictionary, value_set=self.known).fill_null(-1).to_numpy().copy()
        new = np.flatnonzero(place < 0)
        if len(new):
            self.learn(coded.dictionary.take(pa.array(new)))
            place[new] = np.arange(held, held + len(new))
        self.met[place] = True
        at = place[coded.indices.to_numpy()]
        each = self.sizes[at]
        ends = np.cumsum(each, dtype=np.int64 if len(at) > 1 << 25 else np.int32)
        total = int(ends[-1]) if len(ends) else 0
        from_ids = np.repeat(self.starts[at] - (ends - each), each)
        from_ids += np.arange(total, dtype=from_ids.dtype)
        flat = self.ids[from_ids].tobytes()
        cuts = [int(k) * self.width for k in np.concatenate([[0], ends])[border]]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


def encoder(source: str, by_words: bool) -> Encoder:
    key = (zlib.crc32(source.encode()), by_words)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(source, by_words)
    return _ENCODERS[key]


def drop_encoders() -> None:
    """A worker that reads shards keeps no vocabulary and no words beside them; writing makes its encoder anew."""
    _ENCODERS.clear()
    gc.collect()
    give_back()


def write_records(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, by_words: bool = False, as_they_stand: bool = False, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write shards and index of all rows below ``path``; returns the index, read back.

    ``tokenizer`` is the place of a tokenizers file on the driver. Rows are dealt
    out by ranges of (id, hash of the text) and sorted, so shards follow each
    other in id order and a repeated id may fill several shards; a shard holds
    about ``shard_bytes`` of text at most, so it can be read back in one piece.
    With ``as_they_stand`` the rows are not moved: every partition of ``docs`` is
    a shard, in the order its rows have there. Null ids come first; null and empty texts are records with the end id only. Repeated rows
    are repeated records. Ids must be integers. Other columns are not read. No
    rows: shards without records and an empty index.
    """
    spark = docs.sparkSession
    source = Path(tokenizer).read_text(encoding="utf-8")
    python_batches(spark, 1000, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(source, by_words)
        end = coder.packed([end_id])
        for batch in batches:
            keys, ids = batch.column(0).to_pylist(), coder.encode(texts_of(batch.column(1)))
            records = [frame(k, i + end, coder.width) for k, i in zip(keys, ids)]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    dealt = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    if not as_they_stand:
        held = dealt.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // shard_bytes))
        dealt = dealt.repartitionByRange(shards, "id", "tie").sortWithinPartitions("id", "tie")
    framed = dealt.select("id", "text").mapInArrow(tidied(run), "record binary")
    framed.select(F.col("record").cast("string").alias("value")).write.text(f"{path}/shards", lineSep="\n")

    scanned = scan_shards(spark, f"{path}/shards")
    scanned.write.parquet(f"{path}/index")
    return read_index(spark, path)


def scan_shards(spark: SparkSession, path: str, with_tokens: bool = False) -> DataFrame:
    """Every record of the shards, checksums verified: ``shard, number, offset, length, id, before, n_tokens, ids_crc32``.

    ``before`` counts the tokens of the shard before the record.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        for batch in batches:
            for place, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard, before, rows, held = int(re.search(r"part-(\d+)", place)[1]), 0, [], 0
                for number, (offset, length, key, ids) in enumerate(frames(data.as_buffer())):
                    wide = ids.astype("<u4")
                    rows.append((shard, number, offset, length, key, before, len(ids), zlib.crc32(wide.tobytes()),
                                 *([wide.view("<i4")] if with_tokens else [])))
                    before, held = before + len(ids), held + len(ids)
                    if len(rows) == 1000 or with_tokens and held > 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names = ["shard", "number", "offset", "length", "id", "before", "n_tokens", "ids_crc32"]
    types = [pa.int32(), pa.int32(), *[pa.int64()] * 6]
    schema = "shard int, number int, offset long, length long, id long, before long, n_tokens long, ids_crc32 long"
    if with_tokens:
        names, types, schema = [*names, "ids"], [*types, pa.list_(pa.int32())], f"{schema}, ids array<int>"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.where("length > 0").select("path", "content").mapInArrow(tidied(run), schema)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index, with ``start``: the tokens of all records before."""
    index = spark.read.parquet(f"{path}/index")
    # one row for a shard; shards are files, so this stays small beside the data
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("held"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    return index.join(bases, "shard").withColumn("start", F.col("base") + F.col("before")).drop("base", "before")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``id, ids`` of every record, with its shard and number."""
    return scan_shards(spark, f"{path}/shards", with_tokens=True).select("shard", "number", "id", "ids")


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` written as token records and read back."""
    import public_tokenizers

    index = write_records(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_folder(spark, "token-records"),
        public_tokenizers.path("word_bpe_49k.json"), by_words=True,
    )
    return index.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32", "shard", "offset", "length")
