"""Legacy ARC archives to WARC, and WARC read back.

ARC holds a version block and records of one header line, whose fields depend
on the version, and as many bytes as that line declares. A converted record
gets what WARC asks for and ARC lacks: an identifier (name-based, so reruns
agree), an ISO timestamp, a type, and digests of block and payload. Archives are
laid down by Spark's text writer with the two line ends that close a WARC record
as row end, so any store that Spark writes will do.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import python_batches, shared_folder, stored, texts_of

#: Fixed by the format: the fields of a record's header line, by version.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"),
}
#: Fixed by the format: profile of a revisit whose payload is that of another record.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
_SPACE = re.compile(r"[\x00-\x20\x7f]")


@dataclass
class ArcRecord:
    version: int
    url: str
    ip: str
    date: str
    mime: str
    block: bytes

    @property
    def head_and_payload(self) -> tuple[bytes, bytes]:
        """The protocol's header, with its blank line, and what follows; all is payload where there is none."""
        if self.block.startswith(b"HTTP/") and (cut := self.block.find(b"\r\n\r\n")) >= 0:
            return self.block[: cut + 4], self.block[cut + 4 :]
        return b"", self.block


def arc_image(records: list[tuple[str, str, str, str, bytes]], version: int, name: str = "pages.arc") -> bytes:
    """An ARC file of (url, ip, 14-digit date, content type, block) records."""
    fields = ARC_FIELDS[version]
    inside = f"{version} 0 factloom\n{' '.join(fields)}\n\n".encode()
    about = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": "20000101000000", "Content-type": "text/plain",
             "Result-code": "200", "Filename": name}
    out = [" ".join(about.get(f, str(len(inside)) if f == "Archive-length" else "-") for f in fields).encode(), b"\n", inside]
    for url, ip, date, mime, block in records:
        values = {"URL": _SPACE.sub(lambda m: f"%{ord(m[0]):02X}", url), "IP-address": ip, "Archive-date": date, "Content-type": mime,
                  "Result-code": "200", "Archive-length": str(len(block)), "Filename": name}
        out += [" ".join(values.get(f, "-") for f in fields).encode(), b"\n", block, b"\n"]
    return b"".join(out)


def arc_records(data: bytes | io.BufferedIOBase) -> Iterator[ArcRecord]:
    """Records of an ARC file (its bytes or an open file) of version 1 or 2, without the version block.

    A header line without the fields of its version, a length that is no number
    or one that runs past the end raises ``ValueError``.
    """
    source = io.BytesIO(data) if isinstance(data, bytes) else data

    def take(fields: tuple[str, ...], line: bytes) -> tuple[dict[str, str], bytes]:
        parts = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        if len(parts) != len(fields) or not parts[-1].isdigit():
            raise ValueError(f"no ARC header line: {line[:80]!r}")
        block = source.read(int(parts[-1]))
        if len(block) != int(parts[-1]):
            raise ValueError("ARC record is cut short")
        return dict(zip(fields, parts)), block

    first = source.readline()
    if not first:
        return
    fields = next((f for f in ARC_FIELDS.values() if len(first.split(b" ")) == len(f)), ())
    if not first.startswith(b"filedesc://") or not fields:
        raise ValueError("no ARC version block")
    _, block = take(fields, first)
    version = int(block.split(b" ", 1)[0])
    fields = tuple(block.split(b"\n")[1].decode().split(" "))  # the file's own definition of its lines
    if fields != ARC_FIELDS.get(version):
        raise ValueError(f"unknown ARC version {version}")
    while line := source.readline():
        if line.strip():
            row, block = take(fields, line)
            yield ArcRecord(version, row["URL"], row["IP-address"], row["Archive-date"], row["Content-type"], block)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def timestamp(date: str) -> str:
    """14 digits (or fewer, filled up) as an ISO timestamp."""
    full = date + "00000101000000"[len(date):]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def record_id(url: str, date: str, key: object, payload_digest: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {key} {payload_digest}').urn}>"


def warc_record(record: ArcRecord, key: int | str | None, lead: int | None, original: tuple[str, str, str] | None = None) -> bytes:
    """The WARC record of an ARC record, without its last two line ends.

    A record with ``lead`` becomes a revisit of the page with that key, one with
    ``original`` (record id, address and 14-digit date) a revisit of that record:
    the protocol's header stays, the payload goes, its digest stays. A key that
    is text only makes the identifier.
    """
    head, payload = record.head_and_payload
    first = lead is None and original is None
    block, of_payload = record.block if first else head, digest(payload)
    http = record.block.startswith(b"HTTP/")
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if first and http else 'resource' if first else 'revisit'}",
        f"WARC-Record-ID: {record_id(record.url, record.date, key, of_payload)}", f"WARC-Date: {timestamp(record.date)}",
        f"WARC-Target-URI: {record.url}", f"WARC-IP-Address: {record.ip}", f"WARC-Payload-Digest: sha1:{of_payload}",
        f"WARC-Block-Digest: sha1:{digest(block)}", f"WARC-Identified-Payload-Type: {record.mime}",
        f"Content-Type: {'application/http; msgtype=response' if http else record.mime}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if isinstance(key, int):
        lines.append(f"X-Page-Id: {key}")
    if not first:
        lines.append(f"WARC-Profile: {SAME_PAYLOAD}")
    if lead is not None:
        lines.append(f"X-Refers-To-Page-Id: {lead}")
    if original is not None:
        lines += [f"WARC-Refers-To: {original[0]}", f"WARC-Refers-To-Target-URI: {original[1]}", f"WARC-Refers-To-Date: {timestamp(original[2])}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def warc_records(source: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields (lower case) and block of every record; bad framing or a wrong block digest raises."""
    while line := source.readline():
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no WARC record: {line[:80]!r}")
        fields: dict[str, str] = {}
        while (line := source.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(": ")
            fields[name.lower()] = value
        size = int(fields["content-length"])
        block = source.read(size)
        if len(block) != size or source.read(4) != END.encode():
            raise ValueError("WARC record is cut short")
        if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{digest(block)}":
            raise ValueError("wrong block digest")
        yield fields, block


def pages_to_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_bytes: int = 0, date: str = "20000101000000", compression: str = "gzip",
) -> None:
    """Write every page as an ARC record, convert it, and lay the WARC archives down at ``path``.

    Of records with the same payload of at least ``min_bytes``, those with the
    largest id are responses and the others revisit that id; a null id counts
    as smaller than any, and where no id is known all are responses. Null html
    is an empty payload, a null url ``about:blank``. Repeated rows with the
    largest id are all responses. Other columns are not read. The payload is
    shuffled only if the table of repeated payloads is too large for Spark to
    broadcast by its own threshold.
    """
    python_batches(pages.sparkSession)
    payload = F.coalesce(F.col(html_col), F.lit(""))
    narrow = pages.select(F.col(id_col).cast("long").alias("id"), F.sha1(payload.cast("binary")).alias("sha"), F.octet_length(payload).alias("size"))
    leads = stored(
        narrow.where(F.col("size") >= min_bytes).groupBy("sha").agg(F.max("id").alias("lead"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and lead is not null").select("sha", "lead"), "warc-leads",
    )
    rows = (
        pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("html"), F.sha1(payload.cast("binary")).alias("sha"))
        .join(leads, "sha", "left")
        .select("id", "url", "html", F.when(~F.col("lead").eqNullSafe(F.col("id")), F.col("lead")).alias("lead"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _records([_about(date)])
        for batch in batches:
            ids, urls, leads = (batch.column(k).to_pylist() for k in (0, 1, 3))
            images: dict[int, list] = {1: [], 2: []}
            for key, url, html, lead in zip(ids, urls, texts_of(batch.column(2)), leads):
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
                version = 2 if (url or "").startswith("https:") else 1
                images[version].append(((url or "about:blank", "0.0.0.0", date, "text/html", head + html), key, lead))
            out = []
            for version, made in images.items():
                old = arc_records(arc_image([m[0] for m in made], version))
                out += [warc_record(r, key, lead) for r, (_, key, lead) in zip(old, made, strict=True)]
            yield _records(out)

    _lay_down(rows.mapInArrow(run, "record binary"), path, compression)


ARC_ROW = pa.schema([
    ("file", pa.string()), ("place", pa.int64()), ("version", pa.int32()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()),
    ("mime", pa.string()), ("block", pa.binary()), ("payload_digest", pa.string()), ("size", pa.int64()), ("record_id", pa.string()), ("error", pa.string()),
])


def read_arc(spark: SparkSession, source: str, name_filter: str = "*.arc*") -> DataFrame:
    """Records of the ``.arc`` and ``.arc.gz`` files at ``source``, a task for some files each.

    ``file, place`` (from 0), ``version, url, ip, date, mime, block,
    payload_digest, size`` (of the payload), ``record_id`` and ``error``. Every
    file ends with a row without a block; where it is damaged that row has the
    reason, and the records before the damage are there. Spark passes over files
    of no bytes. A file is read as one value, so it holds less than 2 GB.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw, rows, held, place, error = data.as_buffer(), [], 0, 0, None
                packed = raw.slice(0, 2).to_pybytes() == b"\x1f\x8b"
                name = path.rsplit("/", 1)[-1]
                try:
                    for r in arc_records(gzip.GzipFile(fileobj=pa.BufferReader(raw)) if packed else io.BufferedReader(pa.BufferReader(raw))):
                        payload = r.head_and_payload[1]
                        of_payload = digest(payload)
                        identifier = record_id(r.url, r.date, f"{name}#{place}", of_payload)
                        rows.append((path, place, r.version, r.url, r.ip, r.date, r.mime, r.block, of_payload, len(payload), identifier, None))
                        place, held = place + 1, held + len(r.block)
                        if held > 8 << 20 or len(rows) == 1000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARC_ROW)], schema=ARC_ROW)
                            rows, held = [], 0
                except (ValueError, EOFError, OSError, zlib.error) as damage:
                    error = str(damage) or type(damage).__name__
                rows.append((path, place, *[None] * 9, error))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARC_ROW)], schema=ARC_ROW)

    schema = ("file string, place long, version int, url string, ip string, date string, mime string, block binary, payload_digest string, size long, "
              "record_id string, error string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", name_filter).option("recursiveFileLookup", "true").load(source)
    return files.select("path", "content").mapInArrow(run, schema)


def arc_to_warc(spark: SparkSession, source: str, path: str, min_bytes: int = 0, compression: str = "gzip") -> DataFrame:
    """Convert the ARC files at ``source`` to WARC archives at ``path``; returns ``file, records, error``.

    Of records with equal payloads of at least ``min_bytes`` the earliest by
    date, then file and place, stays whole and the others revisit it by its
    identifier. A damaged file gives the records before the damage and its
    reason. Files are parsed once: the records are written to the shared folder,
    where a lost executor's tasks find them again. The same files give the same
    identifiers.
    """
    python_batches(spark, rows=100)
    records = stored(read_arc(spark, source), "arc-records")
    whole = records.where("block is not null")
    leads = stored(
        whole.where(F.col("size") >= min_bytes).groupBy("payload_digest")
        .agg(F.min(F.struct("date", "file", "place", "record_id", "url")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("payload_digest", F.struct("first.record_id", "first.url", "first.date").alias("first")), "arc-leads",
    )
    rows = whole.join(leads, "payload_digest", "left").select(
        "file", "place", "version", "url", "ip", "date", "mime", "block", F.when(F.col("first.record_id") != F.col("record_id"), F.col("first")).alias("first"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _records([_about("20000101000000")])
        for batch in batches:
            out = []
            for file, place, version, url, ip, date, mime, block, first in zip(*(c.to_pylist() for c in batch.columns)):
                key = f"{file.rsplit('/', 1)[-1]}#{place}"
                original = first and (first["record_id"], first["url"], first["date"])
                out.append(warc_record(ArcRecord(version, url, ip, date, mime, block), key, None, original))
            yield _records(out)

    _lay_down(rows.mapInArrow(run, "record binary"), path, compression)
    return records.groupBy("file").agg(F.count("block").alias("records"), F.max("error").alias("error"))


def _about(date: str) -> bytes:
    """The record that says what made an archive."""
    about = b"software: factloom\r\nformat: WARC File Format 1.1\r\n"
    return (
        f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Date: {timestamp(date)}\r\nWARC-Record-ID: {record_id('warcinfo', date, 0, '')}\r\n"
        f"Content-Type: application/warc-fields\r\nContent-Length: {len(about)}\r\n\r\n".encode() + about
    )


def _records(made: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["record"])


def _lay_down(records: DataFrame, path: str, compression: str) -> None:
    records.select(F.col("record").cast("string").alias("value")).write.option("compression", compression).text(path, lineSep=END)


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """``page_id, url, date, payload_bytes, payload_digest, record_type, refers_to, record_id, refers_to_record`` of every record.

    Archives may be compressed; they are read through, record by record. With
    ``with_payload`` the payload of responses is returned, too.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def as_batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for data in batch.column(1):
                raw, rows, held = data.as_buffer(), [], 0
                source = io.BufferedReader(pa.BufferReader(raw)) if raw.slice(0, 2).to_pybytes() != b"\x1f\x8b" else gzip.GzipFile(fileobj=pa.BufferReader(raw))
                for fields, block in warc_records(source):
                    if fields["warc-type"] == "warcinfo":
                        continue
                    payload = ArcRecord(0, "", "", "", "", block).head_and_payload[1]
                    of_payload = fields["warc-payload-digest"].removeprefix("sha1:")
                    if fields["warc-type"] != "revisit" and (digest(payload) != of_payload or len(payload) != int(fields["x-payload-length"])):
                        raise ValueError("wrong payload digest")
                    key, lead = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                    rows.append((
                        key and int(key), fields["warc-target-uri"], fields["warc-date"], int(fields["x-payload-length"]), of_payload,
                        fields["warc-type"], lead and int(lead), fields["warc-record-id"], fields.get("warc-refers-to"),
                        *([payload if fields["warc-type"] != "revisit" else None] if with_payload else []),
                    ))
                    held += len(block)
                    if len(rows) == 1000 or held > 8 << 20:
                        yield as_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield as_batch(rows)

    schema = "page_id long, url string, date string, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, refers_to_record string"
    names = [f.split(" ")[0] for f in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    if with_payload:
        schema, names, types = f"{schema}, payload binary", [*names, "payload"], [*types, pa.binary()]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.where("length > 0").select("path", "content").mapInArrow(run, schema)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` through ARC to WARC archives, and what the archives hold."""
    path = shared_folder(spark, "warc")
    pages_to_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
with p as (select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as x from pages),
bits as (select page_id, n, x, array_to_string(list_transform(string_split(x, ''),
  lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (strpos('0123456789abcdef', c) - 1) + 1, 4)), '') as b from p),
coded as (select page_id, n, x, array_to_string(list_transform(range(32),
  lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(b, 5 * k + 1, 1)::int + 8 * substr(b, 5 * k + 2, 1)::int
    + 4 * substr(b, 5 * k + 3, 1)::int + 2 * substr(b, 5 * k + 4, 1)::int + substr(b, 5 * k + 5, 1)::int, 1)), '') as d from bits),
led as (select *, max(page_id) over (partition by x) as lead from coded)
select page_id, n::bigint as payload_bytes, d as payload_digest,
  case when page_id is not distinct from lead or lead is null then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from lead then lead end as refers_to
from led
"""
