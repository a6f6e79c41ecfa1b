import hashlib
import base64
import gzip
import io

import pytest

from factloom.llm.warc import arc_image, arc_to_warc, arc_records, pages_to_warc, read_warc, timestamp, warc_record, warc_records


def test_arc_of_either_version_is_read_by_declared_lengths():
    blocks = [b"HTTP/1.1 200 OK\r\n\r\nfirst\nhttp://b 0.0.0.0 1 x 3\nabc", b"", b"\n\nplain"]
    for version in (1, 2):
        image = arc_image([(f"http://a/{n} b", "1.2.3.4", "19990131235959", "text/html", b) for n, b in enumerate(blocks)], version)
        rows = list(arc_records(image))
        assert [r.block for r in rows] == blocks and {r.version for r in rows} == {version}
        assert rows[0].url == "http://a/0%20b" and rows[0].head_and_payload[1].startswith(b"first")
        for bad in (image[:-3], image.replace(b"filedesc", b"filedisk"), image.replace(b"1.2.3.4 ", b"")):
            with pytest.raises(ValueError):
                list(arc_records(bad))
    assert list(arc_records(b"")) == []
    assert timestamp("19990131235959") == "1999-01-31T23:59:59Z" and timestamp("1999") == "1999-01-01T00:00:00Z"


def test_converted_records_are_framed_and_digested():
    record = next(arc_records(arc_image([("http://a/", "1.2.3.4", "19990131235959", "text/html", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n\r\n\r\nWARC/1.1")], 1)))
    for lead in (None, 7):
        data = warc_record(record, 5, lead) + b"\r\n\r\n"
        (fields, block), = warc_records(io.BytesIO(data * 1))
        assert fields["warc-date"] == "1999-01-31T23:59:59Z" and fields["warc-type"] == ("response" if lead is None else "revisit")
        assert block.endswith(b"WARC/1.1" if lead is None else b"A: b\r\n\r\n")
        assert fields["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b"\r\n\r\nWARC/1.1").digest()).decode()
        assert warc_record(record, 5, lead) == warc_record(record, 5, lead)
        with pytest.raises(ValueError):
            list(warc_records(io.BytesIO(data[:-1])))
        with pytest.raises(ValueError):
            list(warc_records(io.BytesIO(data.replace(b"A: b", b"A: c"))))


PAGES = [(1, "http://a.org/x", "<p>same</p>"), (2, "https://b.org", "<p>same</p>"), (3, None, "<p>same</p>"), (4, "http://a b\n", ""), (5, "", None),
         (6, "http://c", "é\r\n\r\nWARC/1.1\r\n" * 30), (None, "http://d", "<p>same</p>"), (7, "http://e", "x" * 300_000), (2, "https://b.org", "<p>same</p>"),
         (8, "http://f", "\x00bin\n"), (None, "http://g", "alone"), (None, "http://h", "two"), (None, "http://h", "two")]


@pytest.mark.parametrize("least,compression", [(0, "gzip"), (20, "none")])
def test_archives_hold_every_page(spark, tmp_path, least, compression):
    pages = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, id string, sha string").repartition(3)
    pages_to_warc(pages, str(tmp_path / "w"), min_bytes=least, compression=compression)
    got = read_warc(spark, str(tmp_path / "w"), with_payload=True).collect()
    want = []
    for key, _, html in PAGES:
        raw = (html or "").encode()
        keys = [k for k, _, h in PAGES if (h or "") == (html or "") and k is not None]
        lead = max(keys) if keys and len(raw) >= least and key != max(keys) else None
        want.append((key or 0, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if lead is None else "revisit", lead or 0, None if lead else raw))
    assert sorted(map(repr, want)) == sorted(repr((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0, None if r.payload is None else bytes(r.payload))) for r in got)
    assert {r.date for r in got} == {"2000-01-01T00:00:00Z"} and len({r.record_id for r in got}) >= 11


def test_no_pages(spark, tmp_path):
    pages_to_warc(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "e"))
    assert read_warc(spark, str(tmp_path / "e")).count() == 0


def test_arc_files_of_any_kind_become_archives(spark, tmp_path):
    head = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n"
    first = [("http://a/1", "1.2.3.4", "20010101000000", "text/html", head + b"same"), ("http://a/2", "1.2.3.4", "20000101000000", "text/html", head + b"own\xff\x00")]
    second = [("dns:a", "1.2.3.4", "2002", "text/dns", b"plain"), ("http://a/3", "1.2.3.4", "19990101000000", "text/html", b"HTTP/1.0 200 OK\r\n\r\nsame"),
              ("http://a/4", "1.2.3.4", "20030101000000", "text/html", head), ("http://a/5", "1.2.3.4", "20030101000000", "text/html", head)]
    source = tmp_path / "arcs"
    (source / "deep").mkdir(parents=True)
    (source / "one.arc").write_bytes(arc_image(first, 1))
    image = arc_image(second, 2)
    (source / "deep" / "two.arc.gz").write_bytes(gzip.compress(image[:100]) + gzip.compress(image[100:]))  # a member for some records each
    (source / "cut.arc").write_bytes(arc_image(first, 1)[:-3])
    (source / "cut.arc.gz").write_bytes(gzip.compress(arc_image(first * 50, 1))[:-40])
    (source / "empty.arc").write_bytes(b"")
    (source / "other.arc").write_bytes(b"no archive\n")
    (source / "notes.txt").write_bytes(b"not read")
    said = {r.file.rsplit("/", 1)[-1]: (r.records, r.error) for r in arc_to_warc(spark, str(source), str(tmp_path / "w")).collect()}
    assert said["one.arc"] == (2, None) and said["two.arc.gz"] == (4, None) and not {"empty.arc", "notes.txt"} & set(said)
    assert said["cut.arc"] == (1, "ARC record is cut short") and said["other.arc"][0] == 0 and said["other.arc"][1] and said["cut.arc.gz"][1]
    got = read_warc(spark, str(tmp_path / "w"), with_payload=True).collect()
    assert len(got) == sum(n for n, _ in said.values()) and len({r.record_id for r in got}) == len(got) and {r.page_id for r in got} == {None}
    whole = {r.payload_digest: r for r in got if r.record_type != "revisit"}
    assert {bytes(r.payload) for r in whole.values()} == {b"same", b"own\xff\x00", b"plain", b""}
    same = next(r for r in whole.values() if bytes(r.payload) == b"same")
    assert (same.url, same.date) == ("http://a/3", "1999-01-01T00:00:00Z") and next(r for r in got if r.url == "dns:a").record_type == "resource"
    assert all(r.refers_to_record == whole[r.payload_digest].record_id for r in got if r.record_type == "revisit")
    arc_to_warc(spark, str(source), str(tmp_path / "again"))
    assert sorted(map(tuple, read_warc(spark, str(tmp_path / "again")).collect())) == sorted(map(tuple, read_warc(spark, str(tmp_path / "w")).collect()))


def test_no_arc_files(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert arc_to_warc(spark, str(tmp_path / "none"), str(tmp_path / "w")).count() == 0
    assert read_warc(spark, str(tmp_path / "w")).count() == 0
