"""Large CSV files read by blocks against the reader of whole texts."""

import random

from pyspark.sql import functions as F

from factloom.operators.cells import row_values_long, sheet_cells
from factloom.operators.large_csv import csv_file_rows, csv_lines, csv_records
from factloom.operators.tables import csv_tables
from factloom.plans.extract import extract
from factloom.sources.files import decode_text, read_files
from factloom.sources.warehouse import Warehouse


def random_file(rng, size):
    pieces = ['"', '"', ",", ",", "\n", "\r\n", '""', "a", "é", " ", "7", '\n"x\ny",', '"a, b"\n', "\r"]
    return "h,k,,m\n" + "".join(rng.choice(pieces) for _ in range(size))


def cells(df):
    return sorted((r.document_id, r.source_row_number, r.source_column_number, r.header_raw, r.value_raw or "", r.row_label_raw or "") for r in df.collect())


def test_blocks_of_files_read_as_whole_texts(spark, tmp_path):
    rng = random.Random(5)
    folder = tmp_path / "files"
    folder.mkdir()
    contents = {f"f{n}": random_file(rng, 30 if n < 30 else 600).encode() for n in range(40)}
    contents |= {"a b+%41": b"a\n1\n",
        "blank_head": b"\na,b\n1,2\n", "empty": b"", "no_end": b"a,b\n1,2", "open": b'a,b\n1,"open\n', "open_no_end": b'a,b\n1,"open\nx',
        "mark": '﻿"a,\nb",c\n1,2\n'.encode(), "latin": 'é,"k\nl"\n"ü",2\n'.encode("latin-1"), "returns": b'a,b\r1,"2\r3"\r4,5\r', "beyond": b"a,b\n,,x\n,\n",
        "long": b"n,t\n" + b"".join(b'%d,"line ""%d""\n of %d"\n' % (n, n, n) for n in range(6000)),
    }
    for name, data in contents.items():
        (folder / f"{name}.csv").write_bytes(data)
    whole = spark.createDataFrame([(n, bytearray(c)) for n, c in contents.items()], "document_id string, content binary")
    want = cells(row_values_long(csv_tables(whole.select(
        F.lit("d").alias("department_id"), "document_id", F.lit("").alias("title"), decode_text(F.col("content")).alias("text")
    ))))
    def staged(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        lines = csv_lines(spark, str(folder))
        assert lines.filter("uri like '%long.csv'").select("_block").distinct().count() > 20
        uri = F.regexp_extract("uri", r"([^/]+)\.csv$", 1)
        files = read_files(spark, str(folder)).select("uri", F.lit("d").alias("department_id"), uri.alias("document_id"))
        got = cells(sheet_cells(csv_file_rows(csv_records(lines, staged), files, staged)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want
    assert {c[0] for c in got} >= {"no_end", "open", "open_no_end", "mark", "latin", "returns", "beyond", "long", "a b+%41"}


def test_large_files_in_the_extraction_job(spark, tmp_path):
    store, folder = Warehouse(spark, str(tmp_path / "store")), tmp_path / "files"
    folder.mkdir()
    (folder / "big.csv").write_bytes(b"Item,2020-21\n" + b"".join(b'"Line ""%d"",\nnext",%d\n' % (n, n) for n in range(500)))
    small = b"a,b\n1,2\n3,4\n"
    known = [("big", "csv", "success"), ("small", "csv", "success"), ("other", "json", "success"), ("unknown", "csv", "success")]
    store.append("raw_documents", spark.createDataFrame([("fin", *k) for k in known], "department_id string, document_id string, file_format string, ingestion_status string"), "b0")
    contents = spark.createDataFrame([("small", bytearray(small)), ("other", bytearray(b"{}"))], "document_id string, content binary")
    named = read_files(spark, str(folder)).select("uri", F.lit("big").alias("document_id"))
    stats = extract(store, contents, "b1", large_files=(str(folder), named)).collect()
    assert [(r.tables_kept, r.headers, r.cells) for r in stats] == [(2, 4, 1004)]
    cells = store.read("row_values_long").filter("document_id = 'big' and source_row_number = 7").orderBy("source_column_number").collect()
    assert [(c.header_raw, c.value_raw, c.row_label_raw) for c in cells] == [
        ("Item", 'Line "7",\nnext', 'Line "7",\nnext'), ("2020-21", "7", 'Line "7",\nnext'),
    ]
    status = {r.document_id: r.status for r in store.read("document_status").collect()}
    assert status == {"big": "extracted", "small": "extracted", "other": "unsupported_format"}
