"""Table extraction and cells on small documents."""

import random

import pytest
from pyspark.sql import Window, functions as F

from factloom.functions.nesting import element_shape
from factloom.operators.cells import extracted_cells, guarded_tables, header_records, row_values_long, sheet_row_values
from factloom.operators.ordinals import with_ordinal
from factloom.operators.tables import csv_tables, html_tables
from factloom.operators.xml import xml_tables

SCHEMA = "department_id string, document_id string, title string, text string"


def tables(spark, reader, *texts):
    df = spark.createDataFrame([("d", str(n), "T", t) for n, t in enumerate(texts)], SCHEMA)
    return {r.document_id + (f"/{r.table_index}" if r.table_index else ""): (r.headers, r.rows) for r in reader(df).collect()}


def test_csv(spark):
    got = tables(
        spark, csv_tables, "a,b\n1,2\n", 'a,"b, c"\n"x ""y""",2', "a,b\n1\n1,2,3\n", "a,,b,\n1,2,3,4\n", "a,b\n,\n \n1,2",
        "a,b\n", "", "\n\n", "a,b\r\n1,2\r\n", 'h\n"two\nlines"\n', 'a,b\n5" x,6" y\n', 'a,b\n1,"open', "﻿a\n1\n",
        "a,b\n,,x\n",
    )
    assert got == {
        "0": (["a", "b"], [["1", "2"]]), "1": (["a", "b, c"], [['x "y"', "2"]]), "2": (["a", "b"], [["1", None], ["1", "2"]]),
        "3": (["a", "b"], [["1", "3"]]), "4": (["a", "b"], [["1", "2"]]), "8": (["a", "b"], [["1", "2"]]),
        "9": (["h"], [["two\nlines"]]), "10": (["a", "b"], [['5" x', '6" y']]), "11": (["a", "b"], [["1", "open"]]),
        "12": (["﻿a"], [["1"]]), "13": (["a", "b"], [["", ""]]),
    }


def test_csv_takes_very_long_quoted_fields(spark):
    field = 'x""y,' * 200_000
    (headers, rows), = tables(spark, csv_tables, f'a,b\n"{field}",2\n').values()
    assert rows == [[field.replace('""', '"'), "2"]]


def test_html(spark):
    got = tables(
        spark, html_tables,
        "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td></tr><tr><td></td></tr></table><table><tr><td>x</td></tr></table>"
        "<TABLE id=1><tr><td>H</td><td> </td></tr><tr><td>a &amp; <b>b</b>&nbsp;</td><td>drop</td></tr></TABLE>",
        "<p>none</p>", "<table><tr><td>caf&eacute;&#xe9;</td></tr><tr><td>&unknown; &amp;eacute; &#x1F600;</td></tr></table>",
    )
    assert got == {"0": (["A", "B"], [["1", None]]), "0/2": (["H"], [["a &b"]]), "2": (["caféé"], [["&unknown; &eacute; \U0001F600"]])}


def test_xml(spark):
    got = tables(
        spark, xml_tables,
        '<D xmlns:m="u"><m:DataSet><m:Series B="1" A="2"><m:Obs T="2020" V="5"/><m:Obs T="2021" B="own"/></m:Series></m:DataSet></D>',
        '<S><Codelist id="C"><Code value="1"><Name>One</Name></Code></Codelist><Codelist id="E"/></S>',
        "<r><i><n>1</n></i><i k='v'/><other/></r>", "<r><i/></r>", "<Workbook><Row/><Row/></Workbook>", "<a><b></a>x", "plain",
        '<r><i k="a>b" l=\'<![CDATA[\'/><i><n><![CDATA[<x> & &lt;]]></n></i><!-- <i/> --></r>'.replace("<![CDATA['", "&#38;'"),
        "<r><i><n>1</n></i><i><n>2</i></n></r>", "<r><i>a & b</i><i>c</i></r>",
    )
    assert got == {
        "0": (["A", "B", "T", "V"], [["2", "1", "2020", "5"], ["2", "own", "2021", None]]),
        "1": (["Name", "value"], [["One", "1"]]), "2": (["k", "n"], [[None, "1"], ["v", None]]),
        "7": (["k", "l", "n"], [["a>b", "&", None], [None, None, "<x> & &lt;"]]),
    }


def test_nested_html_tables_are_tables_of_their_own_and_part_of_the_outer_one(spark):
    inner = "<table><tr><th>x</th><th>y</th></tr><tr><td>1</td><td>2</td></tr></table>"
    got = tables(
        spark, html_tables,
        f"<table><tr><th>A</th><th>B</th></tr><tr><td>out</td><td>{inner}</td></tr><tr><td>p<td>q</table><TABLE><tr><td>h<tr><td>v</TABLE>",
        f"</table><table><tr><td>A<tr><td><table><tr><td>I<tr><td>{inner}</table>after",
        "<table><tr><th>open</th></tr><tr><td>end",
    )
    inside = (["x", "y"], [["1", "2"]])
    assert got == {
        "0": (["A", "B"], [["out", "xy12"], ["x", "y"], ["1", "2"], ["p", "q"]]), "0/1": inside, "0/2": (["h"], [["v"]]),
        "1": (["A"], [["Ixy12after"], ["I"], ["xy12"], ["x"], ["1"]]), "1/1": (["I"], [["xy12"], ["x"], ["1"]]), "1/2": inside,
        "2": (["open"], [["end"]]),
    }


def test_depth_of_many_tables(spark):
    """More tables than one chunk of the running depth, and a nest as deep as a chunk and more."""
    many = "<table><tr><td>h</td></tr><tr><td>a<table><tr><td>i</td></tr><tr><td>b</td></tr></table></td></tr></table>" * 700
    deep = "<table>" * 600 + "<tr><td>h</td></tr><tr><td>v</td></tr>" + "</table>" * 600
    got = tables(spark, html_tables, many, deep)
    assert sum(1 for k in got if k.split("/")[0] == "0") == 1400 and got["0/1399"] == (["i"], [["b"]])
    assert got["0/1398"] == (["h"], [["aib"], ["i"], ["b"]])
    assert [got[f"1/{n}"] for n in (1, 511, 512, 599)] == [(["h"], [["v"]])] * 4


def test_xml_elements_within_elements_of_their_name(spark):
    got = tables(
        spark, xml_tables,
        "<r><i k='1'><n>a</n><i k='no'><n>no</n></i></i><b:i xmlns:b='u' k='2'><n>c<n>d</n></n></b:i><i/></r>",
        '<D><DataSet><Series A="1"><Obs V="5"/><Series A="2"><Obs V="6"></Obs></Series></Series></DataSet></D>',
        '<S><Codelist id="C"><Code value="1"><Code value="2"><Name>x</Name></Code></Code></Codelist></S>',
    )
    assert got == {
        "0": (["i", "k", "n"], [["", "1", "a"], [None, "2", "c"], [None, None, None]]),
        "1": (["A", "V"], [["1", "5"], ["1", "6"], ["2", "6"]]),
        "2": (["Code", "Name", "value"], [["", None, "1"], [None, "x", "2"]]),
    }


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_xml_are_made_once(spark):
    texts = spark.createDataFrame([("d", "1", "T", "<r><a><b>1</b></a><a><b>2</b></a></r>")], SCHEMA)
    filters = [line for line in optimized(row_values_long(xml_tables(texts))).split("\n") if "Filter" in line]
    assert not [f for f in filters if "transform(" in f]


def test_text_of_an_html_cell_is_made_once(spark):
    texts = spark.createDataFrame([("d", "1", "T", "<table><tr><td>a</td></tr></table>")], SCHEMA)
    assert optimized(html_tables(texts)).count("<[^>]*>") == 1


def test_shape_of_elements(spark):
    cases = {
        "<a><b/></a>": (True, False, None), "<a><a>x</a> y</a>": (True, True, "<a ~1><a ~2>x</a ~2> y</a ~1>"),
        '<a><p:a n="1"><c/></p:a></a>': (True, True, '<a ~1><p:a ~2 n="1"><c ~3/></p:a ~2></a ~1>'), "<a><b></a></b>": (False, False, None),
        "<a><a></a>": (False, True, None), "<a><b></b><b></b></a>": (True, False, None), "</a>": (False, False, None), "plain": (True, False, None),
    }
    df = spark.createDataFrame([(t,) for t in [*cases, None]], "text string")
    got = {r.text: tuple(r["shape"]) for r in df.select("text", element_shape(F.col("text")).alias("shape")).collect()}
    assert got == cases | {None: (None, None, None)}


def test_cells_and_headers(spark):
    df = spark.createDataFrame([("d", "1", "T", "Name,Total: \n Ann ,1,5\n,x%\n")], SCHEMA)
    made = csv_tables(df)
    cells = row_values_long(made).orderBy("source_row_number", "source_column_number").collect()
    assert [(c.source_row_number, c.source_column_number, c.row_label_raw, c.value_raw, c.value_numeric_guess) for c in cells] == [
        (0, 0, " Ann ", "Ann", None), (0, 1, " Ann ", "1", 1.0), (1, 0, None, None, None), (1, 1, None, "x%", None),
    ]
    assert len({c.staging_value_id for c in cells}) == 4
    assert [h.header_normalized for h in header_records(made).orderBy("column_number").collect()] == ["name", "total"]


def test_cell_types(spark):
    values = ["2020-01-31", "12 %", "1,5", "text", None, "* note", "(3)", "Source: x"]
    cells = spark.createDataFrame(
        [("t", n, 0, "h", v) for n, v in enumerate(values)],
        "table_id string, source_row_number long, source_column_number long, header_raw string, value_raw string",
    )
    rows = extracted_cells(cells).orderBy("row_number").collect()
    assert [r.value_type_guess for r in rows] == ["date", "percent", "numeric", "text", None, "text", "text", "text"]
    assert [r.note_flag for r in rows] == [False] * 5 + [True, True, True]


def test_guards(spark):
    row = lambda n, heads, rows: ("d", f"t{n}", n, ["h"] * heads, [["v"]] * rows)
    df = spark.createDataFrame(
        [row(0, 1, 2), row(1, 501, 2), row(2, 1, 1), row(3, 1, 5)],
        "document_id string, table_id string, table_index long, headers array<string>, rows array<array<string>>",
    )
    got = {r.table_id: r.guard for r in guarded_tables(df, max_tables=3, max_columns=500, min_rows=2).collect()}
    assert {r.guard for r in guarded_tables(df).collect()} == {"kept"}
    assert got == {"t0": "kept", "t1": "too_many_columns", "t2": "too_few_rows", "t3": "beyond_table_limit"}


def test_tables_with_positions_are_made_once(spark, tmp_path):
    """Positions read the tables several times; the documents behind them are read once."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    kind = "document_id string, table_id string, table_index long, headers array<string>, rows array<array<string>>"
    tables = spark.createDataFrame([("d", f"t{n}", n, ["h"], [["v"]]) for n in range(5)], kind).mapInPandas(count, kind)

    def once(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.schema(df.schema).parquet(str(tmp_path / name))

    got = guarded_tables(tables, max_tables=3, once=once).collect()
    assert sorted(r.table_id for r in got if r.guard == "kept") == ["t0", "t1", "t2"] and len(got) == 5
    assert made.value == 5


def test_sheets(spark):
    rows = [(0, ["A", "", "B"]), (1, ["1", "x", "2"]), (2, [None, "y", " "]), (3, ["3", None, None])]
    df = spark.createDataFrame(
        [("d", "doc", 0, "S", n, c) for n, c in rows],
        "department_id string, document_id string, sheet_index int, sheet_name string, row_number long, cells array<string>",
    )
    got = sheet_row_values(df).orderBy("source_row_number", "source_column_number").collect()
    assert [(r.source_row_number, r.header_raw, r.value_raw) for r in got] == [(0, "A", "1"), (0, "B", "2"), (1, "A", "3"), (1, "B", None)]


def test_ordinals_match_a_plain_window_on_a_hot_group(spark):
    random.seed(3)
    rows = [("hot" if n % 3 else f"g{n % 7}", random.randrange(10_000), n) for n in range(3000)]
    df = spark.createDataFrame(rows, "g string, r long, n long")
    plain = df.withColumn("o", F.row_number().over(Window.partitionBy("g").orderBy("r", "n")).cast("long"))
    ours = with_ordinal(df, "g", "r", ["r", "n"], "o", rows_per_block=64)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))
    first = with_ordinal(df, "g", "r", ["r", "n"], "o", first=100, rows_per_block=64)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, plain.filter("o <= 100").collect()))
