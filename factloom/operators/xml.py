"""Tables from XML documents: statistical data, statistical code lists, repeated elements.

Elements are cut with regular expressions inside the row of their document.
Comments go, CDATA is escaped and ill-formed text refused beforehand. Where an
element stands in another of the same name, tags are labelled with their depth
first. Prefixed attributes keep their prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import row_key
from ..functions.markup import XML_NAMES, plain_xml, references
from ..functions.nesting import LABEL, element_shape

_PREFIX = r"(?:[\w.-]+:)?"
_ATTRIBUTE = r"""([\w:.-]+)\s*=\s*(?:"[^"]*"|'[^']*')"""
_ATTRIBUTE_VALUE = r"""[\w:.-]+\s*=\s*["']((?:(?<=")[^"]*)|(?:(?<=')[^']*))["']"""
_CHILD = rf"(?s)<{_PREFIX}([\w.-]+{LABEL})(?=[\s/>])([^>]*?)(?:/>|>(.*?)</{_PREFIX}\1\s*>)"
_STRAY = r"&(?!(?:#[0-9]+|#x[0-9A-Fa-f]+|lt|gt|quot|apos|amp);)"
_PROLOG = r"(?s)^\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*"

# Root elements of spreadsheet formatting files, which hold no data.
SPREADSHEET_ROOTS = ["Workbook", "Worksheet", "Table", "Row", "Cell", "Style", "Font", "Interior"]


def local_name(tag: Column) -> Column:
    """Name without ``prefix:`` or ``{namespace}``."""
    return F.regexp_replace(tag, r"^.*[}:]", "")


def _element(name: str) -> str:
    return rf"(?s)(?=(<{_PREFIX}{name}({LABEL})(?=[\s/>])(?:[^>]*?/>|[^>]*>.*?</{_PREFIX}{name}\2\s*>)))"


def find_elements(text: Column, name: str) -> Column:
    """Source text of every element with this local name, those inside each other too."""
    return F.regexp_extract_all(text, F.lit(_element(name)), F.lit(1))


def _open_tag(element: Column) -> Column:
    return F.regexp_extract(element, r"(?s)^<[^>]*>", 0)


def _unescape(text: Column) -> Column:
    return references(text, XML_NAMES)


def attributes(element: Column) -> Column:
    """``array<struct<k,v>>`` of the element's own attributes, namespace declarations left out."""
    tag = _open_tag(element)
    names = F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1))
    values = F.regexp_extract_all(tag, F.lit(_ATTRIBUTE_VALUE), F.lit(1))
    pairs = F.zip_with(names, values, lambda k, v: F.struct(k.alias("k"), _unescape(v).alias("v")))
    return F.filter(pairs, lambda p: ~p["k"].rlike("^xmlns(?::|$)"))


def child_texts(element: Column) -> Column:
    """``array<struct<k,v>>`` of the direct children: local name and leading text."""
    body = F.regexp_extract(element, r"(?s)^<[^>]*[^/]>(.*)</[^>]*>$", 1)
    children = F.regexp_extract_all(body, F.lit(_CHILD), F.lit(0))
    # in two steps, as the text would be cut again for each use of it
    raw = F.transform(children, lambda c: F.struct(
        F.regexp_extract(c, rf"^<{_PREFIX}([\w.-]+)", 1).alias("k"), F.regexp_extract(c, r"(?s)^<[^>]*[^/]>([^<]*)", 1).alias("v"),
    ))
    return F.transform(raw, lambda e: F.struct(e["k"].alias("k"), _unescape(e["v"]).alias("v")))


def _keys(entries: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(entries, lambda e: e["k"])))


def _row(entries: Column, headers: Column) -> Column:
    """One value per header; the last entry of a name wins."""
    return F.transform(
        headers, lambda h: F.try_element_at(F.filter(entries, lambda e: e["k"] == h), F.lit(-1))["v"]
    )


def xml_route(text: Column) -> Column:
    """``malformed``, ``spreadsheet``, ``sdmx_data``, ``sdmx_structure`` or ``generic``."""
    plain = plain_xml(text)
    return _route(plain, element_shape(_body(plain))["balanced"])


def _body(text: Column) -> Column:
    return F.regexp_replace(text, _PROLOG, "")


def _route(text: Column, balanced: Column) -> Column:
    body = _body(text)
    root = F.regexp_extract(body, r"^<([\w:.-]+)", 1)
    closed = F.regexp_extract(body, r"(?s)</([\w:.-]+)\s*>\s*$", 1) == root
    self_closed = body.rlike(r"(?s)^<[^>]*/>\s*$")
    has = lambda name: body.rlike(rf"<{_PREFIX}{name}(?=[\s/>])")
    return (
        F.when(F.coalesce(root, F.lit("")) == "", "malformed")
        .when(~(closed | self_closed) | ~balanced | body.rlike(_STRAY), "malformed")
        .when(local_name(root).isin(SPREADSHEET_ROOTS), "spreadsheet")
        .when(has("Series") & has("Obs"), "sdmx_data")
        .when(has("Codelist") | has("ConceptScheme"), "sdmx_structure")
        .otherwise("generic")
    )


def _data_set_units(text: Column) -> Column:
    """Per data set: one entry list per observation, series attributes first."""

    def series_rows(series: Column) -> Column:
        observations = F.transform(find_elements(series, "Obs"), attributes)
        return F.transform(observations, lambda o: F.concat(attributes(series), o))

    def unit(data_set: Column) -> Column:
        series = find_elements(data_set, "Series")
        return F.struct(
            F.lit(None).cast("string").alias("id"),
            _keys(F.flatten(F.transform(series, attributes))).alias("first"),
            F.flatten(F.transform(series, series_rows)).alias("rows"),
        )

    return F.transform(find_elements(text, "DataSet"), unit)


def _code_list_units(text: Column) -> Column:
    """Per code list: one entry list per code, attributes and child texts."""

    def unit(code_list: Column) -> Column:
        own_id = F.filter(attributes(code_list), lambda a: a["k"] == "id")
        return F.struct(
            F.try_element_at(own_id, F.lit(1))["v"].alias("id"),
            F.array().cast("array<string>").alias("first"),
            F.transform(find_elements(code_list, "Code"), _element_entries).alias("rows"),
        )

    return F.transform(find_elements(text, "Codelist"), unit)


def _element_entries(element: Column) -> Column:
    return F.concat(attributes(element), child_texts(element))


UNITS = "array<struct<id:string,first:array<string>,rows:array<array<struct<k:string,v:string>>>>>"


def xml_tables(documents: DataFrame, routes: list[str] | None = None) -> DataFrame:
    """``documents(department_id, document_id, title, text)`` to tables, in one pass over the documents.

    ``sdmx_data`` gives a table per data set with a row per observation,
    ``sdmx_structure`` a table per code list, ``generic`` one table of the
    children of the root that share the most frequent name (first on a tie).
    """
    routed = documents.select(
        "department_id", "document_id", F.nullif("title", F.lit("")).alias("title"),
        plain_xml(F.col("text")).alias("text"),
    ).withColumn("shape", element_shape(_body(F.col("text")))).select(
        "department_id", "document_id", "title", _route(F.col("text"), F.col("shape.balanced")).alias("route"),
        F.coalesce("shape.text", "text").alias("text"),
    )
    if routes is not None:
        routed = routed.filter(F.col("route").isin(routes))

    root_body = F.regexp_extract(
        F.regexp_replace("text", _PROLOG, ""), r"(?s)^<[^>]*[^/]>(.*)</[^>]*>\s*$", 1
    )
    staged = (
        routed.withColumn(
            "children", F.when(F.col("route") == "generic", F.regexp_extract_all(root_body, F.lit(_CHILD), F.lit(0)))
        )
        .withColumn("tags", F.transform("children", lambda c: F.regexp_extract(c, rf"^<{_PREFIX}([\w.-]+)", 1)))
        .withColumn("tag", F.array_max(F.transform(
            F.array_distinct("tags"),
            lambda t, i: F.struct(
                F.size(F.filter("tags", lambda x: x == t)).alias("n"), (-i).alias("order"), t.alias("name")
            ),
        )))
    )
    repeated = F.filter("children", lambda c, i: F.get("tags", i) == F.col("tag.name"))
    generic = F.array(F.struct(
        F.col("tag.name").alias("id"),
        F.array().cast("array<string>").alias("first"),
        F.transform(repeated, _element_entries).alias("rows"),
    ))
    units = (
        F.when(F.col("route") == "sdmx_data", _data_set_units(F.col("text")).cast(UNITS))
        .when(F.col("route") == "sdmx_structure", _code_list_units(F.col("text")).cast(UNITS))
        .when(F.col("tag.n") >= 2, generic.cast(UNITS))
    )
    tables = (
        staged.select(
            "department_id", "document_id", "title", "route",
            F.posexplode(F.filter(units, lambda u: F.size(u["rows"]) > 0)).alias("table_index", "unit"),
        )
        .withColumn("headers", F.concat(
            "unit.first", F.array_except(_keys(F.flatten("unit.rows")), F.col("unit.first"))
        ))
        .withColumn("_id", F.coalesce("unit.id", F.concat(F.lit("codelist_"), F.col("table_index"))))
    )
    by_route = lambda data, structure, plain: (
        F.when(F.col("route") == "sdmx_data", data).when(F.col("route") == "sdmx_structure", structure).otherwise(plain)
    )
    document, index, own_id = F.col("document_id"), F.col("table_index"), F.col("_id")
    # Rows come out of a generator: a filter on them would be pushed below it and make them a second time.
    return tables.select(
        "*", F.inline(F.array(F.struct(F.transform("unit.rows", lambda r: _row(r, F.col("headers"))).alias("rows")))),
    ).select(
        "department_id", "document_id",
        by_route(
            row_key(document, "sdmx_data", index),
            row_key(document, "sdmx_structure", index, own_id),
            row_key(document, "generic_xml", own_id),
        ).alias("table_id"),
        index.cast("long").alias("table_index"),
        by_route(
            F.lit("sdmx_data_parser"), F.lit("sdmx_structure_parser"), F.lit("generic_xml_parser")
        ).alias("extraction_method"),
        by_route(F.col("title"), F.concat(F.lit("Codelist: "), own_id), F.col("title")).alias("table_title_raw"),
        F.lit(None).cast("string").alias("sheet_name"),
        "headers", "rows",
    )
