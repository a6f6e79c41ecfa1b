"""Character references, and XML brought to a form that simple tag patterns can read."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

XML_NAMES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}
# No-break space reads as a space, as in the text of a cell.
HTML_NAMES = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'", "nbsp": " "}
_REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
_SECTION = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
_TAG = r"""<[A-Za-z_](?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+>"""


def references(text: Column, names: dict[str, str]) -> Column:
    """Resolve named, decimal and hexadecimal references, each once; unknown names stay."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])

    def char(reference: Column) -> Column:
        code = F.when(reference.rlike("^#[xX]"), F.conv(F.substring(reference, 3, 6), 16, 10)).when(
            reference.startswith("#"), F.substring(reference, 2, 7)
        ).try_cast("long")
        # surrogates and numbers beyond the last character stand for no character
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        numbered = F.when(code == 160, " ").when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.coalesce(numbered, F.try_element_at(table, reference))

    found = F.array_distinct(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(1)))
    # "&amp;" comes last, so that what it gives is not read as a reference again
    late = F.concat(F.filter(found, lambda r: ~r.isin("amp", "#38")), F.filter(found, lambda r: r.isin("amp", "#38")))
    resolved = F.aggregate(
        late, text,
        lambda done, r: F.coalesce(F.replace(done, F.concat(F.lit("&"), r, F.lit(";")), char(r)), done),
    )
    return F.when(text.contains("&"), resolved).otherwise(text)


def plain_xml(text: Column) -> Column:
    """XML without comments, with the text of CDATA sections escaped, and no ``>`` inside attribute values."""
    escaped = lambda s: F.replace(F.replace(F.replace(s, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    inner = lambda s: F.substr(s, F.lit(10), F.length(s) - 12)
    sections = F.array_distinct(F.regexp_extract_all(text, F.lit(_SECTION), F.lit(0)))
    without = F.when(
        text.contains("<!"),
        F.aggregate(sections, text, lambda done, s: F.replace(done, s, F.when(s.startswith("<!--"), F.lit("")).otherwise(escaped(inner(s))))),
    ).otherwise(text)
    quoted = lambda t: F.instr(F.substr(t, F.lit(1), F.length(t) - 1), ">") > 0
    tags = F.filter(F.array_distinct(F.regexp_extract_all(without, F.lit(_TAG), F.lit(0))), quoted)
    closed = lambda t: F.concat(F.replace(F.substr(t, F.lit(1), F.length(t) - 1), F.lit(">"), F.lit("&gt;")), F.lit(">"))
    may_quote = without.rlike(r"""=\s*(?:"[^"<]*>[^"<]*"|'[^'<]*>[^'<]*')""")
    return F.when(may_quote, F.aggregate(tags, without, lambda done, t: F.replace(done, t, closed(t)))).otherwise(without)
