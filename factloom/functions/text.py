"""Header text, language and label functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters counted as blank space, and the same set as a regex class.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# Four dashes, four quotes, and the byte order mark that is dropped.
DASHES_QUOTES_MARK = "\u2012\u2013\u2014\u2015\u2018\u2019\u201c\u201d\ufeff"

# Language indicator words and letters.
FRENCH_WORDS = [
    "les", "des", "aux", "pour", "dans", "sur", "avec", "par", "est", "sont",
    "une", "ces", "cette", "entre", "selon", "comme", "mais", "aussi", "donc", "leurs",
]
ENGLISH_WORDS = ["the", "and", "for", "are", "with", "from", "that", "this"]
FRENCH_LETTERS = "àâçéèêëîïôùûüÿæœ"

# Year inside a header, measure words, identifier column names.
YEAR_PATTERN = r"((?:19|20)\d{2})"
MEASURE_WORDS = [
    "pop", "density", "income", "dwelling", "household", "area", "land", "count", "total",
    "median", "average", "wage", "earning", "employ", "rate", "ratio", "percent",
]
GEO_ID_NAMES = ["dauid", "hruid", "csduid", "pruid", "cduid", "cmauid", "dguid"]


def sql_text(text: str) -> str:
    """A text as SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_list(items: list[str]) -> str:
    return "(" + ", ".join(sql_text(item) for item in items) + ")"


def strip(text: Column) -> Column:
    """Remove blank space, Unicode blanks included, from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def not_blank(text: Column) -> Column:
    return F.coalesce(F.length(strip(text)) > 0, F.lit(False))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def normalize_header(raw: Column) -> Column:
    """Fold the spelling variation that carries no meaning in a header."""
    text = F.translate(F.lower(F.coalesce(raw, F.lit(""))), DASHES_QUOTES_MARK, "----''\"\"")
    text = strip(F.regexp_replace(text, WS + "+", " "))
    text = F.regexp_replace(text, r"\( ?% ?\)", "(%)")
    text = F.replace(text, F.lit("m$"), F.lit("millions $"))
    text = F.replace(text, F.lit("$us"), F.lit("$ us"))
    return F.regexp_replace(strip(F.rtrim(text, F.lit(":"))), " +", " ")


def detect_language(text: Column) -> Column:
    """``en``, ``fr``, ``bilingual``, or ``unknown`` for missing text."""
    lower = F.lower(text)
    words = F.regexp_extract_all(lower, F.lit(f"([a-z{FRENCH_LETTERS}]+)"), F.lit(1))

    def hits(vocabulary: list[str]) -> Column:
        return F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in vocabulary])))

    french = lower.rlike(f"[{FRENCH_LETTERS}]") | (hits(FRENCH_WORDS) >= 2)
    return (
        F.when(F.coalesce(text, F.lit("")) == "", "unknown")
        .when(~french, "en")
        .when(hits(ENGLISH_WORDS) >= 2, "bilingual")
        .otherwise("fr")
    )


def header_year(header: Column) -> Column:
    """First year named in a header, or NULL."""
    return F.nullif(F.regexp_extract(header, YEAR_PATTERN, 1), F.lit(""))


def header_without_years(header: Column) -> Column:
    """The measure part of a header such as ``Population, 2016``; the header itself if nothing is left."""
    rest = F.regexp_replace(header, YEAR_PATTERN, "")
    rest = F.btrim(F.regexp_replace(rest, f"[,.]?{WS}+$", ""), F.lit(" ,."))
    return F.when(rest == "", header).otherwise(rest)


def is_measure_year_header(header: Column) -> Column:
    """A year-bearing header that names a measure and not an area identifier."""
    lower = F.lower(header)
    return (
        header_year(header).isNotNull()
        & ~lower.rlike("^(?:" + "|".join(GEO_ID_NAMES) + ")")
        & lower.rlike("|".join(MEASURE_WORDS))
    )


def names_geo_id(header: Column) -> Column:
    return F.lower(header).rlike("|".join(GEO_ID_NAMES))


def infer_geo_type(code: Column) -> Column:
    """Kind of area from the look of its code."""
    text = strip(code)
    return (
        F.when(text.rlike(r"^\d{7}$"), "dissemination_area")
        .when(text.rlike(r"^\d{5}$"), "census_subdivision")
        .when(text.contains("Health") | text.contains("HR"), "health_region")
        .otherwise("unknown")
    )


def dimension_name(normalized: Column) -> Column:
    """``@some_dimension`` to ``some dimension``; the text is already normalised."""
    return F.when(
        normalized.startswith("@"), F.translate(F.substr(normalized, F.lit(2)), "_", " ")
    ).otherwise(normalized)


def attribute_type_name(header: Column) -> Column:
    return dimension_name(normalize_header(header))
