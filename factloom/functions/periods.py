"""Time periods written as text: fiscal and calendar years, months, ranges, relative years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import BLANKS, WS, sql_list, sql_text, strip

# Month names, scenario words before a year, first month of a fiscal year.
MONTHS = {
    1: ["january", "jan", "janvier"],
    2: ["february", "feb", "février"],
    3: ["march", "mar", "mars"],
    4: ["april", "apr", "avril"],
    5: ["may", "mai"],
    6: ["june", "jun", "juin"],
    7: ["july", "jul", "juillet"],
    8: ["august", "aug", "août"],
    9: ["september", "sep", "septembre"],
    10: ["october", "oct", "octobre"],
    11: ["november", "nov", "novembre"],
    12: ["december", "dec", "décembre"],
}
SCENARIO_WORDS = ["projection", "forecast", "actual", "historical", "baseline", "prévision"]
PROJECTION_WORDS = ["projection", "forecast", "prévision"]
FISCAL_START_MONTH = 4

FISCAL_PATTERN = r"^(\d{4})[-–—](\d{4}|\d{2})$"
MONTH_PATTERN = rf"^([a-zéûî]+)\.?{WS}+(\d{{4}})$"
RANGE_PATTERN = rf"^([a-zéûî]+){WS}+to{WS}+([a-zéûî]+){WS}+(\d{{4}}[-–](?:\d{{4}}|\d{{2}}))$"
RELATIVE_PATTERN = rf"^year{WS}+(\d+)$"

# Month spellings and words of periods that are known but not taken.
SHORT_MONTHS = ["janv", "févr", "mär", "avr", "juil", "sept", "déc"]
QUARTER_WORDS = ["q", "quarter", "trimestre"]
SPAN_WORDS = ["to", "à", "and", "et"]
YEAR_WORDS = ["year", "fiscal", "fy", "calendar"]
DAY_PATTERN = r"^(?:\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.]\d{4})$"
MIN_PERIOD_SCORE = 0.6

PERIOD_FIELDS = [
    "time_type", "label", "start_date", "end_date", "is_projection", "scenario_hint",
]


def month_number(name: str) -> str:
    """SQL: number of the month that the expression ``name`` spells, or NULL."""
    cases = " ".join(f"WHEN {name} IN {sql_list(names)} THEN {n}" for n, names in MONTHS.items())
    return f"CASE {cases} END"


def _extract(pattern: str, group: int, text: str = "_text") -> str:
    return f"regexp_extract({text}, {sql_text(pattern)}, {group})"


def _fiscal_start(text: str, century_roll: bool) -> str:
    """SQL: start year when the text is a fiscal year of two neighbouring years, else NULL.

    What does not match is NULL before it is cast: a cast of the empty text fails by an exception, for every row.
    """
    start = f"try_cast(nullif({_extract(FISCAL_PATTERN, 1, text)}, '') AS int)"
    end = f"nullif({_extract(FISCAL_PATTERN, 2, text)}, '')"
    full_end = f"CASE WHEN length({end}) = 2 THEN concat(substring({text}, 1, 2), {end}) ELSE {end} END"
    follows = f"{text} RLIKE {sql_text(FISCAL_PATTERN)} AND try_cast({full_end} AS int) = {start} + 1"
    if century_roll:
        follows = f"(({follows}) OR (length({end}) = 2 AND pmod({start} + 1, 100) = try_cast({end} AS int)))"
    return f"CASE WHEN {follows} AND {start} >= 1000 THEN {start} END"


def _period(kind: str, label: str, start: str, end: str, dated: bool = True) -> str:
    projected = f"coalesce(_word IN {sql_list(PROJECTION_WORDS)}, false)" if dated else "false"
    hint = "_word" if dated else "CAST(NULL AS string)"
    return (
        f"named_struct('time_type', '{kind}', 'label', {label}, 'start_date', {start}, 'end_date', {end}, "
        f"'is_projection', {projected}, 'scenario_hint', {hint})"
    )


def _two(number: str) -> str:
    return f"lpad(CAST({number} AS string), 2, '0')"


def with_period(df: DataFrame, source: Column, out: str, century_roll: bool = False) -> DataFrame:
    """Add ``out``, a struct describing the period that ``source`` names, or NULL.

    Steps are separate projections so that each pattern runs once per row.
    ``century_roll`` also accepts ``1999-00``; by default it is refused, because
    the end year takes the century of the start year.
    """
    kept = [F.col(c) for c in df.columns if c != out]
    digit = "{} BETWEEN '0' AND '9'"
    staged = (
        df.withColumn("_text", strip(F.lower(source)))
        # Every period ends in a digit, and only some begin with a word: other
        # texts become NULL here and cost no pattern matching.
        .selectExpr(
            "*",
            f"CASE WHEN {digit.format('substring(_text, -1, 1)')} THEN _text END AS _timed",
            f"CASE WHEN {digit.format('substring(_text, -1, 1)')} "
            f"AND NOT {digit.format('substring(_text, 1, 1)')} THEN _text END AS _worded",
        )
        .selectExpr(
            "*",
            f"nullif({_extract('^(' + '|'.join(SCENARIO_WORDS) + ')', 1, '_worded')}, '') AS _word",
            f"CASE WHEN contains(_worded, 'to') THEN {_extract(RANGE_PATTERN, 3, '_worded')} ELSE '' END AS _range_years",
            f"CASE WHEN startswith(_worded, 'year') THEN {_extract(RELATIVE_PATTERN, 1, '_worded')} ELSE '' END AS _relative",
            f"{_extract(MONTH_PATTERN, 1, '_worded')} AS _month_name",
        )
        .selectExpr(
            "*",
            f"CASE WHEN _range_years != '' THEN _range_years WHEN _word IS NULL THEN _timed "
            f"ELSE btrim(substr(_text, length(_word) + 1), {sql_text(BLANKS)}) END AS _body",
            f"{month_number('_month_name')} AS _month",
            "CASE WHEN _month_name != '' THEN try_cast(right(_text, 4) AS int) END AS _month_year",
            f"CASE WHEN _range_years != '' THEN {_extract(RANGE_PATTERN, 1, '_worded')} END AS _from",
            f"CASE WHEN _range_years != '' THEN {_extract(RANGE_PATTERN, 2, '_worded')} END AS _to",
        )
        .selectExpr(
            "*",
            f"{month_number('_from')} AS _from_month",
            f"{month_number('_to')} AS _to_month",
            f"{_fiscal_start('_body', century_roll)} AS _fiscal",
            r"CASE WHEN length(_body) = 4 AND _body RLIKE '^[0-9]{4}$' THEN try_cast(_body AS int) END AS _calendar",
        )
    )
    first, last = FISCAL_START_MONTH, FISCAL_START_MONTH - 1
    fiscal = _period(
        "fiscal_year", f"concat(_fiscal, '-', {_two('pmod(_fiscal + 1, 100)')})",
        f"make_date(_fiscal, {first}, 1)", f"last_day(make_date(_fiscal + 1, {last}, 1))",
    )
    calendar = _period(
        "year", "CAST(_calendar AS string)", "make_date(_calendar, 1, 1)", "make_date(_calendar, 12, 31)"
    )
    month = _period(
        "month", f"concat(_month_year, '-', {_two('_month')})", "make_date(_month_year, _month, 1)",
        "last_day(make_date(_month_year, _month, 1))", dated=False,
    )
    span = _period(
        "range", "concat(_from, ' to ', _to, ' ', _range_years)", "make_date(_fiscal, _from_month, 1)",
        "last_day(make_date(CASE WHEN _to_month >= _from_month THEN _fiscal ELSE _fiscal + 1 END, _to_month, 1))",
        dated=False,
    )
    relative = _period(
        "range", "concat('Year ', regexp_replace(_relative, '^0+(?=[0-9])', ''))",
        "CAST(NULL AS date)", "CAST(NULL AS date)", dated=False,
    )
    period = F.expr(
        f"CASE WHEN _range_years = '' AND _fiscal IS NOT NULL THEN {fiscal} "
        f"WHEN _calendar BETWEEN 1900 AND 2100 THEN {calendar} "
        f"WHEN _month IS NOT NULL AND _month_year BETWEEN 1900 AND 2100 THEN {month} "
        f"WHEN _range_years != '' AND _fiscal IS NOT NULL AND _from_month IS NOT NULL AND _to_month IS NOT NULL THEN {span} "
        f"WHEN _relative != '' THEN {relative} END"
    )
    return staged.select(*kept, period.alias(out))


def with_is_time_like(df: DataFrame, source: Column, out: str = "is_time_like") -> DataFrame:
    parsed = with_period(df, source, "_period")
    return parsed.withColumn(out, F.col("_period").isNotNull()).drop("_period")


def with_refusal(
    df: DataFrame, source: Column, out: str = "refusal", min_score: float = MIN_PERIOD_SCORE, century_roll: bool = False
) -> DataFrame:
    """Add ``out``, a struct of ``score`` and ``reason`` for a text that looks like a period and is none, else NULL.

    The score is the share of letters and digits that stand in words of the
    period grammar: month names, words for years, quarters, spans and scenarios,
    numbers of four digits or of at most two. A text looks like a period from
    ``min_score`` on, if it has a number of four digits, or any number beside
    the name of a month or a word for a year or a quarter. Reasons, first that holds:
    ``year_out_of_range``, ``century_turn`` (``1999-00``), ``year_and_month``
    (``2020-01``), ``years_not_neighbours``, ``quarter``, ``day``,
    ``unknown_month``, ``range_of_years``, ``other_form``. NULL and blank texts
    and accepted periods give NULL.
    """
    kept = [F.col(c) for c in df.columns if c != out]
    months = [name for names in MONTHS.values() for name in names]
    grammar = sql_list([*months, *SHORT_MONTHS, *QUARTER_WORDS, *SPAN_WORDS, *YEAR_WORDS, *SCENARIO_WORDS])
    number = "x RLIKE '^[0-9]+$'"
    some = lambda words: f"exists(_words, x -> x IN {sql_list(words)})"
    letters = lambda condition: f"aggregate(filter(_words, x -> {condition}), 0, (n, x) -> n + length(x))"
    start = f"try_cast({_extract(FISCAL_PATTERN, 1, '_body')} AS int)"
    end = _extract(FISCAL_PATTERN, 2, "_body")
    staged = (
        with_period(df, source, "_accepted", century_roll)
        .withColumn("_text", F.when(F.col("_accepted").isNull(), strip(F.lower(source))))
        .selectExpr(
            "*", r"regexp_extract_all(_text, '[a-zà-öø-ÿœ]+|[0-9]+', 0) AS _words",
            f"btrim(regexp_replace(_text, {sql_text('^(?:' + '|'.join(SCENARIO_WORDS) + ')')}, ''), {sql_text(BLANKS)}) AS _body",
        )
        .selectExpr(
            "*", f"{letters(f'x IN {grammar} OR x RLIKE {chr(39)}^([0-9]{{4}}|[0-9]{{1,2}})${chr(39)}')} / nullif({letters('true')}, 0) AS _score",
            "size(filter(_words, x -> x RLIKE '^[0-9]{4}$')) AS _years",
            f"size(filter(_words, x -> {number})) AS _numbers",
            f"{some(months)} AS _in_month",
            f"{_extract(MONTH_PATTERN, 1)} AS _name",
        )
        .selectExpr(
            "*", f"_score >= {min_score}D AND (_years > 0 OR (_numbers > 0 AND (_in_month OR {some([*SHORT_MONTHS, *QUARTER_WORDS, *YEAR_WORDS])}))) AS _looks",
            f"{start} AS _start", f"{end} AS _end",
        )
    )
    reason = F.expr(
        f"CASE WHEN _body RLIKE '^[0-9]{{4}}$' OR _start < 1000 OR {month_number('_name')} IS NOT NULL THEN 'year_out_of_range' "
        "WHEN length(_end) = 2 AND pmod(_start + 1, 100) = try_cast(_end AS int) THEN 'century_turn' "
        "WHEN length(_end) = 2 AND try_cast(_end AS int) BETWEEN 1 AND 12 THEN 'year_and_month' "
        "WHEN _end != '' THEN 'years_not_neighbours' "
        f"WHEN {some(QUARTER_WORDS)} THEN 'quarter' "
        f"WHEN _body RLIKE {sql_text(DAY_PATTERN)} OR (_in_month AND _years = 1 AND _numbers = 2) THEN 'day' "
        f"WHEN {some(SHORT_MONTHS)} THEN 'unknown_month' WHEN _years > 1 THEN 'range_of_years' ELSE 'other_form' END"
    )
    refusal = F.struct(F.round("_score", 4).alias("score"), reason.alias("reason"))
    return staged.select(*kept, F.when(F.col("_looks"), refusal).alias(out))
