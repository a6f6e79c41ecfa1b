"""Numbers written as text in published tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip

# Cell texts that stand for "no value".
NULL_TOKENS = ["", "-", "...", "x", "n/a", "na", "F", "E"]

_DIGITS = r"\d+(?:_\d+)*"
NUMBER = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
NON_FINITE = r"^(?i)[+-]?(?:nan|inf|infinity)$"


def parse_numeric(text: Column, finite_only: bool = True) -> Column:
    """Double value of a cell, or NULL.

    ``finite_only=False`` is the looser reading used for observations: it keeps
    infinities and not-a-number.
    """
    return parse_bare(bare_number(text), finite_only)


def bare_number(text: Column) -> Column:
    """The text without separators, blanks and signs of money and percent."""
    return strip(F.translate(text, ", $%", ""))


def parse_bare(bare: Column, finite_only: bool = True) -> Column:
    """``parse_numeric`` of what ``bare_number`` gives; ``bare`` is used several times, and functions over arrays evaluate it anew for each."""
    number = F.when(bare.rlike(NUMBER), F.translate(bare, "_", "").try_cast("double"))
    if finite_only:
        number = F.when(F.abs(number) < float("inf"), number)
    else:
        lower = F.lower(bare)
        number = number.when(
            bare.rlike(NON_FINITE),
            F.when(lower.endswith("nan"), float("nan"))
            .when(lower.startswith("-"), float("-inf"))
            .otherwise(float("inf")),
        )
    return F.when(~bare.isin(*NULL_TOKENS, "None"), number)
