"""Accounting-style numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coffer.functions.text import SPACE

# Decimal notation of any length and exponent.  The cast alone would also take "12d", "nan"
# or "Infinity".
_NUMBER = rf"^{SPACE}*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?){SPACE}*$"


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a finite plain number gives NULL.

    One pattern both trims and checks, so the text is built once per row.  A number beyond
    what a double holds is not finite.
    """
    return finite(F.regexp_extract(c, _NUMBER, 1).try_cast("double"))


def finite(value: Column) -> Column:
    """The value, or NULL where it is infinite."""
    infinity = F.lit(float("inf"))
    return F.nullif(F.nullif(value, infinity), -infinity)


def _without_commas(c: Column) -> Column:
    return F.replace(c.cast("string"), F.lit(","), F.lit(""))


def accounting_number(c: Column, mode: str = "python") -> Column:
    """``61,000`` -> 61000, ``(61,000)`` -> -61000, otherwise NULL.

    ``mode="node"`` also drops currency signs and other stray characters first.
    """
    text = _without_commas(c)
    if mode == "python":
        signed = F.regexp_replace(text, r"\((.*?)\)", "-$1")
        return to_number(F.when(text.contains("("), signed).otherwise(text))
    bracketed = text.contains("(") & text.contains(")")
    # The sign as a factor: the number stands in the expression, and is read, only once.
    return to_number(F.regexp_replace(text, r"[^0-9.\-]", "")) * F.when(bracketed, F.lit(-1.0)).otherwise(F.lit(1.0))


def whole_amount(c: Column, rounding: str = "truncate") -> Column:
    """Amount text as a whole number; blank or bad text counts as 0.

    ``rounding="half_up"`` rounds to the nearest, halves upwards.
    """
    return whole_number(to_number(_without_commas(c)), rounding)


def whole_number(value: Column, rounding: str = "truncate") -> Column:
    """A double as a whole number; NULL counts as 0."""
    if rounding == "half_up":
        value = F.floor(value + 0.5)
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))
