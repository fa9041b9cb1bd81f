"""Dates and calendar months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coffer.functions.text import SPACE

MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


_US = rf"^{SPACE}*([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}}){SPACE}*$"
_ISO = rf"^{SPACE}*([0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}})( ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9])?{SPACE}*$"


def parse_date(c: Column) -> Column:
    """``M/d/yyyy``, ``yyyy-M-d`` or ``yyyy-M-d HH:mm:ss``; otherwise NULL.

    The shape decides how a cell is read, so the result does not depend on row
    order, and a cell that is no date costs two pattern matches and no exception.
    """
    rearranged = F.regexp_replace(c.cast("string"), _US, "$3-$1-$2")
    return F.regexp_extract(rearranged, _ISO, 1).try_cast("date")


def month_number(yr: Column, mo: Column) -> Column:
    """Months counted from year 0, so that a month range is one comparison."""
    return yr * 12 + mo


def first_of_month(yr: Column, mo: Column) -> Column:
    return F.make_date(yr, mo, F.lit(1))


def month_label(yr: Column, mo: Column) -> Column:
    return F.date_format(first_of_month(yr, mo), "MMM yyyy")
