"""Text expressions and header rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.schema import TRUE_WORDS

# Bookkeeping columns of a sheet: which load a row came with, and its place in that load.
ROW_ORDER = ("_batch_id", "_row_idx")

# Every character that Unicode counts as white space, plus the four ASCII
# separators: spreadsheet cells often carry a no-break space.
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same characters as a pattern.
SPACE = r"[\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def trim(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACES))


def fold(c: Column) -> Column:
    """Form in which names are compared: trimmed, lower case."""
    return F.lower(trim(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def is_true(c: Column) -> Column:
    return F.coalesce(fold(c.cast("string")).isin(*TRUE_WORDS), F.lit(False))


def distinct_names(names: list[str]) -> list[str]:
    """The names, where one that came before gets a number: ``note``, ``note_2``."""
    used, out = set(names), []
    for place, name in enumerate(names):
        number = 2
        if name in names[:place]:
            while f"{name}_{number}" in used:
                number += 1
            name = f"{name}_{number}"
            used.add(name)
        out.append(name)
    return out


def lower_headers(df: DataFrame) -> DataFrame:
    """Header rule of the raw zone: trimmed, lower case, inner spaces kept.

    Of headers that become equal the first keeps the name.
    """
    return df.toDF(*distinct_names([c.strip().lower() for c in df.columns]))


def snake_headers(df: DataFrame) -> DataFrame:
    """Header rule of the cleaner: also turns each run of spaces into ``_``."""
    return df.toDF(*distinct_names([re.sub(r"\s+", "_", c.strip().lower()) for c in df.columns]))


def drop_nameless(df: DataFrame) -> DataFrame:
    """Drop columns without a header (blank, or the ``_cN`` a CSV reader invents)."""
    named = [c for c in df.columns if c.strip() and not re.fullmatch(r"(_c|_)\d+", c)]
    return df.select(*[F.col(f"`{c}`") for c in named])


def headers_look_numeric(names: list[str]) -> bool:
    return bool(names) and all(n.strip().replace(".", "", 1).isdigit() for n in names)


def text_columns(df: DataFrame) -> list[str]:
    """The sheet's own columns, without bookkeeping."""
    return [c for c in df.columns if c not in ROW_ORDER]
