"""Cleaner for the expenses sheet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from coffer.functions.dates import parse_date
from coffer.functions.numbers import accounting_number
from coffer.functions.text import (
    ROW_ORDER,
    distinct_names,
    drop_nameless,
    headers_look_numeric,
    null_to_blank,
    snake_headers,
    text_columns,
    trim,
)
from coffer.schema import ARTEFACT_COLUMNS

NUMBER_COLUMNS = ("amount", "balance")
FILLED_COLUMNS = ("description", "note")


def _is_at(column: str, place) -> Column:
    """Whether a row stands at ``place``, which has parts where the sheet was read from files."""
    if isinstance(place, Row):
        return reduce(lambda a, b: a & b, [F.col(f"{column}.{k}") == F.lit(v) for k, v in place.asDict().items()])
    return F.col(column) == F.lit(place)


def promote_header(sheet: DataFrame) -> DataFrame:
    """Take the first row as header where all column names are just numbers."""
    names = text_columns(sheet)
    if not headers_look_numeric(names):
        return sheet
    order = [c for c in ROW_ORDER if c in sheet.columns]
    first = sheet.orderBy(*order).limit(1).collect()
    if not first:
        return sheet
    header = first[0].asDict()
    is_header = reduce(lambda a, b: a & b, [_is_at(c, header[c]) for c in order])
    # Empty cells of the header row leave nameless columns; all but the first get a number.
    given = distinct_names([header[c] or "" for c in names])
    renamed = [F.col(f"`{c}`").alias(name) for c, name in zip(names, given)]
    return sheet.filter(~is_header).select(*renamed, *order)


def computed_once(df: DataFrame, cells: Sequence[Column]) -> DataFrame:
    """``cells`` of ``df``, unfolded from one struct per row.

    Filters on a plain projection move below joins with a copy of all that it computes, so
    texts are parsed again for each condition, in methods too long for the JVM to compile.
    They do not move below ``inline``.
    """
    return df.select(F.inline(F.array(F.struct(*cells))))


def clean_expenses(sheet: DataFrame, mode: str = "python") -> DataFrame:
    """Typed, trimmed and flagged rows; rows without a readable date are dropped.

    ``mode="python"`` flags rows whose amount or balance is no number in
    ``needs_cleaning``.  ``mode="node"`` drops such rows unless the cell is blank,
    ignores stray characters in numbers, and gives the date as ISO text.
    """
    df = drop_nameless(snake_headers(promote_header(sheet)))
    names = [c for c in text_columns(df) if c not in ARTEFACT_COLUMNS and c not in ("needs_cleaning", "source_data")]
    if "date" not in names:
        raise ValueError("the sheet has no date column")
    numbers = [c for c in NUMBER_COLUMNS if c in names]
    order = [c for c in ROW_ORDER if c in df.columns]

    cells = []
    for name in names:
        cell = F.col(f"`{name}`")
        if name == "date":
            cell = parse_date(cell)
        elif name in numbers:
            cell = accounting_number(cell, mode)
        else:
            cell = trim(cell)
            if name in FILLED_COLUMNS and mode == "python":
                cell = null_to_blank(cell)
        cells.append(cell.alias(name))

    if mode == "python":
        typed = computed_once(df, [*cells, *order]).filter(F.col("date").isNotNull())
        bad = reduce(or_, [F.col(c).isNull() for c in numbers], F.lit(False))
        marks = [bad.alias("needs_cleaning"), F.lit("python-api").alias("source_data")]
        return typed.select(*[f"`{c}`" for c in names], *marks, *order)

    kept = [F.col(c).isNotNull() | (F.col(f"_text_{c}") == "") for c in numbers]
    texts = [null_to_blank(trim(F.col(c))).alias(f"_text_{c}") for c in numbers]
    readable = reduce(lambda a, b: a & b, kept, F.col("date").isNotNull())
    typed = computed_once(df, [*cells, *texts, *order]).filter(readable)
    day = F.date_format("date", "yyyy-MM-dd").alias("date")
    out = [day if c == "date" else F.col(f"`{c}`") for c in names]
    return typed.select(*out, F.lit("nodejs").alias("source_data"), *order)
