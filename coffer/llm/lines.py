"""Removal of passages of three lines and more that occurred before.

Every three consecutive lines with a word form a window.  Windows whose hashes occur
again anywhere are found by counting; the first occurrence stays, and the lines that any
later occurrence covers go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.llm.frames import SPACES
from coffer.session import materialise

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _has_word(line: Column) -> Column:
    return line.rlike(f"[^{SPACES}]")


def _later_windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``mark`` of a text and the windows in it that occurred before (``ats``)."""
    lines = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("mark"), _lines(F.col(text_col)).alias("lines")
    )
    words = F.filter("lines", _has_word)
    # Columns of their own, as an expression inside a lambda is worked out at each step.
    hashed = lines.select(
        "id",
        "mark",
        F.transform(words, lambda x: F.xxhash64(x)).alias("one"),
        F.transform(words, lambda x: F.xxhash64(F.lit("second"), x)).alias("two"),
    ).filter(F.size("one") >= WINDOW)

    def window(j: Column) -> Column:
        one, two = ([F.element_at(h, j + k) for k in range(WINDOW)] for h in ("one", "two"))
        return F.struct(F.xxhash64(*one).alias("h1"), F.xxhash64(F.lit("w"), *two).alias("h2"), j.alias("at"))

    places = F.sequence(F.lit(1), F.size("one") - (WINDOW - 1))
    found = hashed.select("id", "mark", F.explode(F.transform(places, window)).alias("w"))
    windows = materialise(found.select("id", "mark", "w.h1", "w.h2", "w.at"), "windows")
    place = F.struct("id", "mark", "at")
    # Counted before the join, so a window of very many documents is one row there.
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(~F.col("first").eqNullSafe(F.col("last")))
    )
    later = windows.join(repeated, ["h1", "h2"]).filter(~place.eqNullSafe(F.col("first")))
    return later.groupBy("id", "mark").agg(F.collect_set("at").alias("ats"))


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: str = "__lines"
) -> DataFrame:
    """``docs`` with ``text_col`` cleaned, the number of lines with a word before, in
    ``<prefix>_n``, and of those that went, in ``<prefix>_gone``.

    Lines are what line feeds part, compared as they are.  Lines without a word stand in
    no window and stay.  The first occurrence of a window is the one with the least id,
    then place.  All lines that later occurrences cover go, so overlapping windows merge;
    a line that repeats four times and more in a row shrinks to its first.  Texts with
    fewer than three lines with a word, empty texts and NULL stay as they are.  Rows that
    share id and text are one document and are cleaned alike; a NULL id comes first.

    A text that loses all its lines keeps its line feeds between empty lines only.
    """
    later = _later_windows(docs.filter(F.col(text_col).contains("\n")), id_col, text_col)
    at = f"{prefix}_at"
    later = later.select(F.col("id").alias(f"{prefix}_id"), F.col("mark").alias(f"{prefix}_mark"), F.col("ats").alias(at))
    same = docs[id_col].eqNullSafe(later[f"{prefix}_id"]) & (
        F.xxhash64(docs[text_col]) == later[f"{prefix}_mark"]
    )
    every, full, gone = f"{prefix}_all", f"{prefix}_full", f"{prefix}_rows"
    covered = F.flatten(F.transform(F.col(at), lambda j: F.sequence(j - 1, j + (WINDOW - 2))))
    joined = (
        docs.join(later, same, "left")
        .withColumn(every, _lines(F.col(text_col)))
        .withColumn(
            full, F.filter(F.sequence(F.lit(1), F.size(every)), lambda i: _has_word(F.element_at(F.col(every), i)))
        )
        .withColumn(gone, F.transform(F.array_distinct(covered), lambda p: F.element_at(F.col(full), p + 1)))
    )
    # A filter on the numbers moves before these columns, so they stand on their own.
    count = F.size(F.filter(_lines(F.col(text_col)), _has_word))
    places = F.array_except(F.sequence(F.lit(1), F.size(every)), F.col(gone))
    kept = F.transform(places, lambda i: F.element_at(F.col(every), i))
    return (
        joined.withColumn(f"{prefix}_n", F.coalesce(count, F.lit(0)).cast("bigint"))
        .withColumn(f"{prefix}_gone", F.coalesce(F.size(F.array_distinct(covered)), F.lit(0)).cast("bigint"))
        .withColumn(text_col, F.when(F.col(at).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")))
        .drop(f"{prefix}_id", f"{prefix}_mark", at, every, full, gone)
    )


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed`` and the cleaned ``text`` of every row."""
    narrow = docs.select(id_col, text_col)
    cleaned = drop_repeated_lines(narrow, id_col, text_col)
    return cleaned.select(
        id_col,
        F.col("__lines_n").alias("n_lines"),
        F.col("__lines_gone").alias("n_removed"),
        F.col(text_col).alias("text"),
    )
