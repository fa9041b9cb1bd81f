"""Worksheet exports: CSV in, CSV out, every cell text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.functions.text import null_to_blank, text_columns, trim

# Rows of one exported file, which one task reads: below what spreadsheets hold.
FILE_ROWS = 500_000


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def tidy_cells(sheet: DataFrame) -> DataFrame:
    """Missing cells become blank and rows with only blank cells are dropped."""
    names = text_columns(sheet)
    cells = [null_to_blank(F.col(f"`{c}`")).alias(c) for c in names]
    rest = [c for c in sheet.columns if c not in names]
    filled = sheet.select(*cells, *rest)
    return filled.filter(F.concat_ws("", *[trim(F.col(f"`{c}`")) for c in names]) != "")


def read_sheet(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Worksheet rows as text, with ``_row_idx`` giving their place in the export.

    ``path`` is a folder, a file, or a list of files that have one header.

    The first line of each file is the header; a byte-order mark is skipped.  Quoted
    cells may hold line breaks, so each file is read by one task: spreadsheets limit
    a worksheet's cells, which bounds the file.  An export known to be free of line
    breaks can be read with ``multi_line=False``, which splits large files.
    """
    rows = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("recursiveFileLookup", True)
        .csv(path)
    )
    return tidy_cells(rows.select("*", sheet_place().alias("_row_idx")))


def sheet_place() -> Column:
    """Place of a row among all exports: exports in the order in which they were written, then
    files, the splits of a file, and the rows of a split."""
    return F.struct(
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def write_sheet(df: DataFrame, path: str) -> None:
    """Write all columns as quoted CSV text, quotes doubled, blanks kept as they are.

    A partition of many rows fills several files, in its order.
    """
    (
        df.write.mode("overwrite")
        .option("maxRecordsPerFile", FILE_ROWS)
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
