"""Manifest of landed files: which exports a source has taken, and in which batch.

``manifest/<source>/`` has a partition per batch, with one row for each file the batch took:
its path, size and time of writing.  A file written anew under an old name is another file.
The folder listing is a frame like the manifest, so both meet in an anti-join; only paths of
files still to be read come to the driver, which hands them to the reader.

Entries are written after a batch has been loaded.  A batch that fails leaves none, so the
next one takes its files again.  A batch that runs again sees the manifest without its own
entries: it takes the same files and replaces what it wrote.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.sources.zones import read_or_none

FILE = ("path", "length", "modified")


def landed_files(spark: SparkSession, folder: str) -> DataFrame | None:
    """``path, length, modified`` of every file below ``folder``; None where there is no folder.

    Contents are not opened.  Names that begin with a dot or an underscore are left out.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def taken_files(spark: SparkSession, root: str, source: str) -> DataFrame | None:
    """All entries, with the ``batch`` that took the file."""
    return read_or_none(
        spark, f"{root}/manifest/{source}", "path STRING, length BIGINT, modified TIMESTAMP, batch BIGINT"
    )


def new_files(spark: SparkSession, root: str, source: str, batch_id: int) -> DataFrame | None:
    """Landed files that no other batch has taken."""
    landed = landed_files(spark, f"{root}/landing/{source}")
    taken = taken_files(spark, root, source)
    if landed is None or taken is None:
        return landed
    return landed.join(taken.filter(F.col("batch") != batch_id).select(*FILE), list(FILE), "left_anti")


def note_taken(files: DataFrame, root: str, source: str, batch_id: int) -> None:
    """Write the entries of a batch; the same batch again replaces its own."""
    files.select(*FILE).write.mode("overwrite").parquet(f"{root}/manifest/{source}/batch={batch_id}")


def paths(files: DataFrame) -> list[str]:
    """Paths for the reader, in order.  As many as a run has new exports."""
    return [r[0] for r in files.select("path").orderBy("path").collect()]
