"""Incremental load of expense sheets as they land.

Each trigger takes the files that arrived since the last one and runs them through
the same stage, clean and load steps as the batch job, reading only the new rows.  A micro-batch that is replayed
after a failure writes the same raw partition, and the natural-key anti-join finds its
rows already loaded, so no fact is inserted twice.

``stream_transactions`` keeps the natural keys it has seen in the state store instead, for as
long as an export may come again, and hands only keys it has not seen to the ledger.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from coffer.functions.text import null_to_blank
from coffer.plans.cleaning import clean_expenses
from coffer.plans.jobs import SOURCES, insert_candidates, run_batch
from coffer.plans.loading import NATURAL_KEY, candidates
from coffer.session import materialise
from coffer.sources.sheets import tidy_cells
from coffer.sources.zones import STREAM_BATCHES, StoredLedger, highest_batch, read_or_none


def landing_stream(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True) -> DataFrame:
    """Sheet files as a stream of text rows with their place in the export."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        # An export that is copied in with its old time is new here; by default a week is too old.
        .option("maxFileAge", "7300d")
        .csv(path)
    )
    return rows.select(
        "*",
        F.col("_metadata.file_modification_time").alias("_time"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def _first_batch(spark: SparkSession, root: str, source: str, checkpoint: str) -> int:
    """Id of the stream's batch 0, kept beside its progress.

    Ids of streams begin beyond those of the daily job.  A stream whose progress was lost
    counts from 0 again, so it begins behind all batches that earlier ones have written.
    """
    path = f"{checkpoint}-first-batch"
    kept = read_or_none(spark, path)
    started = read_or_none(spark, f"{checkpoint}/metadata", source="text") is not None
    if kept is not None and started:
        return kept.agg(F.max("id")).first()[0]
    first = max(STREAM_BATCHES, (highest_batch(spark, root, source) or 0) + 1)
    spark.range(first, first + 1).write.mode("overwrite").parquet(path)
    return first


def load_new_expenses(spark: SparkSession, root: str, columns: Sequence[str]) -> StreamingQuery:
    """Load all files that have landed since the last call, then stop.

    Progress is kept under ``<root>/checkpoints/expenses``.
    """
    source = next(s for s in SOURCES if s.name == "expenses")
    checkpoint = f"{root}/checkpoints/expenses"
    base = _first_batch(spark, root, source.name, checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        place = F.struct(
            F.col("_time").alias("time"),
            F.col("_file").alias("file"),
            F.col("_block").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
        sheet = tidy_cells(batch.select(*columns, place.alias("_row_idx")))
        run_batch(batch.sparkSession, source, sheet, root, base + batch_id, history=False)

    return (
        landing_stream(spark, f"{root}/landing/expenses", columns)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def seen_once(rows: DataFrame, within: str) -> DataFrame:
    """Streamed candidates of which each natural key passes once.

    Event time is when the stream took an export, so none is ever late, however old its file or
    its rows.  A key is held in the state store for ``within`` of that time; what comes again
    later passes and is told from the ledger alone.
    """
    keys = {f"_key_{c}": null_to_blank(F.col(c)) for c in NATURAL_KEY if c not in ("transaction_date", "amount")}
    keyed = rows.withColumns(keys).withColumn("_seen", F.current_timestamp())
    once = keyed.withWatermark("_seen", within).dropDuplicatesWithinWatermark(["transaction_date", "amount", *keys])
    return once.drop("_seen", *keys)


def stream_transactions(
    spark: SparkSession, root: str, columns: Sequence[str], within: str = "60 days", multi_line: bool = True
) -> StreamingQuery:
    """Load expense files that have landed since the last call, then stop; keys seen before stay in the state.

    Of equal keys in one export any row may pass.  Progress and state are kept under
    ``<root>/checkpoints/transactions``; a micro-batch that runs again offers the same keys, which
    the ledger then holds.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        first = materialise(batch, "streamed")
        if not first.isEmpty():
            # Runs only name folders of rejected rows here, which a batch that runs again replaces.
            insert_candidates(spark, root, first, StoredLedger(spark, root), 2 * STREAM_BATCHES + batch_id)

    place = F.struct(F.col("_time").alias("time"), F.col("_file").alias("file"), F.col("_block").alias("block"))
    sheet = tidy_cells(landing_stream(spark, f"{root}/landing/expenses", columns, multi_line).select(*columns, place.alias("_row_idx")))
    return (
        seen_once(candidates(clean_expenses(sheet)), within)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{root}/checkpoints/transactions")
        .trigger(availableNow=True)
        .start()
    )
