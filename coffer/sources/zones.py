"""Folders of a ledger: landing, raw, processed, tables and marts.

``landing/<source>/``  worksheet exports, as CSV
``raw/<source>/``      one partition of text rows per batch, appended and never rewritten
``processed/<source>/``  cleaned rows, one partition per run
``tables/<table>/``    plans and items as snapshots, transactions appended by month
``marts/<mart>/``      one partition per run

Nothing overwrites a folder it reads.  Writing a batch again replaces its own
partition, so a repeated run leaves the same files.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coffer.schema import (
    ACCOUNTS,
    CATEGORIES,
    MONTHLY_PLAN_ITEMS,
    MONTHLY_PLANS,
    SUBCATEGORIES,
    TRANSACTIONS,
    Ledger,
    seed_dimensions,
)


# Batch ids of the daily job lie below, those of streams at and above this number; it is
# higher than any date and time written as a number.
STREAM_BATCHES = 1 << 50


def read_or_none(
    spark: SparkSession, path: str, schema=None, merge: bool = False, source: str = "parquet"
) -> DataFrame | None:
    """The dataset at ``path``, or None where nothing was written yet."""
    reader = spark.read.option("mergeSchema", merge)
    try:
        return (reader.schema(schema) if schema else reader).format(source).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_raw(batch: DataFrame, root: str, source: str) -> str:
    """Add one batch to the raw zone; the same batch again replaces itself."""
    path = f"{root}/raw/{source}"
    (
        batch.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_batch_id")
        .parquet(path)
    )
    return path


def read_raw(spark: SparkSession, root: str, source: str, batch_id: int | None = None) -> DataFrame | None:
    """All batches, aligned by column name, or one, of which only its own files are opened."""
    if batch_id is not None:
        batch = read_or_none(spark, f"{root}/raw/{source}/_batch_id={batch_id}")
        return None if batch is None else batch.withColumn("_batch_id", F.lit(batch_id).cast("bigint"))
    raw = read_or_none(spark, f"{root}/raw/{source}", merge=True)
    return None if raw is None else raw.withColumn("_batch_id", F.col("_batch_id").cast("bigint"))


def highest_batch(spark: SparkSession, root: str, source: str) -> int | None:
    """Highest batch id in the raw zone, from the folder names."""
    raw = read_or_none(spark, f"{root}/raw/{source}")
    return None if raw is None else raw.agg(F.max(F.col("_batch_id").cast("bigint"))).first()[0]


def last_transaction_id(spark: SparkSession, root: str) -> int | None:
    """Highest id given out so far, where it was kept beside the table."""
    marks = read_or_none(spark, f"{root}/tables/transaction_ids")
    return None if marks is None else marks.agg(F.max("last")).first()[0]


def keep_transaction_id(spark: SparkSession, root: str, last: int) -> None:
    """Note that ids up to ``last`` are taken.  Called before they are used: a load that fails
    in between leaves a gap, never an id twice."""
    mark = spark.range(1).select(F.lit(last).cast("bigint").alias("last"))
    mark.write.mode("append").parquet(f"{root}/tables/transaction_ids")


def write_run(df: DataFrame, path: str, run: int) -> str:
    """Write ``df`` as one run of a dataset that keeps a partition per run."""
    target = f"{path}/run={run}"
    df.write.mode("overwrite").parquet(target)
    return target


def write_snapshot(df: DataFrame, path: str) -> str:
    """Write ``df`` as the next run of ``path``, so that the run it was built from stays readable."""
    runs = read_or_none(df.sparkSession, path)
    last = 0 if runs is None else runs.agg(F.max("run")).first()[0] or 0
    return write_run(df, path, last + 1)


def read_latest(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """Rows of the highest run; older runs are pruned as partitions."""
    wanted = None if schema is None else f"{schema.toDDL()}, run BIGINT"
    runs = read_or_none(spark, path, wanted)
    if runs is None:
        return None
    latest = runs.agg(F.max("run")).first()[0]
    return None if latest is None else runs.filter(F.col("run") == latest).drop("run")


def append_transactions(rows: DataFrame, root: str) -> None:
    """Append facts in month folders.

    ``rebalance`` groups rows by month into files of about the advisory size: small
    months share a task and a month with most of the rows is split over several.
    """
    day = F.col("transaction_date")
    dated = rows.withColumns({"yr": F.year(day), "mo": F.month(day)})
    dated.hint("rebalance", F.col("yr"), F.col("mo")).write.mode("append").partitionBy("yr", "mo").parquet(
        f"{root}/tables/transactions"
    )


def has_transactions(spark: SparkSession, root: str) -> bool:
    """Whether any fact was ever written; folders are looked at, not rows."""
    schema = f"{TRANSACTIONS.toDDL()}, yr INT, mo INT"
    found = read_or_none(spark, f"{root}/tables/transactions", schema=schema)
    return found is not None and bool(found.inputFiles())


def read_transactions(spark: SparkSession, root: str) -> DataFrame:
    """All facts, with the month folders as columns ``yr`` and ``mo`` to prune by."""
    schema = f"{TRANSACTIONS.toDDL()}, yr INT, mo INT"
    found = read_or_none(spark, f"{root}/tables/transactions", schema=schema)
    return spark.createDataFrame([], schema) if found is None else found


class StoredLedger:
    """The ledger tables as last written; each is opened when first asked for.

    Dimensions that were never written are the seeded ones, other tables are empty.
    ``use_marts=True`` offers the written marts to the reports, which then read no facts
    for them and are as fresh as the last ``write_marts``.
    """

    def __init__(self, spark: SparkSession, root: str, use_marts: bool = False):
        self._spark, self._root, self._use_marts = spark, root, use_marts

    def mart(self, name: str) -> DataFrame | None:
        return read_latest(self._spark, f"{self._root}/marts/{name}") if self._use_marts else None

    def _table(self, name: str, schema: StructType) -> DataFrame | None:
        return read_latest(self._spark, f"{self._root}/tables/{name}", schema)

    @cached_property
    def accounts(self) -> DataFrame:
        found = self._table("accounts", ACCOUNTS)
        return seed_dimensions(self._spark)[0] if found is None else found

    @cached_property
    def categories(self) -> DataFrame:
        found = self._table("categories", CATEGORIES)
        return seed_dimensions(self._spark)[1] if found is None else found

    @cached_property
    def subcategories(self) -> DataFrame:
        found = self._table("subcategories", SUBCATEGORIES)
        return seed_dimensions(self._spark)[2] if found is None else found

    @cached_property
    def monthly_plans(self) -> DataFrame:
        found = self._table("monthly_plans", MONTHLY_PLANS)
        return self._spark.createDataFrame([], MONTHLY_PLANS) if found is None else found

    @cached_property
    def monthly_plan_items(self) -> DataFrame:
        found = self._table("monthly_plan_items", MONTHLY_PLAN_ITEMS)
        return self._spark.createDataFrame([], MONTHLY_PLAN_ITEMS) if found is None else found

    @cached_property
    def transactions(self) -> DataFrame:
        return read_transactions(self._spark, self._root)


def jdbc_ledger(spark: SparkSession, url: str, **options: str) -> Ledger:
    """The ledger read from a database.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` to
    have the transactions read in parallel; they apply to that table alone.
    """
    ranged = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
    split = {k: options.pop(k) for k in ranged if k in options}

    def table(name: str, **more: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, dbtable=name, **options, **more).load()

    return Ledger(
        table("accounts"),
        table("categories"),
        table("subcategories"),
        table("monthly_plans"),
        table("monthly_plan_items"),
        table("transactions", **split),
    )
