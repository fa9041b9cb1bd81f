"""Quality checks batch by batch, as states that merge.

A batch is checked once, when it is loaded, and only its own rows are read.  Its state is a row
per check (rows looked at, rows that failed) and one with sums of amounts and a sketch of
natural keys.  States of all batches merge into the report on all rows, and a batch can be
held against the earlier ones.  References are judged by the lookup tables as they were then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.plans import quality
from coffer.plans.loading import natural_key
from coffer.schema import Ledger
from coffer.session import materialise
from coffer.sources.zones import read_or_none

_CHECKS = "check_name STRING, failed BIGINT, checked BIGINT, batch BIGINT"
_TOTALS = (
    "n_rows BIGINT, amount_sum DECIMAL(38,0), amount_squares DECIMAL(38,0), first_day DATE, last_day DATE, "
    "keys BINARY, batch BIGINT"
)

# Standard errors between a batch and those before from which it counts as another.
FAR = 3.0


def check_batch(facts: DataFrame, ledger: Ledger, root: str, batch: int, note_category: str = "Miscellaneous") -> None:
    """Write the state of a batch; the same batch again replaces its own."""
    linked = quality.linked_transactions(facts, ledger, note_category)
    checks = quality.transaction_checks()
    amount = F.col("amount").cast("decimal(19,0)")
    key = F.concat_ws("\x1f", *[k.cast("string") for k in natural_key(linked)])
    found = linked.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(amount).cast("decimal(38,0)").alias("amount_sum"),
        F.sum(amount * amount).cast("decimal(38,0)").alias("amount_squares"),
        F.min("transaction_date").alias("first_day"),
        F.max("transaction_date").alias("last_day"),
        F.hll_sketch_agg(key).alias("keys"),
        F.array(
            *[F.struct(F.lit(name).alias("check_name"), F.count_if(c).alias("failed")) for name, c in checks.items()]
        ).alias("checks"),
    )
    found = materialise(found, "batch_state")
    rows = found.select("n_rows", F.inline("checks")).select("check_name", "failed", F.col("n_rows").alias("checked"))
    rows.write.mode("overwrite").parquet(f"{root}/checks/rows/batch={batch}")
    found.drop("checks").write.mode("overwrite").parquet(f"{root}/checks/totals/batch={batch}")


def checks_of(spark: SparkSession, root: str) -> DataFrame:
    """A row per check and batch."""
    found = read_or_none(spark, f"{root}/checks/rows", _CHECKS)
    return spark.createDataFrame([], _CHECKS) if found is None else found


def totals_of(spark: SparkSession, root: str) -> DataFrame:
    """A row per batch."""
    found = read_or_none(spark, f"{root}/checks/totals", _TOTALS)
    return spark.createDataFrame([], _TOTALS) if found is None else found


def merged_report(spark: SparkSession, root: str) -> DataFrame:
    """``check_name, failed, checked`` over all batches."""
    return checks_of(spark, root).groupBy("check_name").agg(F.sum("failed").alias("failed"), F.sum("checked").alias("checked"))


def merged_totals(spark: SparkSession, root: str) -> DataFrame:
    """Rows, days, mean and spread of amounts and about how many natural keys, over all batches."""
    n, s = F.sum("n_rows"), F.sum("amount_sum").cast("double")
    squares = F.sum("amount_squares").cast("double")
    return totals_of(spark, root).agg(
        n.alias("n_rows"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
        (s / n).alias("mean_amount"),
        F.sqrt(F.greatest(squares / n - (s / n) * (s / n), F.lit(0.0))).alias("deviation"),
        F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("about_keys"),
    )


def drift(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """Each check's rate in a batch against that of the batches before it, and how far they are apart.

    ``z`` counts standard errors of the difference of two rates; NULL where neither side ever or
    always fails, or where one side has no rows.  ``drifted`` marks those beyond ``FAR``.
    """
    rows = checks_of(spark, root).filter(F.col("batch") <= batch)
    now, own = F.col("batch") == batch, lambda c: F.sum(F.when(F.col("batch") == batch, F.col(c)))
    earlier = lambda c: F.sum(F.when(~now, F.col(c)))
    found = rows.groupBy("check_name").agg(
        own("failed").alias("failed"),
        own("checked").alias("checked"),
        F.coalesce(earlier("failed"), F.lit(0)).alias("failed_before"),
        F.coalesce(earlier("checked"), F.lit(0)).alias("checked_before"),
    )
    rate, before = F.try_divide("failed", "checked"), F.try_divide("failed_before", "checked_before")
    both = F.try_divide(F.col("failed") + F.col("failed_before"), F.col("checked") + F.col("checked_before"))
    error = F.sqrt(both * (1 - both) * (F.try_divide(F.lit(1), "checked") + F.try_divide(F.lit(1), "checked_before")))
    z = F.when(error > 0, (rate - before) / error)
    return found.filter("checked IS NOT NULL").select(
        "*", F.round(z, 6).alias("z"), F.coalesce(F.abs(z) > FAR, F.lit(False)).alias("drifted")
    )
