"""Marts kept up by deltas: mergeable sums of spend by month and keys.

Every load writes the partial sums of its own facts, in the folders of the months it adds to.
Sums, counts and first and last days of several loads merge into those of all facts, whatever
order months arrive in, so late rows change the months they belong to and nothing else is
done again.  Categories are part of the key, which keeps their distinct count exact.

Marts read these sums: at most months x categories x subcategories x spending types rows per
load, however many facts there are.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.functions.money import sum_where
from coffer.operators.lookup import lookup_join
from coffer.plans import marts
from coffer.schema import Ledger
from coffer.session import materialise
from coffer.sources.zones import read_or_none

KEY = ["yr", "mo", "category_id", "subcategory_id", "spending_type"]

_SCHEMA = (
    "category_id INT, subcategory_id INT, spending_type STRING, n BIGINT, spent DECIMAL(25,0), "
    "regretted DECIMAL(25,0), first_day DATE, last_day DATE, yr INT, mo INT, load STRING"
)


def states_of(facts: DataFrame) -> DataFrame:
    """Partial sums of the spend rows among ``facts``."""
    spend = marts.spend_facts(SimpleNamespace(transactions=facts))
    return spend.groupBy(*KEY).agg(
        F.count("id").alias("n"),
        F.sum("amount").cast("decimal(25,0)").alias("spent"),
        sum_where(F.col("is_regretted")).cast("decimal(25,0)").alias("regretted"),
        F.min("expense_date").alias("first_day"),
        F.max("expense_date").alias("last_day"),
    )


def _path(root: str) -> str:
    return f"{root}/marts/spend_states"


def read_states(spark: SparkSession, root: str) -> DataFrame | None:
    """Partial sums of all loads, or None where a ledger keeps none."""
    return read_or_none(spark, _path(root), _SCHEMA)


def _commits(spark: SparkSession, root: str) -> DataFrame | None:
    return read_or_none(spark, f"{root}/marts/spend_commits", "load STRING, kept BOOLEAN")


def _write(facts: DataFrame, root: str, load: str, mode: str) -> None:
    (
        states_of(facts)
        .withColumn("load", F.lit(load))
        .coalesce(1)  # a row per month and group
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy("load", "yr", "mo")
        .parquet(_path(root))
    )


def append_states(facts: DataFrame, root: str, load: str) -> None:
    """Add the sums of a load's facts.  They count from its ``commit`` on."""
    _write(facts, root, load, "dynamic")


def commit(spark: SparkSession, root: str, load: str, kept: bool = True) -> None:
    """Say that the facts of a load have been appended, or that they never will be."""
    spark.range(1).select(F.lit(load).alias("load"), F.lit(kept).alias("kept")).coalesce(1).write.mode("append").parquet(
        f"{root}/marts/spend_commits"
    )


def add(facts: DataFrame, root: str, load: str) -> None:
    """Sums of facts that are in the ledger already, once."""
    append_states(facts, root, load)
    commit(facts.sparkSession, root, load)


def load_name(run: int, first_id: int) -> str:
    """Name of a load: no two appends begin with one transaction id."""
    return f"run{run}-{first_id}"


def settle(ledger: Ledger, root: str) -> None:
    """Decide on loads that stopped between writing their sums and saying that they were done.

    Their facts are there if their first transaction is.  There are few such loads, mostly none.
    """
    spark = ledger.accounts.sparkSession
    states, done = read_states(spark, root), _commits(spark, root)
    if states is None:
        return
    open_loads = states.select("load").distinct()
    if done is not None:
        open_loads = open_loads.join(done, "load", "left_anti")
    for (load,) in open_loads.collect():
        first = ledger.transactions.filter(F.col("transaction_id") == int(load.rpartition("-")[2]))
        commit(spark, root, load, kept=not first.isEmpty())


def build_states(ledger: Ledger, root: str) -> None:
    """The sums of a ledger that has facts already, or fewer rows for one that has many loads."""
    last = ledger.transactions.agg(F.max("transaction_id")).first()[0] or 0
    load = f"all-{last}"
    _write(ledger.transactions, root, load, "static")
    commit(ledger.accounts.sparkSession, root, load)


def merged_states(spark: SparkSession, root: str, months: list[int] | None = None) -> DataFrame | None:
    """One row per month and group over all loads, or for months given as ``12 * yr + mo``."""
    states, done = read_states(spark, root), _commits(spark, root)
    if states is None or done is None:
        return None
    # A row per load.
    kept = materialise(done.filter("kept").select("load").distinct(), "loads")
    states = lookup_join(states, kept, ["load"], how="left_semi")
    if months is not None:
        states = states.filter((F.col("yr") * 12 + F.col("mo")).isin(months))
    return states.groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in ("n", "spent", "regretted")],
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    )


def monthly_summary(states: DataFrame) -> DataFrame:
    """The monthly summary from merged sums."""
    money = lambda c, kind=None: F.sum(c if kind is None else F.when(F.col("spending_type") == kind, F.col(c)).otherwise(0))
    return states.groupBy("yr", "mo").agg(
        F.sum("n").alias("transaction_count"),
        money("spent").cast("decimal(25,0)").alias("total_spend"),
        money("spent", "fixed").cast("decimal(25,0)").alias("fixed_spend"),
        money("spent", "extra").cast("decimal(25,0)").alias("extra_spend"),
        money("regretted").cast("decimal(25,0)").alias("regretted_spend"),
        F.countDistinct("category_id").alias("categories_used"),
    )


def marts_of(states: DataFrame, ledger: Ledger) -> dict[str, DataFrame]:
    """The three marts from merged sums."""
    groups = states.drop("regretted")
    return {
        "mart_monthly_summary": monthly_summary(states),
        "mart_category_breakdown": marts.with_shares(marts.category_groups(groups, ledger)),
        "mart_top_merchants": marts.ranked_merchants(marts.merchants_of(groups, ledger), ledger),
    }


def differing_months(ledger: Ledger, root: str) -> DataFrame:
    """Months in which the sums kept and those of all facts differ: ``yr, mo, kept, found``.

    Reads the facts; for an audit now and then, after which ``build_states`` sets things right.
    """
    kept = merged_states(ledger.accounts.sparkSession, root)
    total = lambda states, name: states.groupBy("yr", "mo").agg(
        F.struct(F.sum("n").alias("n"), F.sum("spent").cast("decimal(38,0)").alias("spent")).alias(name)
    )
    both = total(kept, "kept").join(total(states_of(ledger.transactions), "found"), ["yr", "mo"], "full")
    return both.filter(~F.col("kept").eqNullSafe(F.col("found")))
