"""Staging model and marts over the spend rows of the ledger."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coffer.functions.money import is_spend, sum_where
from coffer.operators.lookup import lookup_join
from coffer.operators.ranking import rank_desc
from coffer.schema import MONEY, SPENDING_TYPES, Ledger


def months_between(rows: DataFrame, day: str, start: date | None, end: date | None) -> DataFrame:
    """Rows of the months from ``start`` to ``end``, both included; ``None`` leaves an end open.

    The bounds are on the date itself, which the scan can use, and on the month folders
    where ``rows`` has them, so that others are not read.
    """
    folders = {"yr", "mo"} <= set(rows.columns)
    month = F.col("yr") * 12 + F.col("mo") if folders else None
    if start:
        rows = rows.filter(F.col(day) >= F.lit(start.replace(day=1)))
        if folders:
            rows = rows.filter((F.col("yr") >= start.year) & (month >= start.year * 12 + start.month))
    if end:
        after = date(end.year + end.month // 12, end.month % 12 + 1, 1)
        rows = rows.filter(F.col(day) < F.lit(after))
        if folders:
            rows = rows.filter((F.col("yr") <= end.year) & (month <= end.year * 12 + end.month))
    return rows


def spend_facts(ledger: Ledger, start: date | None = None, end: date | None = None) -> DataFrame:
    """Dated spend rows with their keys, before any name is looked up; those of a range of months."""
    day = F.col("transaction_date").cast("date")
    rows = months_between(ledger.transactions, "transaction_date", start, end)
    return rows.filter(is_spend() & F.col("transaction_date").isNotNull()).select(
        F.col("transaction_id").alias("id"),
        day.alias("expense_date"),
        F.year(day).alias("yr"),
        F.month(day).alias("mo"),
        F.col("amount").cast(MONEY).alias("amount"),
        "account_id",
        "transaction_type",
        "spending_type",
        "category_id",
        "subcategory_id",
        "payment_method",
        F.col("note").alias("description"),
        "is_regretted",
        F.col("source_data").alias("source"),
    )


def spend_groups(facts: DataFrame) -> DataFrame:
    """Spend summed by month and keys, names not yet looked up."""
    return facts.groupBy("yr", "mo", "category_id", "subcategory_id", "spending_type").agg(
        F.count("id").alias("n"),
        F.sum("amount").alias("spent"),
        F.min("expense_date").alias("first_day"),
        F.max("expense_date").alias("last_day"),
    )


def _category_names(ledger: Ledger) -> DataFrame:
    return ledger.categories.select("category_id", "category_name")


def _subcategory_names(ledger: Ledger) -> DataFrame:
    return ledger.subcategories.select("subcategory_id", "subcategory_name")


def _named(groups: DataFrame, ledger: Ledger) -> DataFrame:
    """Add names to summed groups: few rows, so Spark may choose any join."""
    return groups.join(_category_names(ledger), "category_id", "left").join(
        _subcategory_names(ledger), "subcategory_id", "left"
    )


def stg_expenses(ledger: Ledger) -> DataFrame:
    """Spend rows with account, category and subcategory names."""
    accounts = ledger.accounts.select("account_id", "account_name", "account_type", "currency")
    facts = lookup_join(spend_facts(ledger), accounts, ["account_id"], salt_by=["id"])
    facts = lookup_join(facts, _category_names(ledger), ["category_id"], salt_by=["id"])
    facts = lookup_join(facts, _subcategory_names(ledger), ["subcategory_id"], salt_by=["id"])
    return facts.select(
        "id",
        "expense_date",
        "yr",
        "mo",
        "amount",
        "account_name",
        "account_type",
        "currency",
        "transaction_type",
        "spending_type",
        "category_id",
        "category_name",
        "subcategory_id",
        "subcategory_name",
        "payment_method",
        "description",
        "is_regretted",
        "source",
    )


def mart_monthly_summary(ledger: Ledger, start: date | None = None, end: date | None = None) -> DataFrame:
    """Spend per month.  Needs no names, so no lookup table is read."""
    return (
        spend_facts(ledger, start, end)
        .groupBy("yr", "mo")
        .agg(
            F.count("id").alias("transaction_count"),
            F.sum("amount").alias("total_spend"),
            sum_where(F.col("spending_type") == "fixed").alias("fixed_spend"),
            sum_where(F.col("spending_type") == "extra").alias("extra_spend"),
            sum_where(F.col("is_regretted")).alias("regretted_spend"),
            F.countDistinct("category_id").alias("categories_used"),
        )
    )


def category_groups(groups: DataFrame, ledger: Ledger) -> DataFrame:
    """Spend per month and category group, from ``spend_groups``."""
    return (
        _named(groups, ledger)
        .groupBy("yr", "mo", "category_id", "category_name", "subcategory_name", "spending_type")
        .agg(F.sum("n").alias("tx_count"), F.sum("spent").cast("decimal(25,0)").alias("total_spend"))
    )


def mart_category_breakdown(ledger: Ledger, start: date | None = None, end: date | None = None) -> DataFrame:
    """Spend per month and category group, with its share of the month.

    The share window runs on summed groups, never on single facts: a month holds
    at most categories x subcategories x spending types of them.
    """
    return with_shares(category_groups(spend_groups(spend_facts(ledger, start, end)), ledger))


def with_shares(groups: DataFrame) -> DataFrame:
    """Category groups with their share of the month in per cent."""
    month_total = F.sum("total_spend").over(Window.partitionBy("yr", "mo")).cast("decimal(25,0)")
    share = F.col("total_spend").cast("double") * 100.0 / month_total.cast("double")
    return groups.withColumn("pct_of_month", F.round(share, 2))


def merchants_of(groups: DataFrame, ledger: Ledger) -> DataFrame:
    """Spend per merchant (subcategory, or category where there is none), from ``spend_groups``."""
    by_key = groups.groupBy("category_id", "subcategory_id", "spending_type").agg(
        F.sum("n").alias("n"),
        F.sum("spent").alias("spent"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    )
    return (
        _named(by_key, ledger)
        .groupBy(F.coalesce("subcategory_name", "category_name").alias("merchant"), "category_name", "spending_type")
        .agg(
            F.sum("n").alias("visit_count"),
            F.sum("spent").cast("decimal(25,0)").alias("total_spend"),
            F.min("first_day").alias("first_seen"),
            F.max("last_day").alias("last_seen"),
        )
    )


def merchant_groups(ledger: Ledger) -> DataFrame:
    """Spend per merchant over all months."""
    return merchants_of(spend_groups(spend_facts(ledger)), ledger)


def mart_top_merchants(ledger: Ledger) -> DataFrame:
    """Merchant groups ranked by spend.

    There are at most (subcategories + 1) x (categories + 1) x spending types
    groups; the two lookup tables are counted to choose between a one-task window and
    the distributed rank.
    """
    return ranked_merchants(merchant_groups(ledger), ledger)


def ranked_merchants(merchants: DataFrame, ledger: Ledger) -> DataFrame:
    subcategories, categories = ledger.subcategories.count(), ledger.categories.count()
    rows = (subcategories + 1) * (categories + 1) * (len(SPENDING_TYPES) + 1)
    return rank_desc(merchants, "total_spend", "spend_rank", rows=rows)
