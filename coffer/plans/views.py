"""Ledger views.

Facts are summed by their keys first and joined to the lookup tables afterwards, so
the only shuffle carries partial sums and no join touches single facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.functions.money import cash_effect, is_spend, sum_where, zero
from coffer.schema import Ledger


def account_cash_balance(ledger: Ledger) -> DataFrame:
    """Cash per account; accounts without transactions show 0."""
    moved = ledger.transactions.groupBy("account_id").agg(F.sum(cash_effect()).alias("moved"))
    return ledger.accounts.join(moved, "account_id", "left").select(
        "account_id", "account_name", "account_type", F.coalesce("moved", zero()).alias("cash_balance")
    )


def credit_outstanding(ledger: Ledger) -> DataFrame:
    """Purchases minus payments per credit account."""
    kind = F.col("transaction_type")
    moved = (
        ledger.transactions.filter(kind.isin("credit_purchase", "credit_payment"))
        .groupBy("account_id")
        .agg(
            sum_where(kind == "credit_purchase").alias("purchased"),
            sum_where(kind == "credit_payment").alias("paid"),
        )
    )
    cards = ledger.accounts.filter(F.col("account_type") == "credit")
    purchased, paid = F.coalesce("purchased", zero()), F.coalesce("paid", zero())
    return cards.join(moved, "account_id", "left").select(
        "account_id",
        "account_name",
        purchased.alias("total_purchased"),
        paid.alias("total_paid"),
        (purchased - paid).alias("outstanding"),
    )


def monthly_expense_summary(ledger: Ledger) -> DataFrame:
    """Spend per month, category, subcategory and spending type."""
    by_key = (
        ledger.transactions.filter(is_spend())
        .groupBy(
            F.year("transaction_date").alias("yr"),
            F.month("transaction_date").alias("mo"),
            "category_id",
            "subcategory_id",
            "spending_type",
        )
        .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("spent"))
    )
    categories = ledger.categories.select("category_id", "category_name", "category_type")
    subcategories = ledger.subcategories.select("subcategory_id", "subcategory_name")
    named = by_key.join(categories, "category_id", "left").join(subcategories, "subcategory_id", "left")
    return named.groupBy("yr", "mo", "category_name", "category_type", "subcategory_name", "spending_type").agg(
        F.sum("n").alias("tx_count"), F.sum("spent").cast("decimal(25,0)").alias("total_amount")
    )


def budget_vs_actual(ledger: Ledger) -> DataFrame:
    """Budget, spend and remainder per plan item; items without spend are kept."""
    actual = (
        ledger.transactions.filter(is_spend() & F.col("plan_id").isNotNull() & F.col("category_id").isNotNull())
        .groupBy("plan_id", "category_id")
        .agg(F.sum("amount").alias("spent"))
    )
    plans = ledger.monthly_plans.select(
        "plan_id", F.col("plan_year").cast("int").alias("yr"), F.col("plan_month").cast("int").alias("mo")
    )
    categories = ledger.categories.select("category_id", "category_name")
    items = ledger.monthly_plan_items.select("plan_id", "category_id", "budgeted")
    planned = items.join(plans, "plan_id").join(categories, "category_id")
    spent = F.coalesce("actual_spent", zero())
    return (
        planned.join(actual, ["plan_id", "category_id"], "left")
        .groupBy("yr", "mo", "category_name", "budgeted")
        .agg(F.sum("spent").cast("decimal(25,0)").alias("actual_spent"))
        .select(
            "yr",
            "mo",
            "category_name",
            "budgeted",
            spent.alias("actual_spent"),
            (F.col("budgeted") - spent).alias("remaining"),
        )
    )
