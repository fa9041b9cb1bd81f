"""Ledger rules on amounts: the stored amount is positive, the type gives the sign."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coffer.schema import CASH_IN_TYPES, CASH_OUT_TYPES, MONEY, SPEND_TYPES


def zero() -> Column:
    return F.lit(0).cast(MONEY)


def is_spend() -> Column:
    return F.col("transaction_type").isin(*SPEND_TYPES)


def cash_effect() -> Column:
    """Change of the cash balance; a purchase on credit moves no cash."""
    kind, amount = F.col("transaction_type"), F.col("amount")
    return F.when(kind.isin(*CASH_IN_TYPES), amount).when(kind.isin(*CASH_OUT_TYPES), -amount).otherwise(zero())


def sum_where(condition: Column, amount: Column | None = None) -> Column:
    """Sum of the amounts that meet ``condition``; 0 for a group without any."""
    amount = F.col("amount") if amount is None else amount
    return F.sum(F.when(condition, amount).otherwise(zero()))
