"""Small ledgers for tests."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from coffer import schema
from coffer.schema import Ledger

FOOD, HOUSING, TRANSPORT = 1, 2, 3
RENT, HOUSING_OTHERS, TRANSPORT_OTHERS = 5, 9, 13


def tx(i, day, amount, kind="expense", account=2, plan=None, category=None, sub=None, spending=None, pay=None,
       note=None, regret=False, related=None, source="python"):
    return (i, date.fromisoformat(day), account, plan, category, sub, kind, spending, Decimal(amount), pay, note,
            related, regret, source)


def ledger(spark, transactions=(), plans=(), items=()):
    accounts, categories, subcategories = schema.seed_dimensions(spark)
    money = lambda v: Decimal(v)
    plan_rows = [(i, y, m, money(b), money(s), n) for i, y, m, b, s, n in plans]
    item_rows = [(i, p, c, money(b), n) for i, p, c, b, n in items]
    return Ledger(
        accounts,
        categories,
        subcategories,
        spark.createDataFrame(plan_rows, schema.MONTHLY_PLANS),
        spark.createDataFrame(item_rows, schema.MONTHLY_PLAN_ITEMS),
        spark.createDataFrame(list(transactions), schema.TRANSACTIONS),
    )
