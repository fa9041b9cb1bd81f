"""Report frames behind the dashboard: latest figures, ranges, trends, pivots.

All inputs are marts: the written ones where the ledger offers them
(``StoredLedger(..., use_marts=True)``), otherwise planned from the facts.  Windows over months are left without partition keys: a frame
with one row per calendar month is small whatever the number of transactions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coffer.functions.dates import MONTH_NAMES, first_of_month, month_label, month_number
from coffer.plans import marts
from coffer.schema import Ledger


def _by_month():
    return Window.orderBy("yr", "mo")


def _mart(ledger: Ledger, plan: Callable[..., DataFrame], start: date | None = None, end: date | None = None) -> DataFrame:
    """Months of the mart as last written, or of its plan, which then reads no other month."""
    stored = getattr(ledger, "mart", None)
    found = stored(plan.__name__) if stored else None
    if found is None:
        return plan(ledger, start, end)
    return in_months(found, start, end) if start and end else found


def _latest_day(ledger: Ledger) -> date | None:
    """Last day with spend: one column of the facts, and none of the marts."""
    return marts.spend_facts(ledger).agg(F.max("expense_date")).first()[0]


def default_range(today: date, years: int = 1) -> tuple[date, date]:
    """Range shown at first: from this month ``years`` years ago until today."""
    return date(today.year - years, today.month, 1), today


def in_months(mart: DataFrame, start: date, end: date) -> DataFrame:
    """Rows of the months from ``start`` to ``end``, both included."""
    low, high = start.year * 12 + start.month, end.year * 12 + end.month
    return mart.filter(month_number(F.col("yr"), F.col("mo")).between(low, high))


def _latest_month(ledger: Ledger, plan: Callable[..., DataFrame]) -> DataFrame:
    """The mart as last written, or its plan over the latest month with spend."""
    if getattr(ledger, "mart", lambda name: None)(plan.__name__) is not None:
        return _mart(ledger, plan)
    day = _latest_day(ledger)
    return _mart(ledger, plan, day, day)


def kpi_latest_month(ledger: Ledger) -> DataFrame:
    mart = _latest_month(ledger, marts.mart_monthly_summary).select("yr", "mo", "total_spend", "transaction_count")
    return mart.orderBy(F.desc("yr"), F.desc("mo")).limit(1)


def kpi_top_category(ledger: Ledger) -> DataFrame:
    """Highest single group of the latest month; ties go to the first name."""
    mart = _latest_month(ledger, marts.mart_category_breakdown)
    order = [F.desc("yr"), F.desc("mo"), F.desc("total_spend"), F.asc_nulls_first("category_name")]
    return mart.orderBy(*order).limit(1).select("category_name", "total_spend")


def kpi_latest_date(ledger: Ledger) -> DataFrame:
    """Latest ``last_seen`` of all merchants, which is the latest spend date."""
    return marts.spend_facts(ledger).agg(F.max("expense_date").alias("latest"))


def overview_monthly(ledger: Ledger, start: date, end: date) -> DataFrame:
    """Months of the range with label, first day and running total from its start."""
    running = _by_month().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    yr, mo = F.col("yr"), F.col("mo")
    return _mart(ledger, marts.mart_monthly_summary, start, end).select(
        "yr",
        "mo",
        "total_spend",
        "fixed_spend",
        "extra_spend",
        "transaction_count",
        month_label(yr, mo).alias("month_label"),
        first_of_month(yr, mo).alias("month_date"),
        F.sum("total_spend").over(running).cast("decimal(25,0)").alias("cumulative_spend"),
    )


def overview_table(ledger: Ledger, start: date, end: date) -> DataFrame:
    """The overview as displayed: renamed columns, amounts with thousands separators."""
    rows = overview_monthly(ledger, start, end)
    return rows.select(
        F.col("month_label").alias("Month"),
        F.format_number("total_spend", 0).alias("Total"),
        F.format_number("fixed_spend", 0).alias("Fixed"),
        F.format_number("extra_spend", 0).alias("Extra"),
        F.col("transaction_count").alias("Transactions"),
    )


def category_detail(ledger: Ledger, start: date, end: date) -> DataFrame:
    mart = _mart(ledger, marts.mart_category_breakdown, start, end)
    return mart.select(
        "yr",
        "mo",
        "category_name",
        "spending_type",
        "tx_count",
        "total_spend",
        "pct_of_month",
        month_label(F.col("yr"), F.col("mo")).alias("month_label"),
    )


def category_totals(ledger: Ledger, start: date, end: date) -> DataFrame:
    """Spend per named category over the range and its share; nameless rows are left out."""
    detail = _category_months(ledger, start, end)
    totals = detail.groupBy("category_name").agg(F.sum("total_spend").cast("decimal(25,0)").alias("total_spend"))
    overall = detail.agg(F.sum("total_spend").cast("double").alias("overall")).scalar()
    return totals.withColumn("share", F.round(F.col("total_spend").cast("double") / overall, 6))


def category_mom(ledger: Ledger, start: date, end: date) -> DataFrame:
    """Spend per month and named category."""
    detail = _category_months(ledger, start, end)
    return detail.withColumn("month_label", month_label(F.col("yr"), F.col("mo")))


def _category_months(ledger: Ledger, start: date, end: date) -> DataFrame:
    """Month and category sums; the share of month is not needed, so it is not computed."""
    facts = marts.spend_facts(ledger, start, end)
    by_key = facts.groupBy("yr", "mo", "category_id").agg(F.sum("amount").alias("spent"))
    names = ledger.categories.select("category_id", "category_name")
    named = by_key.join(names, "category_id").filter(F.col("category_name").isNotNull())
    return named.groupBy("yr", "mo", "category_name").agg(
        F.sum("spent").cast("decimal(25,0)").alias("total_spend")
    )


def month_order(ledger: Ledger, start: date, end: date) -> DataFrame:
    """Month labels of the range in calendar order."""
    months = marts.spend_facts(ledger, start, end).select("yr", "mo").distinct()
    return months.withColumn("month_label", month_label(F.col("yr"), F.col("mo"))).orderBy("yr", "mo")


def merchants_in_range(ledger: Ledger, first: date, last: date) -> DataFrame:
    """Whole-history merchant groups whose last visit falls in the range."""
    stored = getattr(ledger, "mart", None)
    found = stored("mart_top_merchants") if stored else None
    groups = marts.merchant_groups(ledger) if found is None else found.drop("spend_rank")
    return groups.filter(F.col("last_seen").between(F.lit(first), F.lit(last)))


def merchants_top_n(
    ledger: Ledger, first: date, last: date, categories: Sequence[str] | None = None, n: int = 10
) -> DataFrame:
    """The ``n`` merchants with the highest spend among the chosen categories."""
    rows = merchants_in_range(ledger, first, last)
    name = F.col("category_name")
    rows = rows.filter(name.isNotNull() if categories is None else name.isin(*categories))
    order = [F.desc("total_spend"), "merchant", "category_name", F.asc_nulls_first("spending_type")]
    return rows.orderBy(*order).limit(n)


def merchant_categories(ledger: Ledger, first: date, last: date) -> DataFrame:
    """Choices of the category filter, sorted."""
    rows = merchants_in_range(ledger, first, last).filter(F.col("category_name").isNotNull())
    return rows.select("category_name").distinct().orderBy("category_name")


def trend_rolling(ledger: Ledger, start: date, end: date) -> DataFrame:
    """Months of the range with the mean of the last three rows (not calendar months)."""
    last_three = _by_month().rowsBetween(-2, Window.currentRow)
    yr, mo = F.col("yr"), F.col("mo")
    return _mart(ledger, marts.mart_monthly_summary, start, end).select(
        "yr",
        "mo",
        "total_spend",
        "transaction_count",
        first_of_month(yr, mo).alias("month_date"),
        month_label(yr, mo).alias("month_label"),
        F.round(F.avg(F.col("total_spend").cast("double")).over(last_three), 4).alias("rolling_3mo"),
        yr.cast("string").alias("yr_str"),
    )


def yoy_comparison(ledger: Ledger, start: date, end: date) -> DataFrame:
    """Month rows with one column per year of the range."""
    years = list(range(start.year, end.year + 1))
    mart = _mart(ledger, marts.mart_monthly_summary, start, end)
    wide = mart.groupBy("mo").pivot("yr", years).agg(F.sum("total_spend").cast("decimal(25,0)"))
    return wide.withColumnsRenamed({str(y): f"y{y}" for y in years})


def spend_heatmap(ledger: Ledger, start: date, end: date) -> DataFrame:
    """Year rows with one column per month, Jan to Dec."""
    mart = _mart(ledger, marts.mart_monthly_summary, start, end)
    wide = mart.groupBy("yr").pivot("mo", list(range(1, 13))).agg(F.sum("total_spend").cast("decimal(25,0)"))
    return wide.withColumnsRenamed({str(i): name for i, name in enumerate(MONTH_NAMES, 1)})
