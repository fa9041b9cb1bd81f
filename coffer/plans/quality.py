"""Data-quality checks: which rows fail, and one row per check with its count.

All row-level checks of a table are counted in one pass over it.  Only uniqueness
and the self-reference of transactions need a shuffle of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.functions.money import is_spend
from coffer.functions.text import null_to_blank, trim
from coffer.operators.lookup import lookup_join
from coffer.plans import marts
from coffer.schema import (
    ACCOUNT_TYPES,
    CATEGORY_TYPES,
    PAYMENT_METHODS,
    SOURCE_VALUES,
    SPENDING_TYPES,
    TRANSACTION_TYPES,
    UNIQUE_NOTE_PREFIX,
    Ledger,
)
from coffer.session import materialise


def not_null(column: str) -> Column:
    """True for rows that fail: the column is NULL."""
    return F.col(column).isNull()


def accepted_values(column: str, values: Sequence[str]) -> Column:
    """True for rows that fail; NULL passes, as ``not_null`` covers it."""
    return F.coalesce(~F.col(column).isin(*values), F.lit(False))


def expression_holds(condition: Column) -> Column:
    """True for rows that fail; an unknown outcome passes, as in SQL CHECK."""
    return F.coalesce(~condition, F.lit(False))


def failing_rows(df: DataFrame, failed: Column) -> DataFrame:
    return df.filter(failed)


def _check_row(name: str, failed: Column) -> Column:
    return F.struct(F.lit(name).alias("check_name"), F.coalesce(failed, F.lit(0)).cast("bigint").alias("failed"))


def _failures(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row with the array of all ``(check_name, failed)`` pairs, from a single pass."""
    return df.agg(F.array(*[_check_row(name, F.count_if(c)) for name, c in checks.items()]).alias("checks"))


def count_failures(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row ``(check_name, failed)`` per check."""
    return _failures(df, checks).select(F.inline("checks"))


def duplicate_keys(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Keys held by more than one row.  As in SQL UNIQUE, a key with a NULL part never clashes."""
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    complete = df.select(*named).dropna()
    return complete.groupBy(*complete.columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def _duplicates(name: str, df: DataFrame, *keys: str | Column) -> DataFrame:
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    return _row_count(name, duplicate_keys(df, columns))


def _row_count(name: str, df: DataFrame, count: Column | None = None) -> DataFrame:
    return df.agg(F.array(_check_row(name, F.count(F.lit(1)) if count is None else count)).alias("checks"))


def with_reference(
    df: DataFrame, column: str, parent: DataFrame, parent_key: str, rows: int | None = None
) -> DataFrame:
    """Add ``_has_<column>``: NULL where the value has no row in ``parent``.

    ``rows`` is the row count of ``parent`` where the caller knows it.
    """
    known = parent.select(F.col(parent_key).alias(column)).distinct().withColumn(f"_has_{column}", F.lit(True))
    return lookup_join(df, known, [column], rows=rows)


def missing_reference(column: str) -> Column:
    return F.col(column).isNotNull() & F.col(f"_has_{column}").isNull()


def dangling_links(transactions: DataFrame) -> DataFrame:
    """Linked transaction ids that do not exist, with the number of rows naming them.

    Links are counted per id first, so an id that many rows name is one row in the
    anti-join.
    """
    links = (
        transactions.filter(F.col("related_transaction_id").isNotNull())
        .groupBy(F.col("related_transaction_id").alias("linked_id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ids = transactions.select(F.col("transaction_id").alias("linked_id"))
    return links.join(ids, "linked_id", "left_anti")


def _id_checks(transactions: DataFrame, spend: Column) -> DataFrame:
    """Repeated spend ids and rows whose link names no transaction, in one shuffle by id.

    Each row tells about its own id and about the one it links to; both are summed per id
    before the shuffle.
    """
    own = F.struct(F.col("transaction_id").alias("id"), F.lit(1).alias("rows"), spend.cast("int").alias("spend"), F.lit(0).alias("links"))
    link = F.struct(F.col("related_transaction_id").alias("id"), F.lit(0).alias("rows"), F.lit(0).alias("spend"), F.lit(1).alias("links"))
    told = transactions.select(F.inline(F.array(own, link))).filter(F.col("id").isNotNull())
    by_id = told.groupBy("id").agg(*[F.sum(c).alias(c) for c in ("rows", "spend", "links")])
    return by_id.agg(
        F.array(
            _check_row(
                "relationship:transactions.related_transaction_id", F.sum(F.when(F.col("rows") == 0, F.col("links")))
            ),
            _check_row("unique:stg_expenses.id", F.count_if(F.col("spend") > 1)),
        ).alias("checks")
    )


def plan_budget_gaps(ledger: Ledger) -> DataFrame:
    """Plans whose items do not add up to the fixed budget."""
    items = ledger.monthly_plan_items.groupBy("plan_id").agg(F.sum("budgeted").alias("items_total"))
    total = F.coalesce("items_total", F.lit(0).cast("decimal(25,0)"))
    return (
        ledger.monthly_plans.join(items, "plan_id", "left")
        .select("plan_id", "plan_year", "plan_month", "fixed_budget", total.alias("items_total"))
        .filter(F.col("fixed_budget") != F.col("items_total"))
    )


def linked_transactions(
    tx: DataFrame,
    ledger: Ledger,
    note_category: str,
    plan_count: int | None = None,
    category_count: int | None = None,
) -> DataFrame:
    """Transactions with a mark for each reference that exists and for the category that needs a note."""
    noted = ledger.categories.filter(F.col("category_name") == note_category)
    note_needed = noted.select("category_id", F.lit(True).alias("_note_needed")).distinct()
    linked = with_reference(tx, "account_id", ledger.accounts, "account_id")
    linked = with_reference(linked, "plan_id", ledger.monthly_plans, "plan_id", plan_count)
    linked = with_reference(linked, "category_id", ledger.categories, "category_id", category_count)
    linked = with_reference(linked, "subcategory_id", ledger.subcategories, "subcategory_id")
    return lookup_join(linked, note_needed, ["category_id"], rows=category_count)


def transaction_checks() -> dict[str, Column]:
    """The checks that look at one row of ``linked_transactions`` at a time."""
    spend = is_spend() & F.col("transaction_date").isNotNull()
    return {
        "not_null:stg_expenses.id": spend & not_null("transaction_id"),
        "not_null:stg_expenses.expense_date": spend & not_null("transaction_date"),
        "not_null:stg_expenses.amount": spend & not_null("amount"),
        "not_null:stg_expenses.category_id": spend & not_null("category_id"),
        "accepted:transactions.transaction_type": accepted_values("transaction_type", TRANSACTION_TYPES),
        "accepted:transactions.spending_type": accepted_values("spending_type", SPENDING_TYPES),
        "accepted:transactions.payment_method": accepted_values("payment_method", PAYMENT_METHODS),
        "accepted:transactions.source_data": accepted_values("source_data", SOURCE_VALUES),
        "expression:transactions.amount_positive": expression_holds(F.col("amount") > 0),
        "relationship:transactions.account_id": missing_reference("account_id"),
        "relationship:transactions.plan_id": missing_reference("plan_id"),
        "relationship:transactions.category_id": missing_reference("category_id"),
        "relationship:transactions.subcategory_id": missing_reference("subcategory_id"),
        "note_required:transactions.note": F.coalesce("_note_needed", F.lit(False))
        & (null_to_blank(trim(F.col("note"))) == ""),
    }


def dq_report(ledger: Ledger, note_category: str = "Miscellaneous") -> DataFrame:
    """One row per check: ``(check_name, failed)``.

    ``note_category`` is the category whose transactions need a note.
    """
    # The three marts are sums of one frame of groups, which is written: it stays small.
    groups = materialise(marts.spend_groups(marts.spend_facts(ledger)), "spend_groups")
    by_month = groups.groupBy("yr", "mo").agg(F.sum("spent").alias("total_spend"))
    breakdown = marts.category_groups(groups, ledger)
    merchants = marts.merchants_of(groups, ledger)
    tx, plans, items = ledger.transactions, ledger.monthly_plans, ledger.monthly_plan_items

    # Every lookup table is counted once.
    plan_count, category_count = plans.count(), ledger.categories.count()
    linked = linked_transactions(tx, ledger, note_category, plan_count, category_count)
    item_links = with_reference(items, "plan_id", plans, "plan_id", plan_count)
    item_links = with_reference(item_links, "category_id", ledger.categories, "category_id", category_count)
    sub_links = with_reference(ledger.subcategories, "category_id", ledger.categories, "category_id", category_count)

    spend = is_spend() & F.col("transaction_date").isNotNull()
    parts = [
        _failures(
            by_month, {f"not_null:mart_monthly_summary.{c}": not_null(c) for c in ("yr", "mo", "total_spend")}
        ),
        _failures(
            breakdown,
            {f"not_null:mart_category_breakdown.{c}": not_null(c) for c in ("yr", "category_name", "total_spend")},
        ),
        _failures(
            merchants, {f"not_null:mart_top_merchants.{c}": not_null(c) for c in ("merchant", "total_spend")}
        ),
        _failures(linked, transaction_checks()),
        _failures(ledger.accounts, {"accepted:accounts.account_type": accepted_values("account_type", ACCOUNT_TYPES)}),
        _failures(
            ledger.categories, {"accepted:categories.category_type": accepted_values("category_type", CATEGORY_TYPES)}
        ),
        _failures(
            plans, {"expression:monthly_plans.plan_month": expression_holds(F.col("plan_month").between(1, 12))}
        ),
        _failures(
            item_links,
            {
                "relationship:monthly_plan_items.plan_id": missing_reference("plan_id"),
                "relationship:monthly_plan_items.category_id": missing_reference("category_id"),
            },
        ),
        _failures(sub_links, {"relationship:subcategories.category_id": missing_reference("category_id")}),
        _id_checks(tx, spend),
        _duplicates("unique:categories.category_name", ledger.categories, "category_name"),
        _duplicates(
            "unique:subcategories.category_id_name", ledger.subcategories, "category_id", "subcategory_name"
        ),
        _duplicates("unique:monthly_plans.year_month", plans, "plan_year", "plan_month"),
        _duplicates("unique:monthly_plan_items.plan_category", items, "plan_id", "category_id"),
        _duplicates(
            "unique:transactions.key",
            tx,
            "transaction_date",
            "account_id",
            "transaction_type",
            "spending_type",
            "amount",
            "payment_method",
            F.substring("note", 1, UNIQUE_NOTE_PREFIX),
        ),
        _row_count("consistent:monthly_plans.fixed_budget", plan_budget_gaps(ledger)),
    ]
    # Each part is one row, read as a scalar subquery: they run side by side.
    checks = F.flatten(F.array(*[part.scalar() for part in parts]))
    return tx.sparkSession.range(1).select(F.inline(checks))
