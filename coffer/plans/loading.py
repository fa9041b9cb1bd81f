"""Loads: cleaned rows into transactions, plan sheets into plans and plan items."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coffer.functions.dates import parse_date
from coffer.functions.numbers import to_number, whole_amount, whole_number
from coffer.functions.text import ROW_ORDER, blank_to_null, fold, is_true, lower_headers, null_to_blank, trim
from coffer.operators.dedupe import keep_first, keep_last
from coffer.operators.lookup import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    lookup_join,
    measured,
    plan_of_month,
    resolve_name,
)
from coffer.operators.ranking import ONE_TASK_ROWS, number_rows
from coffer.schema import (
    MONEY,
    PAYMENT_METHODS,
    SPENDING_TYPES,
    TRANSACTION_TYPES,
    UNIQUE_NOTE_PREFIX,
    Ledger,
)
from coffer.session import materialise

NATURAL_KEY = ("transaction_date", "amount", "transaction_type", "spending_type", "payment_method", "note")
UNIQUE_KEY = ("transaction_date", "account_id", "transaction_type", "spending_type", "amount", "payment_method")


def _cell(df: DataFrame, name: str) -> Column:
    """Column ``name`` as text, or NULL where the sheet lacks it."""
    return F.col(f"`{name}`").cast("string") if name in df.columns else F.lit(None).cast("string")


def _is_flagged(df: DataFrame) -> Column:
    """Rows the cleaner marked; the mark is a boolean, or text once it went through a file."""
    if dict(df.dtypes).get("needs_cleaning") == "boolean":
        return F.coalesce("needs_cleaning", F.lit(False))
    return null_to_blank(fold(_cell(df, "needs_cleaning"))) == "true"


def _date(df: DataFrame) -> Column:
    """The date cell; cleaned rows carry it typed already, unless it went through text."""
    return F.col("date") if dict(df.dtypes).get("date") == "date" else parse_date(_cell(df, "date"))


def _amount(df: DataFrame, rounding: str) -> Column:
    if dict(df.dtypes).get("amount") == "double":
        return whole_number(F.col("amount"), rounding)
    return whole_amount(_cell(df, "amount"), rounding)


def _order(df: DataFrame) -> list[str]:
    return [c for c in ROW_ORDER if c in df.columns]


def natural_key(df: DataFrame) -> list[Column]:
    """Key columns with NULL and blank alike."""
    return [df[c] if c in ("transaction_date", "amount") else null_to_blank(df[c]) for c in NATURAL_KEY]


def candidates(cleaned: DataFrame, rounding: str = "truncate") -> DataFrame:
    """Cleaned rows in ledger terms, names not yet resolved.

    Flagged and undated rows are left out.  The three enumerated columns are lower
    case in the ledger, so they are compared and stored that way.
    """
    text = lambda name: _cell(cleaned, name)
    read = cleaned.filter(~_is_flagged(cleaned)).select(
        _date(cleaned).alias("transaction_date"),
        _amount(cleaned, rounding).try_cast(MONEY).alias("amount"),
        fold(text("transaction_type")).alias("transaction_type"),
        fold(text("spending_type")).alias("spending_type"),
        fold(text("type_payment")).alias("payment_method"),
        text("note").alias("note"),
        is_true(text("regret")).alias("is_regretted"),
        text("account").alias("account"),
        text("category").alias("category"),
        text("sub_category").alias("sub_category"),
        *_order(cleaned),
    )
    blanks = ("transaction_type", "spending_type", "payment_method", "note")
    return read.filter(F.col("transaction_date").isNotNull()).withColumns(
        {c: blank_to_null(F.col(c)) for c in blanks}
    )


def first_in_batch(rows: DataFrame) -> DataFrame:
    """First row per natural key; later copies in the same batch are skipped."""
    return keep_first(rows, natural_key(rows), _order(rows))


def not_yet_loaded(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows whose natural key the ledger does not hold yet.

    ``rows`` carries each key once, and the ledger side is reduced to distinct keys
    before the shuffle, so no key is hot on either side of the anti-join.
    """
    held = existing.select(*[k.alias(f"_{c}") for k, c in zip(natural_key(existing), NATURAL_KEY)]).distinct()
    # An unreadable amount gives NULL here and matches nothing: the row is rejected later.
    same = [k == held[f"_{c}"] for k, c in zip(natural_key(rows), NATURAL_KEY)]
    return rows.join(held, same, "left_anti")


def facts_like(existing: DataFrame, rows: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Facts with the natural key of some row of ``rows``, which should be written.

    As long as these are few, they go to the facts and no fact is moved.
    """
    keys = rows.select(*[k.alias(f"_{c}") for k, c in zip(natural_key(rows), NATURAL_KEY)]).distinct()
    count, size = measured(rows.select(*NATURAL_KEY))
    if count <= max_rows and size <= BROADCAST_BYTES:
        keys = F.broadcast(keys)
    same = [k == keys[f"_{c}"] for k, c in zip(natural_key(existing), NATURAL_KEY)]
    return existing.join(keys, same, "left_semi")


def resolve_ids(rows: DataFrame, ledger: Ledger, subcategory_rule: str = "within_category") -> DataFrame:
    """Add account, category, subcategory and plan ids; unknown names give NULL.

    Subcategory names repeat across categories, so they are looked up inside the
    category found.  ``subcategory_rule="by_name"`` ignores the category and takes
    the highest id of that name.
    """
    rows = resolve_name(rows, "account", ledger.accounts, "account_name", "account_id")
    rows = resolve_name(rows, "category", ledger.categories, "category_name", "category_id")
    within = ["category_id"] if subcategory_rule == "within_category" else []
    rows = resolve_name(
        rows, "sub_category", ledger.subcategories, "subcategory_name", "subcategory_id", within=within
    )
    day = F.col("transaction_date")
    return plan_of_month(rows, ledger.monthly_plans, F.year(day), F.month(day))


def new_transactions(
    cleaned: DataFrame,
    ledger: Ledger,
    source: str = "python",
    rounding: str = "truncate",
    subcategory_rule: str = "within_category",
    existing: DataFrame | None = None,
) -> DataFrame:
    """Rows to insert, ids resolved, constraints not yet checked.

    ``existing`` names the facts to compare with, where not all of them are needed.
    """
    held = ledger.transactions if existing is None else existing
    fresh = not_yet_loaded(first_in_batch(candidates(cleaned, rounding)), held)
    return as_transactions(fresh, ledger, source, subcategory_rule)


def as_transactions(
    fresh: DataFrame, ledger: Ledger, source: str = "python", subcategory_rule: str = "within_category"
) -> DataFrame:
    """Candidates that are new, with their ids, in the columns of the ledger."""
    resolved = resolve_ids(fresh, ledger, subcategory_rule)
    return resolved.select(
        "transaction_date",
        "account_id",
        "plan_id",
        "category_id",
        "subcategory_id",
        "transaction_type",
        "spending_type",
        "amount",
        "payment_method",
        "note",
        F.lit(None).cast("bigint").alias("related_transaction_id"),
        "is_regretted",
        F.lit(source).alias("source_data"),
        *_order(resolved),
    )


def reject_reason() -> Column:
    """The first table constraint a row breaks, or NULL."""
    kind, spending, payment = F.col("transaction_type"), F.col("spending_type"), F.col("payment_method")
    return (
        F.when(F.col("account_id").isNull(), "account")
        .when(kind.isNull() | ~kind.isin(*TRANSACTION_TYPES), "transaction_type")
        .when(~spending.isin(*SPENDING_TYPES), "spending_type")
        .when(~payment.isin(*PAYMENT_METHODS), "payment_method")
        .when(F.col("amount").isNull() | (F.col("amount") <= 0), "amount")
    )


def _long_note_keys(rows: DataFrame) -> DataFrame:
    """Unique keys of rows that can clash on the note prefix alone.

    Rows with a NULL key column never clash, and shorter notes that share a unique
    key share the natural key too, which has been handled before.
    """
    prefix = F.substring("note", 1, UNIQUE_NOTE_PREFIX).alias("_prefix")
    return rows.filter(F.length("note") >= UNIQUE_NOTE_PREFIX).select(*rows.columns, prefix).dropna(
        subset=[*UNIQUE_KEY, "_prefix"]
    )


def with_reject_reason(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Add ``reject_reason``: a broken constraint, or ``duplicate_key``.

    ``rows`` should be written: they are looked at first, and without a long note among
    them no key can clash and ``existing`` is not read.
    """
    checked = rows.withColumn("reject_reason", reject_reason())
    key = [*UNIQUE_KEY, "_prefix"]
    long = _long_note_keys(checked.filter(F.col("reject_reason").isNull()))
    if long.isEmpty():
        return checked
    held = _long_note_keys(existing).select(*key).distinct()
    order = _order(rows)
    winners = keep_first(long.join(held, key, "left_anti"), [F.col(c) for c in key], order)
    losers = long.select(*order).join(winners.select(*order), order, "left_anti").withColumn("_clash", F.lit(True))
    # Clashes are rare: written and counted, they are broadcast and the rows stay where they are.
    return (
        lookup_join(checked, materialise(losers, "note_clashes"), order, salt_by=order)
        .withColumn("reject_reason", F.coalesce("reject_reason", F.when(F.col("_clash"), "duplicate_key")))
        .drop("_clash")
    )


def next_id(table: DataFrame, column: str) -> Column:
    """Highest id in use, 0 for an empty table, as a scalar subquery."""
    return F.coalesce(table.agg(F.max(column).cast("bigint").alias("m")).scalar(), F.lit(0).cast("bigint"))


def with_transaction_ids(
    rows: DataFrame, existing: DataFrame | int, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """Dense ids after the highest existing one, in date and natural-key order.

    ``existing`` is that id, or the facts to look it up in.
    """
    order = ["transaction_date", "amount", "transaction_type", "spending_type", "payment_method", "note"]
    last = F.lit(existing).cast("bigint") if isinstance(existing, int) else next_id(existing, "transaction_id")
    numbered = number_rows(rows, order, "transaction_id", one_task_rows=one_task_rows)
    return numbered.withColumn("transaction_id", F.col("transaction_id") + last)


# ---------------------------------------------------------------------------
# Plans and plan items
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Upsert:
    """Merged table and the sheet rows that could not be used."""

    merged: DataFrame
    skipped: DataFrame


def _month_columns(sheet: DataFrame) -> list[Column]:
    return [to_number(_cell(sheet, c)).try_cast("int").alias(f"_{c}") for c in ("year", "month")]


def plan_rows(sheet: DataFrame) -> DataFrame:
    """Sheet rows in plan terms; ``_usable`` tells whether year and month make a month."""
    df = lower_headers(sheet)
    # A year that no date can have is as unusable as none.
    usable = F.coalesce("_year", F.lit(0)).between(1, 9999) & F.coalesce("_month", F.lit(0)).between(1, 12)
    return df.select(
        *_month_columns(df),
        whole_amount(_cell(df, "fixed_budget")).try_cast(MONEY).alias("fixed_budget"),
        whole_amount(_cell(df, "savings_target")).try_cast(MONEY).alias("savings_target"),
        blank_to_null(_cell(df, "note")).alias("note"),
        *_order(df),
    ).withColumn("_usable", usable)


def upsert_plans(existing: DataFrame, sheet: DataFrame) -> Upsert:
    """Plans keyed by month: the last sheet row of a month replaces its figures.

    Both sides hold at most one row per calendar month after the keep-last step, so
    numbering the new ones in one task is safe at any size of the ledger.
    """
    rows = plan_rows(sheet)
    usable = rows.filter("_usable").withColumns(
        {"plan_year": F.col("_year").try_cast("smallint"), "plan_month": F.col("_month").try_cast("tinyint")}
    )
    key = ["plan_year", "plan_month"]
    values = ["fixed_budget", "savings_target", "note"]
    incoming = keep_last(usable, [F.col(c) for c in key], _order(usable)).select(*key, *values)
    both = _overlay(existing, incoming, key, values, "plan_id")
    place = F.row_number().over(Window.partitionBy(F.col("plan_id").isNull()).orderBy(*key))
    fresh_id = (place + next_id(existing, "plan_id")).cast("int")
    merged = both.withColumn("plan_id", F.coalesce("plan_id", fresh_id))
    return Upsert(merged, rows.filter("NOT _usable"))


def plan_item_rows(sheet: DataFrame, ledger: Ledger) -> DataFrame:
    """Sheet rows with plan and category ids; either is NULL when it cannot be found."""
    df = lower_headers(sheet)
    rows = df.select(
        *_month_columns(df),
        trim(_cell(df, "category")).alias("category"),
        whole_amount(_cell(df, "budgeted")).try_cast(MONEY).alias("budgeted"),
        blank_to_null(_cell(df, "note")).alias("note"),
        *_order(df),
    )
    rows = resolve_name(rows, "category", ledger.categories, "category_name", "category_id")
    return plan_of_month(rows, ledger.monthly_plans, F.col("_year"), F.col("_month"))


def upsert_plan_items(ledger: Ledger, sheet: DataFrame) -> Upsert:
    """Plan items keyed by plan and category; rows without either are skipped."""
    rows = plan_item_rows(sheet, ledger)
    usable = F.col("plan_id").isNotNull() & F.col("category_id").isNotNull()
    key, values = ["plan_id", "category_id"], ["budgeted", "note"]
    found = rows.filter(usable)
    incoming = keep_last(found, [F.col(c) for c in key], _order(found)).select(*key, *values)
    existing = ledger.monthly_plan_items
    both = materialise(_overlay(existing, incoming, key, values, "item_id"), "plan_items")
    held, fresh = both.filter("item_id IS NOT NULL"), both.filter("item_id IS NULL").drop("item_id")
    numbered = number_rows(fresh, key, "item_id").withColumn(
        "item_id", F.col("item_id") + next_id(existing, "item_id")
    )
    return Upsert(held.unionByName(numbered), rows.filter(~usable))


def _overlay(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], values: Sequence[str], id_column: str
) -> DataFrame:
    """Existing rows with the incoming values laid over them; new keys have no id yet."""
    held = existing.select(*key, F.col(id_column), *[F.col(v).alias(f"_old_{v}") for v in values])
    both = held.join(incoming.withColumn("_incoming", F.lit(True)), list(key), "full")
    return both.select(
        id_column,
        *key,
        *[F.when(F.col("_incoming"), F.col(v)).otherwise(F.col(f"_old_{v}")).alias(v) for v in values],
    )
