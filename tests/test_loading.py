from __future__ import annotations

from datetime import date
from decimal import Decimal

from conftest import rows
from ledgers import FOOD, HOUSING, HOUSING_OTHERS, TRANSPORT, TRANSPORT_OTHERS, ledger, tx
from pyspark.sql import functions as F

from coffer.plans import loading
from coffer.plans.cleaning import clean_expenses

HEADER = ["Date", "Account", "Transaction_Type", "Spending_Type", "Type_Payment", "Category", "Sub_Category", "Amount",
          "Note", "Regret"]
CARD, BANK = "credit (SC Credit)", "expense (ACB)"


def cleaned(spark, data, mode="python"):
    numbered = [(*row, i) for i, row in enumerate(data)]
    sheet = spark.createDataFrame(numbered, ", ".join(f"{n} string" for n in HEADER) + ", _row_idx long")
    return clean_expenses(sheet, mode)


def line(day="1/2/2024", account=BANK, kind="expense", spending="extra", pay="cash", category="Food & Drinks",
         sub="Snacks", amount="5,000", note="", regret=""):
    return (day, account, kind, spending, pay, category, sub, amount, note, regret)


def load(spark, data, book, **options):
    fresh = loading.new_transactions(cleaned(spark, data), book, **options)
    return loading.with_reject_reason(fresh, book.transactions)


def test_names_dates_and_flags_are_resolved(spark):
    book = ledger(spark, plans=[(7, 2024, 1, 0, 0, None)])
    data = [
        line(account=" EXPENSE (acb) ", category=" food & DRINKS", regret=" Yes"),
        line(day="2024-02-03", kind="Income", spending="", pay="", category="", sub="", amount="9", note="pay"),
    ]
    got = load(spark, data, book).drop("_row_idx", "reject_reason")
    assert rows(got, "transaction_date") == [
        (date(2024, 1, 2), 2, 7, FOOD, 4, "expense", "extra", Decimal(5000), "cash", None, None, True, "python"),
        (date(2024, 2, 3), 2, None, None, None, "income", None, Decimal(9), None, "pay", None, False, "python"),
    ]


def test_equal_subcategory_names_are_told_apart_by_category(spark):
    book = ledger(spark)
    data = [
        line(category="Housing & Bills", sub="Others", note="a"),
        line(category="Transportation", sub="Others", note="b"),
        line(category="Food & Drinks", sub="Others", note="c"),
        line(category="Nowhere", sub="Others", note="d"),
    ]
    got = load(spark, data, book).select("note", "category_id", "subcategory_id")
    assert rows(got) == [
        ("a", HOUSING, HOUSING_OTHERS), ("b", TRANSPORT, TRANSPORT_OTHERS), ("c", FOOD, None), ("d", None, None)
    ]
    by_name = load(spark, data, book, subcategory_rule="by_name").select("subcategory_id").distinct()
    assert rows(by_name) == [(book.subcategories.filter("subcategory_name = 'Others'").agg(F.max("subcategory_id")).first()[0],)]


def test_rows_the_ledger_holds_are_not_loaded_again(spark):
    held = [
        tx(1, "2024-01-02", 5000, spending="extra", pay="cash", account=2),
        tx(2, "2024-01-03", 10, spending=None, pay=None, note=None, account=2),
    ]
    data = [
        line(),  # held
        line(account=CARD),  # held as well: the key has no account
        line(amount="5,001"),
        line(day="1/3/2024", spending="", pay="", amount="10"),  # held, blank equals NULL
    ]
    got = load(spark, data, ledger(spark, held)).select("amount")
    assert rows(got) == [(Decimal(5001),)]


def test_copies_in_one_batch_are_loaded_once(spark):
    data = [line(), line(account=CARD), line(note="other")]
    got = load(spark, data, ledger(spark)).select("account_id", "note")
    assert rows(got) == [(2, "other"), (2, None)]


def test_flagged_and_undated_rows_are_left_out(spark):
    data = [line(amount="abc"), line(amount=""), line(day="n/a"), line(amount="7.9")]
    assert rows(load(spark, data, ledger(spark)).select("amount")) == [(Decimal(7),)]
    half_up = load(spark, data, ledger(spark), rounding="half_up").select("amount")
    assert rows(half_up) == [(Decimal(8),)]


def test_node_cleaned_rows_load_too(spark):
    fresh = loading.new_transactions(cleaned(spark, [line(amount="₫7"), line(amount="")], "node"), ledger(spark), "nodejs")
    got = loading.with_reject_reason(fresh, ledger(spark).transactions)
    assert rows(got.select("amount", "source_data", "reject_reason")) == [
        (Decimal(0), "nodejs", "amount"), (Decimal(7), "nodejs", None)
    ]


def test_broken_constraints_are_named(spark):
    data = [
        line(note="ok"),
        line(note="a", account="Unknown"),
        line(note="b", kind="gift"),
        line(note="c", spending="daily"),
        line(note="d", pay="cheque"),
        line(note="e", amount="(5)"),
        line(note="f", kind=""),
    ]
    got = load(spark, data, ledger(spark)).select("note", "reject_reason")
    assert rows(got) == [
        ("a", "account"), ("b", "transaction_type"), ("c", "spending_type"), ("d", "payment_method"), ("e", "amount"),
        ("f", "transaction_type"), ("ok", None),
    ]


def test_long_notes_clash_on_their_first_200_characters(spark):
    stem = "x" * 200
    held = [tx(1, "2024-01-05", 5000, spending="extra", pay="cash", account=2, note=stem + " old")]
    data = [
        line(note=stem + " one"),
        line(note=stem + " two"),
        line(note=stem + " card", account=CARD),
        line(note=stem + " blank", pay=""),
        line(note=stem + " blank too", pay=""),
        line(day="1/5/2024", note=stem + " new"),
        line(note="x" * 199),
    ]
    got = load(spark, data, ledger(spark, held)).withColumn("tail", F.expr("right(note, length(note) - 200)"))
    assert rows(got.select("tail", "reject_reason")) == [
        (" blank too", None), (" blank", None), (" card", None), (" new", "duplicate_key"), (" one", None),
        (" two", "duplicate_key"), ("", None),
    ]


def test_ids_follow_the_highest_one(spark):
    held = [tx(41, "2023-01-02", 1, note="held")]
    book = ledger(spark, held)
    fresh = load(spark, [line(note=str(i)) for i in range(50)], book)
    near = loading.with_transaction_ids(fresh, book.transactions)
    far = loading.with_transaction_ids(fresh, book.transactions, one_task_rows=3)
    assert sorted(r[0] for r in near.select("transaction_id").collect()) == list(range(42, 92))
    assert rows(near.select("note", "transaction_id")) == rows(far.select("note", "transaction_id"))
    empty = ledger(spark)
    assert loading.with_transaction_ids(fresh, empty.transactions).agg(F.min("transaction_id")).first()[0] == 1


def sheet(spark, names, data):
    numbered = [(*row, i) for i, row in enumerate(data)]
    return spark.createDataFrame(numbered, ", ".join(f"{n} string" for n in names) + ", _row_idx long")


def test_plans_are_updated_or_added(spark):
    book = ledger(spark, plans=[(3, 2024, 1, 100, 10, "old"), (9, 2023, 5, 200, 20, "kept")])
    names = ["Year", "Month", "Fixed_Budget", "Savings_Target", "Note"]
    data = [
        ("2024", "1", "1,500", "", "first"),
        ("2024", "1", "1,600", "7.9", ""),
        ("2024", "3", "abc", "5", "new"),
        ("2024", "2", "4", "5", None),
        ("", "2", "1", "1", ""),
        ("2024", "13", "1", "1", ""),
        ("0", "2", "1", "1", ""),
    ]
    done = loading.upsert_plans(book.monthly_plans, sheet(spark, names, data))
    assert rows(done.merged, "plan_id") == [
        (3, 2024, 1, Decimal(1600), Decimal(7), None),
        (9, 2023, 5, Decimal(200), Decimal(20), "kept"),
        (10, 2024, 2, Decimal(4), Decimal(5), None),
        (11, 2024, 3, Decimal(0), Decimal(5), "new"),
    ]
    assert done.skipped.count() == 3


def test_plan_items_need_a_plan_and_a_category(spark):
    book = ledger(
        spark, plans=[(3, 2024, 1, 0, 0, None), (4, 2024, 2, 0, 0, None)], items=[(20, 3, FOOD, 5, "old"), (21, 4, FOOD, 6, "kept")]
    )
    names = ["Year", "Month", "Category", "Budgeted", "Note"]
    data = [
        ("2024", "1", " FOOD & drinks", "1,000", ""),
        ("2024", "2", "Transportation", "2,000", "n"),
        ("2024", "9", "Transportation", "1", "no plan"),
        ("2024", "1", "Nowhere", "1", "no category"),
        ("", "1", "Transportation", "1", "no year"),
    ]
    done = loading.upsert_plan_items(book, sheet(spark, names, data))
    assert rows(done.merged, "item_id") == [
        (20, 3, FOOD, Decimal(1000), None), (21, 4, FOOD, Decimal(6), "kept"), (22, 4, TRANSPORT, Decimal(2000), "n")
    ]
    assert rows(done.skipped.select("note")) == [("no category",), ("no plan",), ("no year",)]


def test_a_year_that_cannot_be_is_skipped(spark):
    book = ledger(spark)
    names = ["Year", "Month", "Fixed_Budget", "Savings_Target", "Note"]
    data = [("202401", "1", "1", "1", ""), ("1e400", "1", "1", "1", ""), ("2024", "1", "5", "1", "")]
    done = loading.upsert_plans(book.monthly_plans, sheet(spark, names, data))
    assert [r["plan_year"] for r in done.merged.collect()] == [2024]
    assert done.skipped.count() == 2
