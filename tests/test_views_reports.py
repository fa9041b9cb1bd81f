from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from ledgers import FOOD, HOUSING, RENT, ledger, tx

from coffer.plans import marts, quality, reports, views

START, END = date(2024, 1, 1), date(2024, 12, 31)


@pytest.fixture(scope="module")
def book(spark):
    """January, March and April 2024: a gap, a nameless category, every kind of movement."""
    events = [
        tx(1, "2024-01-05", 100, category=FOOD, sub=1, spending="extra", plan=1),
        tx(2, "2024-01-06", 300, category=HOUSING, sub=RENT, spending="fixed", plan=1),
        tx(3, "2024-01-07", 1000, kind="income"),
        tx(4, "2024-03-01", 50, kind="credit_purchase", account=3, category=FOOD, spending=None, plan=2, regret=True),
        tx(5, "2024-03-02", 20, kind="credit_payment", account=3),
        tx(6, "2024-03-03", 70, spending="extra"),
        tx(7, "2024-04-01", 30, category=FOOD, sub=1, spending="extra"),
        tx(8, "2024-04-02", 15, kind="loan_given"),
        tx(9, "2024-04-03", 5, kind="loan_repayment_in", related=8),
        tx(10, "2024-04-04", 6, kind="transfer_in"),
        tx(11, "2024-04-05", 7, kind="transfer_out"),
        tx(12, "2024-04-06", 8, kind="loan_received"),
        tx(13, "2024-04-07", 9, kind="loan_repayment_out", related=99),
    ]
    plans = [(1, 2024, 1, 450, 0, None), (2, 2024, 3, 60, 0, None)]
    items = [(1, 1, FOOD, 90, None), (2, 1, HOUSING, 360, None), (3, 2, HOUSING, 50, None)]
    return ledger(spark, events, plans, items)


def test_cash_balance_keeps_idle_accounts(book):
    got = views.account_cash_balance(book).select("account_id", "cash_balance")
    spent = -100 - 300 + 1000 - 70 - 30 - 15 + 5 + 6 - 7 + 8 - 9
    assert rows(got, "account_id") == [(1, Decimal(0)), (2, Decimal(spent)), (3, Decimal(-20))]


def test_credit_outstanding(book):
    got = views.credit_outstanding(book)
    assert rows(got) == [(3, "credit (SC Credit)", Decimal(50), Decimal(20), Decimal(30))]


def test_budget_keeps_items_without_spend(book):
    assert rows(views.budget_vs_actual(book), "yr", "mo", "category_name") == [
        (2024, 1, "Food & Drinks", Decimal(90), Decimal(100), Decimal(-10)),
        (2024, 1, "Housing & Bills", Decimal(360), Decimal(300), Decimal(60)),
        (2024, 3, "Housing & Bills", Decimal(50), Decimal(0), Decimal(50)),
    ]


def test_monthly_summary(book):
    got = marts.mart_monthly_summary(book).collect()
    by_month = {r["mo"]: r for r in got}
    assert sorted(by_month) == [1, 3, 4]
    march = by_month[3]
    assert (march["transaction_count"], march["total_spend"], march["regretted_spend"]) == (2, 120, 50)
    assert (march["fixed_spend"], march["extra_spend"], march["categories_used"]) == (0, 70, 1)
    for row in got:
        assert row["fixed_spend"] + row["extra_spend"] <= row["total_spend"]


def test_shares_of_a_month_add_up(book):
    shares = {}
    for row in marts.mart_category_breakdown(book).collect():
        shares[row["mo"]] = shares.get(row["mo"], 0) + row["pct_of_month"]
    assert all(abs(total - 100) < 0.05 for total in shares.values())


def test_merchants_fall_back_to_the_category_and_share_ranks(spark, book):
    got = marts.mart_top_merchants(book).select("merchant", "spending_type", "total_spend", "spend_rank")
    assert rows(got, "spend_rank", "merchant") == [
        ("Rent", "fixed", Decimal(300), 1),
        ("Daily meals", "extra", Decimal(130), 2),
        (None, "extra", Decimal(70), 3),
        ("Food & Drinks", None, Decimal(50), 4),
    ]


def test_rolling_mean_counts_rows_not_months(book):
    got = reports.trend_rolling(book, START, END).select("mo", "rolling_3mo")
    assert rows(got, "mo") == [(1, 400.0), (3, 260.0), (4, round((400 + 120 + 30) / 3, 4))]


def test_running_total_restarts_at_the_range(book):
    got = reports.overview_monthly(book, date(2024, 2, 1), END).select("month_label", "cumulative_spend")
    assert rows(got) == [("Apr 2024", Decimal(150)), ("Mar 2024", Decimal(120))]
    table = reports.overview_table(book, START, END)
    assert ("Jan 2024", "400", "300", "100", 2) in rows(table)


def test_nameless_categories_stay_out_of_totals(book):
    assert rows(reports.category_totals(book, START, END)) == [
        ("Food & Drinks", Decimal(180), 0.375), ("Housing & Bills", Decimal(300), 0.625)
    ]
    assert reports.category_mom(book, START, END).count() == 4
    assert rows(reports.month_order(book, START, END).select("month_label"))[0] == ("Apr 2024",)


def test_kpis(book):
    assert rows(reports.kpi_latest_month(book)) == [(2024, 4, Decimal(30), 1)]
    assert rows(reports.kpi_top_category(book)) == [("Food & Drinks", Decimal(30))]
    assert rows(reports.kpi_latest_date(book)) == [(date(2024, 4, 1),)]


def test_top_merchants_filter_by_last_visit_and_category(book):
    top = reports.merchants_top_n(book, date(2024, 1, 1), date(2024, 3, 31), n=5)
    assert rows(top.select("merchant")) == [("Food & Drinks",), ("Rent",)]
    chosen = reports.merchants_top_n(book, START, END, ["Food & Drinks"], n=1)
    assert rows(chosen.select("merchant", "total_spend")) == [("Daily meals", Decimal(130))]
    assert rows(reports.merchant_categories(book, START, END)) == [("Food & Drinks",), ("Housing & Bills",)]


def test_pivots(book):
    heat = reports.spend_heatmap(book, START, END)
    assert heat.columns[:4] == ["yr", "Jan", "Feb", "Mar"]
    assert rows(heat.select("yr", "Jan", "Feb", "Mar")) == [(2024, Decimal(400), None, Decimal(120))]
    yoy = reports.yoy_comparison(book, date(2023, 1, 1), END)
    assert rows(yoy, "mo")[0] == (1, None, Decimal(400))


def test_default_range():
    assert reports.default_range(date(2024, 5, 17)) == (date(2023, 5, 1), date(2024, 5, 17))
    assert reports.default_range(date(2024, 5, 17), years=2)[0] == date(2022, 5, 1)


def test_checks_count_what_is_wrong(spark, book):
    failed = {r["check_name"]: r["failed"] for r in quality.dq_report(book, "Food & Drinks").collect()}
    expected = {
        "not_null:stg_expenses.category_id": 1,
        "not_null:mart_category_breakdown.category_name": 1,
        "not_null:mart_top_merchants.merchant": 1,
        "relationship:transactions.related_transaction_id": 1,
        "note_required:transactions.note": 3,
        "consistent:monthly_plans.fixed_budget": 1,
    }
    assert {k: v for k, v in failed.items() if v} == expected


def test_checks_see_each_kind_of_fault(spark):
    events = [
        tx(1, "2024-01-01", 5, account=77, category=88, sub=99, plan=66, spending="daily", pay="cheque", source="hand"),
        tx(1, "2024-01-01", 0, kind="gift"),
        tx(3, "2024-01-01", 5, spending="fixed", pay="cash", note="n" * 200 + "a"),
        tx(4, "2024-01-01", 5, spending="fixed", pay="cash", note="n" * 200 + "b"),
        tx(5, "2024-01-01", 5, spending="fixed", pay=None, note="same"),
        tx(6, "2024-01-01", 5, spending="fixed", pay=None, note="same"),
    ]
    plans = [(1, 2024, 13, 0, 0, None), (2, 2024, 1, 0, 0, None), (3, 2024, 1, 0, 0, None)]
    items = [(1, 9, 1, 0, None), (2, 2, 55, 0, None), (3, 2, 55, 0, None)]
    failed = {r["check_name"]: r["failed"] for r in quality.dq_report(ledger(spark, events, plans, items)).collect()}
    assert {k: v for k, v in failed.items() if v and not k.startswith("not_null")} == {
        "accepted:transactions.transaction_type": 1,
        "accepted:transactions.spending_type": 1,
        "accepted:transactions.payment_method": 1,
        "accepted:transactions.source_data": 1,
        "expression:transactions.amount_positive": 1,
        "expression:monthly_plans.plan_month": 1,
        "relationship:transactions.account_id": 1,
        "relationship:transactions.plan_id": 1,
        "relationship:transactions.category_id": 1,
        "relationship:transactions.subcategory_id": 1,
        "relationship:monthly_plan_items.plan_id": 1,
        "relationship:monthly_plan_items.category_id": 2,
        "unique:monthly_plans.year_month": 1,
        "unique:monthly_plan_items.plan_category": 1,
        "unique:transactions.key": 1,
    }
    assert failed["unique:stg_expenses.id"] == 0  # the second row with id 1 is no spend


def test_seed_rows(spark):
    empty = ledger(spark)
    assert (empty.accounts.count(), empty.categories.count(), empty.subcategories.count()) == (3, 13, 50)
    assert empty.subcategories.filter("subcategory_name = 'Others'").count() == 10
