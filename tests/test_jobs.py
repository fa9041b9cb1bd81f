from __future__ import annotations

import os
import re
from datetime import date

import pytest
from conftest import rows
from ledgers import ledger, tx
from pyspark.sql import functions as F

from coffer.plans import jobs, marts, reports, staging, views
from coffer.sources import sheets, zones
from coffer.streaming.incremental import load_new_expenses

EXPENSES = "DATE,Account,Transaction_Type,Spending_Type,Type_Payment,Category,SUB_CATEGORY,AMOUNT,NOTE,Regret\n"
FIRST = EXPENSES + (
    '"1/5/2024",expense (ACB),expense,extra,cash,Food & Drinks,Snacks,"61,000",tea,yes\n'
    '"1/6/2024",credit (SC Credit),credit_purchase,fixed,credit_card,Shopping,Others,"1,200",shoes,\n'
    '"n/a",expense (ACB),expense,extra,cash,Food & Drinks,Snacks,"5",lost,\n'
    '"1/7/2024",expense (ACB),expense,extra,cash,Food & Drinks,Snacks,abc,unclear,\n'
    '"1/8/2024",Unknown,expense,extra,cash,Food & Drinks,Snacks,"70",whose,\n'
)
SECOND = FIRST + '"2/1/2024",savings (SC Bank),income,,bank_transfer,Income,Salary,"9,000,000",pay,\n'


def land(root, source, text, drop="export"):
    folder = root / "landing" / source
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{drop}.csv").write_text(text, encoding="utf-8-sig")


def land_all(root, expenses):
    land(root, "plans", "Year,Month,Fixed_Budget,Savings_Target,Note\n2024,1,\"5,000,000\",\"1,000\",first\n")
    land(root, "plan_items", "Year,Month,Category,Budgeted,Note\n2024,1,food & drinks,\"50,000\",\n2024,7,Shopping,1,\n")
    land(root, "expenses", expenses)


def summary(results):
    return [tuple(r) for r in results.select("source", "status", "rows_in_sheet", "rows_loaded", "rows_rejected").collect()]


def test_sources_load_once_however_often_they_run(spark, tmp_path):
    root = str(tmp_path)
    land_all(tmp_path, FIRST)
    first = jobs.run_sources(spark, root, batch_id=1)
    assert summary(first) == [("plans", "ok", 1, 1, 0), ("plan_items", "ok", 2, 1, 1), ("expenses", "ok", 5, 2, 1)]
    assert jobs.overall_status(first) == "ok"

    again = jobs.run_sources(spark, root, batch_id=2)
    assert summary(again)[2] == ("expenses", "ok", 5, 0, 1)
    land(tmp_path, "expenses", SECOND)
    third = jobs.run_sources(spark, root, batch_id=3, only=["expenses"])
    assert summary(third) == [("expenses", "ok", 6, 1, 1)]

    book = zones.StoredLedger(spark, root)
    assert rows(book.transactions.select("transaction_id", "amount", "plan_id", "subcategory_id"), "transaction_id") == [
        (1, 61000, 1, 4), (2, 1200, 1, 29), (3, 9000000, None, 47)
    ]
    assert book.monthly_plans.count() == 1 and book.monthly_plan_items.count() == 1
    rejected = spark.read.parquet(f"{root}/rejected/transactions")
    assert {r["reject_reason"] for r in rejected.collect()} == {"account"}
    budget = views.budget_vs_actual(book).select("category_name", "budgeted", "actual_spent")
    assert rows(budget) == [("Food & Drinks", 50000, 61000)]
    paths = jobs.write_marts(book, root, run=1)
    assert spark.read.parquet(paths["mart_monthly_summary"]).count() == marts.mart_monthly_summary(book).count() == 1
    stored = zones.StoredLedger(spark, root, use_marts=True)
    assert "tables/transactions" not in str(reports.kpi_latest_month(stored).inputFiles())
    for report in (reports.kpi_latest_month, reports.kpi_top_category):
        assert rows(report(stored)) == rows(report(book))
    span = date(2024, 1, 1), date(2024, 12, 31)
    for report in (reports.overview_monthly, reports.category_detail, reports.merchants_top_n, reports.spend_heatmap):
        assert rows(report(stored, *span)) == rows(report(book, *span))


def test_a_batch_that_runs_twice_replaces_its_own_raw_rows(spark, tmp_path):
    root = str(tmp_path)
    land_all(tmp_path, FIRST)
    jobs.run_sources(spark, root, batch_id=1)
    jobs.run_sources(spark, root, batch_id=1)
    raw = zones.read_raw(spark, root, "expenses")
    assert raw.count() == 5
    assert zones.StoredLedger(spark, root).transactions.count() == 2


def test_a_failed_source_does_not_stop_the_others(spark, tmp_path):
    land_all(tmp_path, FIRST)
    land(tmp_path, "plans", "Year,Month\n")
    results = jobs.run_sources(spark, str(tmp_path), batch_id=1)
    found = {r["source"]: r for r in results.collect()}
    assert found["plans"]["status"] == "error" and "no rows" in found["plans"]["error"]
    assert found["plan_items"]["status"] == "ok" and found["plan_items"]["rows_loaded"] == 0
    assert found["expenses"]["rows_loaded"] == 2
    assert jobs.overall_status(results) == "partial_failure"


def test_the_latest_export_counts_however_many_there_are(spark, tmp_path):
    """Eleven exports of one purchase: the eleventh sorts before the second as text."""
    for n in range(1, 12):
        text = EXPENSES + f'"1/5/2024",expense (ACB),expense,extra,cash,Food & Drinks,Snacks,"61",export {n},\n'
        land(tmp_path, "expenses", text, f"drop={n}")
        os.utime(tmp_path / "landing" / "expenses" / f"drop={n}.csv", (1_700_000_000 + n, 1_700_000_000 + n))
    raw = sheets.read_sheet(spark, f"{tmp_path}/landing/expenses")
    kept = staging.current_rows(staging.as_batch(raw, 1)).select("note").collect()
    assert [r[0] for r in kept] == ["export 11"]


def test_streams_and_daily_batches_keep_apart(spark, tmp_path):
    root = str(tmp_path)
    land(tmp_path, "expenses", FIRST, "one")
    jobs.run_sources(spark, root, batch_id=20240131, only=["expenses"])
    names = EXPENSES.strip().split(",")
    load_new_expenses(spark, root, names).awaitTermination()
    land(tmp_path, "expenses", SECOND, "two")
    load_new_expenses(spark, root, names).awaitTermination()
    batches = lambda: sorted(r[0] for r in zones.read_raw(spark, root, "expenses").select("_batch_id").distinct().collect())
    first = zones.STREAM_BATCHES
    assert batches() == [20240131, first, first + 1]
    # Progress is lost: the stream reads all files again and writes behind what it had written.
    (tmp_path / "checkpoints").rename(tmp_path / "lost")
    load_new_expenses(spark, root, names).awaitTermination()
    assert batches() == [20240131, first, first + 1, first + 2]
    assert zones.StoredLedger(spark, root).transactions.count() == 3
    with pytest.raises(ValueError):
        jobs.run_sources(spark, root, batch_id=first)


def test_ids_go_on_from_the_kept_mark(spark, tmp_path):
    root = str(tmp_path)
    land_all(tmp_path, FIRST)
    jobs.run_sources(spark, root, batch_id=1)
    assert zones.last_transaction_id(spark, root) == 2
    land(tmp_path, "expenses", SECOND)
    jobs.run_sources(spark, root, batch_id=2)
    assert zones.last_transaction_id(spark, root) == 3
    ids = [r[0] for r in zones.StoredLedger(spark, root).transactions.select("transaction_id").collect()]
    assert sorted(ids) == [1, 2, 3]


def test_rejected_rows_get_another_chance_with_history(spark, tmp_path):
    root = str(tmp_path)
    land_all(tmp_path, FIRST)
    jobs.run_sources(spark, root, batch_id=1)
    accounts = zones.StoredLedger(spark, root).accounts
    extra = accounts.limit(1).withColumns({"account_id": F.lit(99), "account_name": F.lit("Unknown")})
    zones.write_snapshot(accounts.unionByName(extra.select(accounts.columns)), f"{root}/tables/accounts")
    land(tmp_path, "expenses", EXPENSES + '"3/1/2024",expense (ACB),expense,extra,cash,Food & Drinks,Snacks,"7",late,\n')
    assert summary(jobs.run_sources(spark, root, 2, only=["expenses"])) == [("expenses", "ok", 1, 1, 0)]
    assert summary(jobs.run_sources(spark, root, 3, only=["expenses"], history=True)) == [("expenses", "ok", 1, 1, 0)]


def explained(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_ranged_reports_read_their_months_only(spark, tmp_path):
    root = str(tmp_path)
    events = [tx(i, f"202{i % 4}-{i % 12 + 1:02}-15", 10 + i, category=1, sub=1) for i in range(240)]
    zones.append_transactions(ledger(spark, events).transactions, root)
    book = zones.StoredLedger(spark, root)
    span = date(2021, 2, 1), date(2021, 6, 30)
    ranged = (
        reports.overview_monthly, reports.overview_table, reports.category_detail, reports.category_totals,
        reports.category_mom, reports.month_order, reports.trend_rolling, reports.yoy_comparison, reports.spend_heatmap,
    )
    for report in ranged:
        plan = explained(report(book, *span))
        filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
        assert filters and all("yr" in f and "mo" in f for f in filters), report.__name__
    for report in (reports.kpi_latest_month, reports.kpi_top_category):
        plan = explained(report(book))
        assert re.search(r"PartitionFilters: \[[^\]]*yr[^\]]*\]", plan), report.__name__
    files = marts.spend_facts(book, *span).inputFiles()
    assert marts.spend_facts(book, *span).count() == sum(e[1].year == 2021 and 2 <= e[1].month <= 6 for e in events)
    assert all("yr=2021" in f for f in files) or len(files) == len(book.transactions.inputFiles())


def test_the_stream_loads_what_landed_since(spark, tmp_path):
    root = str(tmp_path)
    land(tmp_path, "expenses", FIRST, "one")
    names = EXPENSES.strip().split(",")
    load_new_expenses(spark, root, names).awaitTermination()
    assert zones.StoredLedger(spark, root).transactions.count() == 2
    land(tmp_path, "expenses", SECOND, "two")
    load_new_expenses(spark, root, names).awaitTermination()
    load_new_expenses(spark, root, names).awaitTermination()
    facts = zones.StoredLedger(spark, root).transactions
    assert facts.count() == 3 and facts.select(F.max("transaction_id")).first()[0] == 3
