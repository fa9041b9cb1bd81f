"""What a ledger keeps beside its facts: manifest of exports, skipping index, spend states."""

from __future__ import annotations

import dataclasses
import os

import pytest
from conftest import rows
from ledgers import ledger, tx
from pyspark.sql import functions as F
from test_jobs import EXPENSES, FIRST, SECOND, explained, land, land_all, summary

from coffer.plans import deltas, jobs, loading, marts
from coffer.sources import key_index, manifest, zones
from coffer.streaming import incremental


def export(n, notes):
    return EXPENSES + "".join(
        f'"{n}/5/2024",expense (ACB),expense,extra,cash,Food & Drinks,Snacks,"{61 + i}",{note},\n' for i, note in enumerate(notes)
    )


def run_new(spark, root, batch, **options):
    return summary(jobs.run_sources(spark, root, batch, only=["expenses"], new_only=True, **options))


def test_twelve_drops_leave_the_rows_of_twelve_drops(spark, tmp_path):
    root = str(tmp_path)
    for n in range(1, 13):
        land(tmp_path, "expenses", export(n, [f"drop {n}", f"more {n}"]), f"drop={n}")
        assert run_new(spark, root, n) == [("expenses", "ok", 2, 2, 0)]
    assert zones.read_raw(spark, root, "expenses").count() == 24
    assert zones.StoredLedger(spark, root).transactions.count() == 24
    # Nothing new: nothing is staged, and the job is content.
    again = jobs.run_sources(spark, root, 13, only=["expenses"], new_only=True)
    assert summary(again) == [("expenses", "unchanged", 0, 0, 0)] and jobs.overall_status(again) == "ok"
    assert zones.read_raw(spark, root, "expenses").count() == 24
    assert manifest.taken_files(spark, root, "expenses").count() == 12


def test_a_batch_that_runs_again_takes_its_own_files(spark, tmp_path):
    root = str(tmp_path)
    land(tmp_path, "expenses", export(1, ["a"]), "one")
    run_new(spark, root, 1)
    land(tmp_path, "expenses", export(2, ["b", "c"]), "two")
    assert run_new(spark, root, 2) == [("expenses", "ok", 2, 2, 0)]
    assert run_new(spark, root, 2) == [("expenses", "ok", 2, 0, 0)]
    assert zones.read_raw(spark, root, "expenses").count() == 3
    assert sorted(r["batch"] for r in manifest.taken_files(spark, root, "expenses").collect()) == [1, 2]


def test_a_failed_batch_leaves_its_files_to_the_next(spark, tmp_path):
    root = str(tmp_path)
    land(tmp_path, "expenses", export(1, ["a"]), "one")

    def broken(*_):
        raise RuntimeError("lost")

    source = next(s for s in jobs.SOURCES if s.name == "expenses")
    failed = jobs.run_sources(spark, root, 1, new_only=True, sources=[dataclasses.replace(source, load=broken)])
    assert [r["error"] for r in failed.collect()] == ["lost"]
    assert run_new(spark, root, 2) == [("expenses", "ok", 1, 1, 0)]


def test_a_file_written_anew_is_another_file(spark, tmp_path):
    root = str(tmp_path)
    assert "landed" in jobs.run_sources(spark, root, 1, only=["expenses"], new_only=True).first()["error"]
    land(tmp_path, "expenses", export(1, ["a"]), "one")
    run_new(spark, root, 1)
    land(tmp_path, "expenses", export(1, ["a", "b"]), "one")
    assert run_new(spark, root, 2) == [("expenses", "ok", 2, 1, 0)]
    # Equal bytes at another time; hidden names are no exports.
    os.utime(tmp_path / "landing" / "expenses" / "one.csv", (1_800_000_000, 1_800_000_000))
    land(tmp_path, "expenses", export(3, ["hidden"]), "_draft")
    assert run_new(spark, root, 3) == [("expenses", "ok", 2, 0, 0)]


def test_sources_run_after_those_they_depend_on():
    plans, items, expenses = jobs.SOURCES
    assert [s.name for s in jobs.in_order([expenses, items, plans])] == ["plans", "expenses", "plan_items"]
    assert [s.name for s in jobs.in_order([expenses])] == ["expenses"]
    with pytest.raises(ValueError):
        jobs.in_order([dataclasses.replace(plans, depends_on=("expenses",)), expenses])
    with pytest.raises(ValueError):
        jobs.in_order([dataclasses.replace(plans, depends_on=("nowhere",))])


def key():
    return [F.col("k"), F.col("day")]


def keyed(spark, first, n, month="2024-03"):
    return spark.range(first, first + n).selectExpr(
        "concat('key ', id) AS k", f"date_add(date'{month}-01', cast(id % 28 AS int)) AS day"
    )


def test_no_held_key_is_missed_and_few_new_ones_are_suspected(spark, tmp_path):
    root = str(tmp_path)
    key_index.append_filters(keyed(spark, 0, 9000), root, key(), "day", "a")
    key_index.append_filters(keyed(spark, 9000, 500), root, key(), "day", "b")
    key_index.append_filters(keyed(spark, 0, 50, "2024-04"), root, key(), "day", "b")
    index = key_index.read_index(spark, root)
    assert index.filter("mo = 3 AND load = 'a'").select("blocks").distinct().collect()[0][0] == 5
    held = keyed(spark, 0, 9500)
    assert key_index.maybe_held(held, index, key(), "day").count() == 9500
    new = keyed(spark, 100_000, 20_000)
    suspected = key_index.maybe_held(new, index, key(), "day").count()
    assert 0 < suspected < 20_000 * 0.005
    # Another month, other rows alike: told apart by the folder.
    assert key_index.maybe_held(keyed(spark, 0, 2000, "2025-03"), index, key(), "day").count() == 0
    assert key_index.maybe_held(keyed(spark, 0, 0), index, key(), "day").count() == 0
    key_index.rebuild(held, root, key(), "day")
    again = key_index.read_index(spark, root)
    assert {r[0] for r in again.select("load").distinct().collect()} == {"all"}
    assert key_index.maybe_held(held, again, key(), "day").count() == 9500
    # The same load again replaces its own filters.
    key_index.append_filters(keyed(spark, 0, 10), root, key(), "day", "all")
    assert key_index.read_index(spark, root).filter("mo = 3").count() == 1


def test_new_keys_are_loaded_without_reading_facts(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    land_all(tmp_path, export(1, ["a", "b"]))
    jobs.run_sources(spark, root, 1)
    read = []
    real = loading.not_yet_loaded
    monkeypatch.setattr(loading, "not_yet_loaded", lambda first, facts: read.append(facts.inputFiles()) or real(first, facts))
    land(tmp_path, "expenses", export(2, ["a", "b", "c"]))
    assert summary(jobs.run_sources(spark, root, 2, only=["expenses"])) == [("expenses", "ok", 3, 3, 0)]
    assert read == []
    land(tmp_path, "expenses", export(2, ["a", "new", "c"]) + export(1, ["a"]).removeprefix(EXPENSES))
    assert summary(jobs.run_sources(spark, root, 3, only=["expenses"])) == [("expenses", "ok", 4, 1, 0)]
    assert len(read) == 1


def test_facts_are_not_moved_to_be_compared(spark, tmp_path):
    facts = ledger(spark, [tx(i, f"2024-0{i % 3 + 1}-05", 10 + i, note=f"n{i}") for i in range(30)]).transactions
    zones.append_transactions(facts, str(tmp_path))
    stored = zones.read_transactions(spark, str(tmp_path))
    asked = facts.filter("transaction_id < 4")
    held = loading.facts_like(stored, asked)
    assert sorted(r[0] for r in held.select("transaction_id").collect()) == [0, 1, 2, 3]
    plan = explained(held)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    shuffled = loading.facts_like(stored, asked, max_rows=2)
    assert sorted(r[0] for r in shuffled.select("transaction_id").collect()) == [0, 1, 2, 3]


EVENTS = [
    tx(i, f"202{i % 3}-{i % 12 + 1:02}-1{i % 9}", 10 + i, category=i % 4 or None, sub=i % 5 or None,
       kind=["expense", "credit_purchase", "income"][i % 3], spending=["fixed", "extra", None][i % 3 - 1], regret=i % 7 == 0)
    for i in range(1, 200)
]


def same_marts(spark, root, book):
    merged = deltas.marts_of(deltas.merged_states(spark, root), book)
    for name, plan in merged.items():
        assert rows(plan) == rows(getattr(marts, name)(book)), name
        assert plan.dtypes == getattr(marts, name)(book).dtypes, name


def test_marts_from_deltas_equal_those_from_all_facts(spark, tmp_path):
    root, book = str(tmp_path), ledger(spark, EVENTS)
    facts = book.transactions
    deltas.add(facts.filter("transaction_id % 3 = 1"), root, "run1-1")
    deltas.add(facts.filter("transaction_id % 3 = 2"), root, "run2-2")
    # Late rows: of months that were written before.
    deltas.add(facts.filter("transaction_id % 3 = 0"), root, "run3-3")
    same_marts(spark, root, book)
    assert deltas.differing_months(book, root).isEmpty()
    deltas.append_states(facts.filter("transaction_id % 3 = 2"), root, "run2-2")
    same_marts(spark, root, book)
    some = deltas.merged_states(spark, root, months=[12 * 2021 + 2])
    assert {(r["yr"], r["mo"]) for r in some.collect()} == {(2021, 2)}
    deltas.add(facts.filter("transaction_id < 5"), root, "run9-9")
    assert not deltas.differing_months(book, root).isEmpty()
    deltas.build_states(book, root)
    same_marts(spark, root, book)


def test_a_load_that_stopped_halfway_is_settled(spark, tmp_path):
    root, book = str(tmp_path), ledger(spark, EVENTS)
    facts = book.transactions
    deltas.add(facts, root, "run1-1")
    # One stopped before its facts were appended, one after.
    deltas.append_states(facts.filter("transaction_id < 9"), root, "run2-900")
    deltas.append_states(facts.filter("transaction_id = 17"), root, "run3-17")
    same_marts(spark, root, book)
    deltas.settle(book, root)
    twice = deltas.merged_states(spark, root).agg(F.sum("n")).first()[0]
    spend = marts.spend_facts(book)
    assert twice == spend.count() + spend.filter("id = 17").count()
    deltas.settle(book, root)
    assert deltas.merged_states(spark, root).agg(F.sum("n")).first()[0] == twice


def test_loads_keep_states_and_marts_read_them_alone(spark, tmp_path):
    root = str(tmp_path)
    land_all(tmp_path, FIRST)
    jobs.run_sources(spark, root, 1)
    land(tmp_path, "expenses", export(1, ["late"]) + export(3, ["x", "y"]).removeprefix(EXPENSES))
    jobs.run_sources(spark, root, 2, only=["expenses"])
    book = zones.StoredLedger(spark, root)
    same_marts(spark, root, book)
    states = deltas.merged_states(spark, root)
    assert not any("tables/transactions" in f for f in states.inputFiles())
    # January was in both loads, March in one: three folders.
    assert deltas.read_states(spark, root).select("load", "yr", "mo").distinct().count() == 3
    paths = jobs.write_marts(book, root, run=1)
    assert rows(spark.read.parquet(paths["mart_monthly_summary"])) == rows(marts.mart_monthly_summary(book))


def test_a_ledger_without_states_or_index_works_as_before(spark, tmp_path):
    root = str(tmp_path)
    zones.append_transactions(ledger(spark, EVENTS[:5]).transactions, root)
    land_all(tmp_path, FIRST)
    jobs.run_sources(spark, root, 1)
    assert deltas.read_states(spark, root) is None and key_index.read_index(spark, root) is None
    book = zones.StoredLedger(spark, root)
    jobs.build_index(book, root)
    deltas.build_states(book, root)
    same_marts(spark, root, book)
    land(tmp_path, "expenses", export(5, ["new"]) + export(1, ["tea"]).removeprefix(EXPENSES))
    assert summary(jobs.run_sources(spark, root, 2, only=["expenses"])) == [("expenses", "ok", 2, 2, 0)]
    assert key_index.read_index(spark, root).select("load").distinct().count() == 2
    same_marts(spark, root, zones.StoredLedger(spark, root))


def streamed(spark, root, monkeypatch, **options):
    """How many candidates the stream hands over, and facts after it."""
    offered = []
    real = incremental.insert_candidates
    monkeypatch.setattr(incremental, "insert_candidates", lambda *a: offered.append(a[2].count()) or real(*a))
    incremental.stream_transactions(spark, root, EXPENSES.strip().split(","), **options).awaitTermination()
    monkeypatch.setattr(incremental, "insert_candidates", real)
    return sum(offered), zones.StoredLedger(spark, root).transactions.count()


def test_keys_seen_by_the_stream_are_not_offered_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    land(tmp_path, "expenses", FIRST, "one")
    # Dated, readable rows of the sheet: one has an unknown account and is rejected by the ledger.
    assert streamed(spark, root, monkeypatch) == (3, 2)
    land(tmp_path, "expenses", SECOND, "two")
    assert streamed(spark, root, monkeypatch) == (1, 3)
    assert streamed(spark, root, monkeypatch) == (0, 3)
    # Late: an old file with an old purchase, and one that is known.
    land(tmp_path, "expenses", export(1, ["old"]) + SECOND.removeprefix(EXPENSES), "late")
    os.utime(tmp_path / "landing" / "expenses" / "late.csv", (1_600_000_000, 1_600_000_000))
    assert streamed(spark, root, monkeypatch) == (1, 4)


def test_keys_that_left_the_state_are_told_from_the_ledger(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    land(tmp_path, "expenses", FIRST, "one")
    assert streamed(spark, root, monkeypatch, within="0 seconds") == (3, 2)
    (tmp_path / "checkpoints").rename(tmp_path / "lost")
    land(tmp_path, "expenses", SECOND, "two")
    # Progress and state are lost: all keys of both files pass once, and one is new.
    assert streamed(spark, root, monkeypatch) == (4, 3)
