"""Check states of batches, merged and held against each other."""

from __future__ import annotations

import math

from conftest import rows
from ledgers import ledger, tx

from coffer.plans import check_states, quality


def events(first, n, bad_every):
    """Rows of which each ``bad_every``-th names an account that does not exist."""
    return [
        tx(i, "2024-03-05", 10 + i, account=77 if i % bad_every == 0 else 2, category=1, sub=None, note=f"note {i % 50}")
        for i in range(first, first + n)
    ]


def test_merged_states_equal_the_full_report(spark, tmp_path):
    root = str(tmp_path)
    parts = [events(1, 60, 5), events(100, 90, 7), events(300, 10, 2)]
    for batch, part in enumerate(parts, 1):
        check_states.check_batch(ledger(spark, part).transactions, ledger(spark), root, batch)
    whole = ledger(spark, [e for part in parts for e in part])
    full = {r["check_name"]: r["failed"] for r in quality.dq_report(whole).collect()}
    merged = check_states.merged_report(spark, root).collect()
    assert len(merged) == len(quality.transaction_checks())
    assert all(r["failed"] == full[r["check_name"]] and r["checked"] == 160 for r in merged)
    totals = check_states.merged_totals(spark, root).first()
    amounts = [int(e[8]) for part in parts for e in part]
    mean = sum(amounts) / 160
    assert totals["n_rows"] == 160 and totals["mean_amount"] == mean
    assert math.isclose(totals["deviation"], math.sqrt(sum((a - mean) ** 2 for a in amounts) / 160))
    assert abs(totals["about_keys"] - 160) <= 5
    # A batch that is checked again counts once.
    check_states.check_batch(ledger(spark, parts[1]).transactions, ledger(spark), root, 2)
    assert rows(check_states.merged_report(spark, root)) == sorted(map(tuple, merged), key=repr)


def test_drift_is_found_in_the_batch_that_has_it(spark, tmp_path):
    root, book = str(tmp_path), ledger(spark)
    for batch, part in enumerate([events(0, 200, 20), events(200, 200, 20), events(400, 200, 4), events(600, 200, 4)], 1):
        check_states.check_batch(ledger(spark, part).transactions, book, root, batch)
    name = "relationship:transactions.account_id"
    found = {b: {r["check_name"]: r for r in check_states.drift(spark, root, b).collect()} for b in (1, 2, 3)}
    assert found[1][name]["z"] is None and not found[1][name]["drifted"]
    assert found[2][name]["z"] == 0 and not found[2][name]["drifted"]
    hit = found[3][name]
    p = (hit["failed"] + hit["failed_before"]) / 600
    z = (50 / 200 - 20 / 400) / math.sqrt(p * (1 - p) * (1 / 200 + 1 / 400))
    assert hit["drifted"] and math.isclose(hit["z"], z, abs_tol=1e-6)
    assert sum(r["drifted"] for r in found[3].values()) == 1


def test_nothing_checked_yet(spark, tmp_path):
    assert check_states.merged_report(spark, str(tmp_path)).count() == 0
    assert check_states.drift(spark, str(tmp_path), 1).count() == 0
    check_states.check_batch(ledger(spark).transactions, ledger(spark), str(tmp_path), 1)
    assert all(r["failed"] == r["checked"] == 0 for r in check_states.merged_report(spark, str(tmp_path)).collect())
    assert check_states.drift(spark, str(tmp_path), 1).filter("z IS NOT NULL OR drifted").count() == 0
