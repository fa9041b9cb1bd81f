"""Source jobs: land, stage, clean and load one sheet or all of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.plans import deltas, loading, marts
from coffer.plans.cleaning import clean_expenses
from coffer.plans.staging import as_batch, current_rows
from coffer.schema import STAGING_KEYS, TRANSACTIONS, Ledger
from coffer.session import materialise
from coffer.sources import key_index, manifest, zones
from coffer.sources.sheets import read_sheet, require_rows


@dataclass(frozen=True)
class Loaded:
    """Row counts of one load."""

    attempted: int
    loaded: int
    rejected: int = 0


@dataclass(frozen=True)
class Source:
    """One sheet: how its rows are keyed in the raw zone, cleaned and loaded.

    ``depends_on`` names the sources that must have run before, where they run at all.
    """

    name: str
    keys: Sequence[str] | None
    clean: Callable[[DataFrame], DataFrame] | None
    load: Callable[[SparkSession, str, DataFrame, Ledger, int], Loaded]
    depends_on: Sequence[str] = ()


def _facts_near(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """The facts between the first and last date of ``rows``.

    The natural key holds the date, so no other fact can match.  Where the facts lie
    in month folders the folders outside the range are not read.
    """
    first, last = rows.agg(F.min("transaction_date"), F.max("transaction_date")).first()
    near = facts.filter(F.col("transaction_date").between(F.lit(first), F.lit(last)))
    if first is not None and "yr" in facts.columns:
        month = F.col("yr") * 12 + F.col("mo")
        near = near.filter(month.between(first.year * 12 + first.month, last.year * 12 + last.month))
    return near


def _new_keys(spark: SparkSession, root: str, first: DataFrame, ledger: Ledger) -> tuple[DataFrame, DataFrame]:
    """Rows whose key the ledger lacks, and the facts near them.

    Where the ledger keeps a skipping index, facts are read for those keys alone that the
    index cannot rule out; without such a key none are.
    """
    near = _facts_near(first, ledger.transactions)
    index = key_index.read_index(spark, root)
    if index is None:
        return loading.not_yet_loaded(first, near), near
    # A row without an amount has no key; it is rejected later.
    asked = first.filter(F.col("amount").isNotNull())
    maybe = materialise(key_index.maybe_held(asked, index, loading.natural_key(asked), "transaction_date"), "maybe_held")
    if maybe.isEmpty():
        return first, near
    held = loading.facts_like(_facts_near(maybe, ledger.transactions), maybe)
    return loading.not_yet_loaded(first, materialise(held, "held")), near


def load_transactions(
    spark: SparkSession, root: str, cleaned: DataFrame, ledger: Ledger, run: int, source: str = "python"
) -> Loaded:
    """Insert what the ledger lacks; rows that break a constraint go to ``rejected``."""
    # Written once: texts are parsed here and nowhere after.
    first = materialise(loading.first_in_batch(loading.candidates(cleaned)), "candidates")
    return insert_candidates(spark, root, first, ledger, run, source)


def insert_candidates(
    spark: SparkSession, root: str, first: DataFrame, ledger: Ledger, run: int, source: str = "python"
) -> Loaded:
    """The same for candidates with one row per natural key, which should be written."""
    deltas.settle(ledger, root)
    unknown, near = _new_keys(spark, root, first, ledger)
    fresh = materialise(loading.as_transactions(unknown, ledger, source), "new_transactions")
    checked = materialise(loading.with_reject_reason(fresh, near), "checked_transactions")
    accepted = checked.filter("reject_reason IS NULL")
    rejected = checked.filter("reject_reason IS NOT NULL")
    counts = checked.agg(F.count(F.lit(1)), F.count("reject_reason")).first()
    if counts[1]:
        zones.write_run(rejected, f"{root}/rejected/transactions", run)
    if counts[0] > counts[1]:
        last = zones.last_transaction_id(spark, root)
        if last is None:  # the first load with a kept mark looks at the table
            last = ledger.transactions.agg(F.max("transaction_id")).first()[0] or 0
        zones.keep_transaction_id(spark, root, last + counts[0] - counts[1])
        numbered = loading.with_transaction_ids(accepted, last).select(*TRANSACTIONS.fieldNames())
        _append(spark, root, materialise(numbered, "numbered"), deltas.load_name(run, last + 1))
    return Loaded(attempted=counts[0], loaded=counts[0] - counts[1], rejected=counts[1])


def _append(spark: SparkSession, root: str, facts: DataFrame, load: str) -> None:
    """Append facts and bring what is kept beside them up to them.

    A ledger that begins with these facts keeps index and states from now on; one that has facts
    already keeps what was built for it.
    """
    begins = not zones.has_transactions(spark, root)
    if begins or key_index.read_index(spark, root) is not None:
        key_index.append_filters(facts, root, loading.natural_key(facts), "transaction_date", load)
    with_states = begins or deltas.read_states(spark, root) is not None
    if with_states:
        deltas.append_states(facts, root, load)
    zones.append_transactions(facts, root)
    if with_states:
        deltas.commit(spark, root, load)


def build_index(ledger: Ledger, root: str) -> None:
    """The skipping index of a ledger that has facts already, or a smaller one for it."""
    facts = ledger.transactions
    key_index.rebuild(facts, root, loading.natural_key(facts), "transaction_date")


def _write_upsert(root: str, table: str, upsert: loading.Upsert, sheet: DataFrame) -> Loaded:
    skipped = upsert.skipped.count()
    attempted = sheet.count()
    if attempted > skipped:
        zones.write_snapshot(upsert.merged, f"{root}/tables/{table}")
    return Loaded(attempted, attempted - skipped, skipped)


def load_plans(spark: SparkSession, root: str, sheet: DataFrame, ledger: Ledger, run: int) -> Loaded:
    return _write_upsert(root, "monthly_plans", loading.upsert_plans(ledger.monthly_plans, sheet), sheet)


def load_plan_items(spark: SparkSession, root: str, sheet: DataFrame, ledger: Ledger, run: int) -> Loaded:
    return _write_upsert(root, "monthly_plan_items", loading.upsert_plan_items(ledger, sheet), sheet)


SOURCES = (
    Source("plans", None, None, load_plans),
    # Items and transactions look up plans.
    Source("plan_items", ("year", "month", "category"), None, load_plan_items, depends_on=("plans",)),
    Source("expenses", STAGING_KEYS, clean_expenses, load_transactions, depends_on=("plans",)),
)


def in_order(sources: Iterable[Source]) -> list[Source]:
    """``sources`` with every one after those it depends on; otherwise as given.

    A dependency that is not among them is taken to have run before.
    """
    by_name = {s.name: s for s in sources}
    if unknown := {d for s in by_name.values() for d in s.depends_on} - {s.name for s in SOURCES} - set(by_name):
        raise ValueError(f"unknown dependencies: {sorted(unknown)}")
    graph = TopologicalSorter({name: [d for d in s.depends_on if d in by_name] for name, s in by_name.items()})
    return [by_name[name] for name in graph.static_order()]


def run_batch(
    spark: SparkSession, source: Source, sheet: DataFrame, root: str, batch_id: int, history: bool = False
) -> dict:
    """Stage, clean and load one extracted sheet.

    By default the new batch alone is taken, and only its partition is read.
    ``history=True`` takes up the rows of all batches again, so that rows rejected for a
    name unknown at the time get another chance; the cost grows with the raw zone.
    """
    batch = as_batch(sheet, batch_id)
    raw_path = zones.write_raw(batch, root, source.name)
    this_batch = zones.read_raw(spark, root, source.name, batch_id)
    rows_in_sheet = this_batch.count()

    rows = current_rows(zones.read_raw(spark, root, source.name) if history else this_batch, source.keys)
    if source.clean:
        rows = source.clean(rows)
    processed_path = zones.write_run(rows, f"{root}/processed/{source.name}", batch_id)
    processed = require_rows(spark.read.schema(rows.schema).parquet(processed_path), f"cleaned {source.name}")

    done = source.load(spark, root, processed, zones.StoredLedger(spark, root), batch_id)
    return {
        "source": source.name,
        "status": "ok",
        "rows_in_sheet": rows_in_sheet,
        "rows_attempted": done.attempted,
        "rows_loaded": done.loaded,
        "rows_rejected": done.rejected,
        "raw": raw_path,
        "processed": processed_path,
        "error": None,
    }


def run_source(
    spark: SparkSession, source: Source, root: str, batch_id: int, history: bool = False, new_only: bool = False
) -> dict:
    """The whole way of one source from its landing folder into the ledger.

    With ``new_only`` the batch takes the exports that no other batch took with it; without
    any the source is ``unchanged``.
    """
    if not new_only:
        sheet = read_sheet(spark, f"{root}/landing/{source.name}")
        require_rows(sheet, f"sheet {source.name}")
        return run_batch(spark, source, sheet, root, batch_id, history)

    found = manifest.new_files(spark, root, source.name, batch_id)
    if found is None:
        raise ValueError(f"nothing has landed for {source.name}")
    # Written before it is used: the listing may change while the batch runs.
    files = materialise(found, "new_files")
    new = manifest.paths(files)
    if not new:
        return {"source": source.name, "status": "unchanged", **dict.fromkeys(_COUNTS, 0)}
    sheet = read_sheet(spark, new)
    require_rows(sheet, f"sheet {source.name}")
    result = run_batch(spark, source, sheet, root, batch_id, history)
    manifest.note_taken(files, root, source.name, batch_id)
    return result


_COUNTS = ("rows_in_sheet", "rows_attempted", "rows_loaded", "rows_rejected")

RESULT_SCHEMA = (
    "source string, status string, rows_in_sheet bigint, rows_attempted bigint, rows_loaded bigint, "
    "rows_rejected bigint, raw string, processed string, error string"
)


def run_sources(
    spark: SparkSession,
    root: str,
    batch_id: int,
    only: Iterable[str] | None = None,
    history: bool = False,
    new_only: bool = False,
    sources: Iterable[Source] = SOURCES,
) -> DataFrame:
    """Run all sources, or those named in ``only``; one that fails does not stop the rest.

    By default a run takes all that lies in the landing folders, as a sheet that is exported
    whole each time asks for.  Where exports pile up, ``new_only=True`` takes each once.
    A run with ``history=True`` now and then offers rejected rows again.
    """
    if batch_id >= zones.STREAM_BATCHES:
        raise ValueError(f"batch ids from {zones.STREAM_BATCHES} on belong to streams")
    ordered = in_order(sources)
    wanted = None if only is None else set(only)
    unknown = (wanted or set()) - {s.name for s in ordered}
    if unknown:
        raise ValueError(f"unknown sources: {sorted(unknown)}")
    results = []
    for source in ordered:
        if wanted is not None and source.name not in wanted:
            continue
        try:
            results.append(run_source(spark, source, root, batch_id, history, new_only))
        except Exception as error:
            results.append({"source": source.name, "status": "error", "error": str(error)})
    return spark.createDataFrame(results, RESULT_SCHEMA)


def overall_status(results: DataFrame) -> str:
    """``ok``, or ``partial_failure`` when any source failed."""
    return "ok" if results.filter("status = 'error'").isEmpty() else "partial_failure"


def write_marts(ledger: Ledger, root: str, run: int) -> dict[str, str]:
    """Write the three marts; staging stays a plan.

    Where spend states are kept the marts come from them and no fact is read.
    """
    states = deltas.merged_states(ledger.accounts.sparkSession, root)
    if states is not None:
        plans = deltas.marts_of(states, ledger)
    else:
        plans = {
            "mart_monthly_summary": marts.mart_monthly_summary(ledger),
            "mart_category_breakdown": marts.mart_category_breakdown(ledger),
            "mart_top_merchants": marts.mart_top_merchants(ledger),
        }
    return {name: zones.write_run(plan, f"{root}/marts/{name}", run) for name, plan in plans.items()}
