"""Joins of facts to lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.functions.text import fold
from coffer.functions.dates import month_number

# A lookup table within both bounds is some tens of MB when broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
SALTS = 32


def measured(df: DataFrame) -> tuple[int, int]:
    """Row count and bytes: 16 for each cell, and the length of texts.

    One aggregate: each task sends one row.  ``df`` should be a stored table.
    """
    texts = [F.col(f"`{name}`") for name, kind in df.dtypes if kind == "string"]
    length = sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in texts), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(length.cast("bigint"))).first()
    return rows, (size or 0) + 16 * rows * len(df.columns)


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    salt_by: Sequence[str] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Join ``fact`` to a lookup table with unique keys.

    The lookup side is counted and measured first.  Within ``max_rows`` rows and
    ``BROADCAST_BYTES`` it is broadcast and the facts are not moved.  Beyond it both sides are shuffled, with
    the facts spread over ``SALTS`` parts per key and the lookup rows repeated per
    part: a key that holds a third of the facts (NULL keys included) then still
    fills only a 1/``SALTS`` share of that third in any one task.

    The lookup side is evaluated for the count and again for the join, so one that is
    computed from facts should be written first (``session.materialise``).  ``rows`` is
    an upper bound of its rows the caller has counted already, for rows of a few numbers
    and names.

    The salt is a hash of ``salt_by`` (by default all fact columns), so a task that
    runs again after a lost executor puts each row where it was before.
    """
    on = list(on)
    count, size = measured(lookup) if rows is None else (rows, 0)
    if count <= max_rows and size <= BROADCAST_BYTES:
        return fact.join(F.broadcast(lookup), on, how)
    salt = F.pmod(F.xxhash64(*(salt_by or fact.columns)), F.lit(SALTS))
    salted_fact = fact.withColumn("_salt", salt.cast("int"))
    salted_lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted_fact.join(salted_lookup, [*on, "_salt"], how).drop("_salt")


def resolve_name(
    rows: DataFrame,
    name: str,
    lookup: DataFrame,
    lookup_name: str,
    lookup_id: str,
    within: Sequence[str] = (),
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``lookup_id`` for the text in column ``name``; NULL when blank or unknown.

    Names match after trimming and lower-casing.  When several lookup rows fold to
    one name the highest id wins.  ``within`` names columns that must agree as well,
    such as the parent of a subcategory.
    """
    within = list(within)
    ids = (
        lookup.select(fold(F.col(lookup_name)).alias("_name"), *within, F.col(lookup_id))
        .filter(F.col("_name") != "")
        .groupBy("_name", *within)
        .agg(F.max(lookup_id).alias(lookup_id))
    )
    keyed = rows.withColumn("_name", fold(F.col(name)))
    # One id per name at most, so the rows of the table itself bound the lookup side.
    at_most, size = measured(lookup.select(lookup_name, lookup_id))
    if size > BROADCAST_BYTES:
        at_most = max_rows + 1
    return lookup_join(keyed, ids, ["_name", *within], max_rows=max_rows, rows=at_most).drop("_name")


def unresolved_names(rows: DataFrame, name: str, resolved_id: str) -> DataFrame:
    """Non-blank names that found no id, with the number of rows each affects."""
    return (
        rows.filter((fold(F.col(name)) != "") & F.col(resolved_id).isNull())
        .groupBy(fold(F.col(name)).alias("name"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def plan_of_month(rows: DataFrame, plans: DataFrame, yr: Column, mo: Column) -> DataFrame:
    """Add ``plan_id`` of the month ``yr``/``mo``; NULL when that month has no plan.

    One row per calendar month, so the lookup side is small by nature; it is
    checked all the same.
    """
    months = plans.groupBy(
        month_number(F.col("plan_year").cast("int"), F.col("plan_month").cast("int")).alias("_month")
    ).agg(F.max("plan_id").alias("plan_id"))
    keyed = rows.withColumn("_month", month_number(yr, mo))
    return lookup_join(keyed, months, ["_month"], rows=plans.count()).drop("_month")
