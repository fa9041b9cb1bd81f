"""Exact quantiles per group without gathering a group.

Equal values are counted first.  What is left is put in order over the whole table by
range partitions, each of which knows how many rows lie before it, so the rank of every
value is known and no group meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coffer.operators.lookup import lookup_join
from coffer.operators.ranking import part_offsets, ranged
from coffer.session import materialise


def exact_quantiles(
    df: DataFrame, key: str, value: str, shares: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """One row per ``key`` (never NULL) with the quantiles of ``value`` as columns ``names``.

    Values are interpolated between the two nearest ranks; NULL values do not count.
    """
    rows = df.select(key, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    counted = rows.groupBy(key, "_v").agg(F.count(F.lit(1)).alias("_n"))
    parts = ranged(counted, [F.col(key), F.col("_v")], "quantile_values")
    offsets = part_offsets(parts, F.sum("_n"))
    earlier = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = materialise(
        parts.join(F.broadcast(offsets), "_part").select(
            key, "_v", "_n", (F.col("_offset") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))).alias("_start")
        ),
        "quantile_places",
    )
    # Where a group begins in the order of all rows, and how many rows it has.
    groups = materialise(
        placed.groupBy(key).agg(F.min("_start").alias("_first"), F.sum("_n").alias("_rows")), "quantile_groups"
    )
    within = lookup_join(placed, groups, [key], how="inner").withColumn("_start", F.col("_start") - F.col("_first"))
    last = F.col("_rows") - 1
    found, quantiles = [], []
    for i, (share, name) in enumerate(zip(shares, names)):
        rank = last * F.lit(float(share))
        for side, place in (("a", F.floor(rank)), ("b", F.ceil(rank))):
            here = (F.col("_start") <= place) & (place < F.col("_start") + F.col("_n"))
            found.append(F.max(F.when(here, F.col("_v"))).alias(f"_{side}{i}"))
        step = F.col(f"_b{i}") - F.col(f"_a{i}")
        quantiles.append((F.col(f"_a{i}") + step * (rank - F.floor(rank))).alias(name))
    return within.groupBy(key, "_rows").agg(*found).select(key, *quantiles)
