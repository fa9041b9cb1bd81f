"""Ranking and numbering over a whole table without a single-task sort.

A window without partition keys moves every row to one task.  That is fine for a
frame that is small by nature or by count; the operators here count first and take
the distributed way beyond the limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coffer.operators.lookup import lookup_join
from coffer.session import materialise

ONE_TASK_ROWS = 1_000_000

# A partition-local id keeps its position in the low 33 bits.
_POSITION_BITS = (1 << 33) - 1


def ranged(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` range-partitioned and sorted, written once with its part and position."""
    return materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS))),
        name,
    )


def part_offsets(parts: DataFrame, size: Column) -> DataFrame:
    """Total ``size`` of all earlier parts.  One row per shuffle partition, so small."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("_part").agg(size.alias("_size"))
    return sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))


def number_rows(
    df: DataFrame, order: Sequence[str], out: str, start: int = 0, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """Number the rows ``start + 1, start + 2, ...`` in the total order of ``order``."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    if one_task_rows and df.count() <= one_task_rows:
        return df.withColumn(out, (F.row_number().over(Window.orderBy(*keys)) + F.lit(start)).cast("bigint"))
    parts = ranged(df, keys, "numbered")
    offsets = part_offsets(parts, F.count(F.lit(1)))
    return (
        parts.join(F.broadcast(offsets), "_part")
        .withColumn(out, (F.col("_offset") + F.col("_pos") + F.lit(start + 1)).cast("bigint"))
        .drop("_part", "_pos", "_offset")
    )


def rank_desc(
    df: DataFrame, value: str, out: str, one_task_rows: int = ONE_TASK_ROWS, rows: int | None = None
) -> DataFrame:
    """Competition rank (1, 2, 2, 4) by falling ``value`` (never NULL) over the whole frame.

    ``rows`` is an upper bound the caller already knows; without one the frame is
    counted.  The distributed way ranks the distinct values, so
    rows that tie never meet in one task.
    """
    bound = rows if rows is not None else df.count()
    if bound <= one_task_rows:
        return df.withColumn(out, F.rank().over(Window.orderBy(F.desc(value))))
    df = materialise(df, "rank_input")
    per_value = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    parts = ranged(per_value, [F.col(value).desc_nulls_last()], "rank_values")
    earlier = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        parts.join(F.broadcast(part_offsets(parts, F.sum("_n"))), "_part")
        .withColumn("_before", F.col("_offset") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(value, (F.col("_before") + 1).cast("int").alias(out))
    )
    return lookup_join(df, ranks, [value])
