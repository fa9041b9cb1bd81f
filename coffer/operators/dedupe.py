"""One row per key, chosen by an explicit order.

``row_number() = 1`` lets Spark drop the losers of each key before the shuffle
(``WindowGroupLimit``), so a key that fills a third of the input reaches the final
task with at most one row per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coffer.functions.text import null_to_blank


def _one_per_key(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def text_keys(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Key columns compared as text, NULL being the same as blank."""
    return [null_to_blank(df[f"`{n}`"].cast("string")) for n in names]


def keep_last(df: DataFrame, keys: Sequence[Column], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, [F.desc(c) for c in order])


def keep_first(df: DataFrame, keys: Sequence[Column], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, [F.asc(c) for c in order])
