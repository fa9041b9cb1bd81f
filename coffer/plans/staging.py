"""Raw zone: append sheets as text, keep the last row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.functions.text import ROW_ORDER, lower_headers, text_columns
from coffer.operators.dedupe import keep_last, text_keys
from coffer.schema import STAGING_KEYS


def as_batch(sheet: DataFrame, batch_id: int) -> DataFrame:
    """A sheet ready for the raw zone: lower-case headers, all text, tagged with its batch."""
    df = lower_headers(sheet)
    text = [F.col(f"`{c}`").cast("string").alias(c) for c in text_columns(df)]
    return df.select(*text, F.lit(batch_id).cast("bigint").alias("_batch_id"), "_row_idx")


def current_rows(raw: DataFrame, keys: Sequence[str] | None = STAGING_KEYS) -> DataFrame:
    """The last row per key over all batches.

    Those of ``keys`` that the sheet has make up the key; without any, the whole
    row does.  ``keys=None`` asks for the whole row.
    """
    present = [k for k in keys or () if k in raw.columns]
    return keep_last(raw, text_keys(raw, present or text_columns(raw)), ROW_ORDER)


def stage_append(
    existing: DataFrame | None, batch: DataFrame, keys: Sequence[str] | None = STAGING_KEYS
) -> DataFrame:
    """Existing raw rows and a new batch, aligned by column name, last row per key kept."""
    merged = batch if existing is None else existing.unionByName(batch, allowMissingColumns=True)
    return current_rows(merged, keys)
