"""Small helpers on frames that the operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.operators.lookup import measured

# Rows and bytes that are broadcast at most: some tens of MB.
BROADCAST_IDS = 400_000
BROADCAST_BYTES = 48 << 20

# Rows of one Arrow batch: a thousand long texts still fit a Python worker.
BATCH_ROWS = 1000

SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Python workers get texts in batches of at most ``rows`` rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checked_join(
    big: DataFrame, small: DataFrame, on: Column | Sequence[str], how: str, limit: int = BROADCAST_IDS
) -> DataFrame:
    """Join to a written table of narrow rows: broadcast after a count of rows and bytes, shuffled
    beyond ``limit`` and ``BROADCAST_BYTES``.

    Both ways give the same rows; only the plan differs.
    """
    rows, size = measured(small)
    if rows <= limit and size <= BROADCAST_BYTES:
        small = F.broadcast(small)
    return big.join(small, on, how)


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def share(salt: str, *keys: str) -> Column:
    """Number from 0 to 1 that a row's keys alone decide."""
    digest = F.xxhash64(F.lit(salt), *[F.col(k) for k in keys])
    return F.pmod(digest, F.lit(1 << 30)) / F.lit(float(1 << 30))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, salt: str, id_col: str, text_col: str, rule: Column
) -> DataFrame:
    """About ``per_class`` labelled texts of each class, or all where there are fewer: ``text``,
    ``y``, how many labelled rows of its class one stands for (``weight``) and a number that
    spreads them evenly over parts (``part``), equal texts too.

    ``rule`` says which ids may be learned from.  Rows are chosen by a hash of the id,
    so a run over the same rows chooses the same.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & rule)
    counts = {r[0]: r[1] for r in known.groupBy(label).count().collect()}
    wanted, weight = F.lit(False), F.lit(1.0)
    for value, n in counts.items():
        wanted |= (F.col(label) == value) & (share(salt, id_col) < F.lit(min(1.0, per_class / n)))
        weight = F.when(F.col("y") == value, max(1.0, n / per_class)).otherwise(weight)
    chosen = known.filter(wanted).groupBy(id_col).agg(F.max(label).cast("int").alias("y"))
    texts = docs.filter(F.col(text_col).isNotNull()).select(id_col, F.col(text_col).alias("text"))
    # Two classes of ``per_class`` ids: within the bound of a broadcast by construction.
    part = F.xxhash64(F.lit("part"), id_col).alias("part")
    return texts.join(F.broadcast(chosen), id_col).select("text", "y", weight.alias("weight"), part)
