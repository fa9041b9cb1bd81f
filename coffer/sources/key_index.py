"""Skipping index over the keys of facts: Bloom filters by month folder and load.

``tables/transaction_keys`` holds bitmaps of ``BLOCK_BITS`` bits.  A load writes, for each
month it adds to, as many blocks as its keys there need; a key sets ``HASHES`` bits of one of
them.  A key of which some bit is missing in every load's block is not in the ledger, so its
folder need not be read.  The reverse is not certain: about one new key in a thousand seems to
be held, and is compared with the facts of its day.

Filters are written before the facts they stand for.  A load that fails in between leaves bits
too many, never too few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.operators.lookup import lookup_join
from coffer.session import materialise
from coffer.sources.zones import read_or_none

# Bits of a bitmap as Spark's bitmap functions make them, and what a key takes of them.
BLOCK_BITS = 32768
BITS_PER_KEY = 16
HASHES = 6

_SCHEMA = "blocks BIGINT, block BIGINT, bits BINARY, yr INT, mo INT, load STRING"
_MONTH = ["yr", "mo"]


def _path(root: str) -> str:
    return f"{root}/tables/transaction_keys"


def read_index(spark: SparkSession, root: str) -> DataFrame | None:
    """All filters, or None where a ledger keeps none."""
    return read_or_none(spark, _path(root), _SCHEMA)


def _places(key: Sequence[Column]) -> tuple[Column, list[Column]]:
    """The number that chooses a key's block, and its places in it."""
    text = [k.cast("string") for k in key]
    first = F.pmod(F.xxhash64(F.lit("first"), *text), F.lit(BLOCK_BITS))
    step = F.pmod(F.xxhash64(F.lit("step"), *text), F.lit(BLOCK_BITS // 2)) * 2 + 1
    return F.xxhash64(F.lit("block"), *text), [(first + step * i) % BLOCK_BITS for i in range(HASHES)]


def _dated(rows: DataFrame, key: Sequence[Column], day: str) -> DataFrame:
    choice, places = _places(key)
    return rows.select(
        F.year(day).alias("yr"), F.month(day).alias("mo"), choice.alias("choice"), F.array(*places).alias("places")
    )


def filters(rows: DataFrame, key: Sequence[Column], day: str) -> DataFrame:
    """Filters of the keys of ``rows``: ``yr, mo, blocks, block, bits``."""
    keys = materialise(_dated(rows, key, day).filter(F.col("yr").isNotNull()), "index_keys")
    per_block = BLOCK_BITS // BITS_PER_KEY
    months = keys.groupBy(*_MONTH).agg(F.ceil(F.count(F.lit(1)) / per_block).cast("bigint").alias("blocks"))
    # A row per month: the lookup counts them and takes the small way.
    placed = lookup_join(keys, materialise(months, "index_months"), _MONTH)
    bits = placed.select(
        *_MONTH, "blocks", F.expr("pmod(choice, blocks)").alias("block"), F.explode("places").alias("place")
    )
    return bits.groupBy(*_MONTH, "blocks", "block").agg(F.bitmap_construct_agg("place").alias("bits"))


def append_filters(rows: DataFrame, root: str, key: Sequence[Column], day: str, load: str) -> None:
    """Add the filters of a load, whose name no other load has."""
    found = filters(rows, key, day).withColumn("load", F.lit(load))
    (
        found.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_MONTH, "load")
        .parquet(_path(root))
    )


def rebuild(facts: DataFrame, root: str, key: Sequence[Column], day: str) -> None:
    """Filters of all facts, in place of those there are: one set per month again."""
    found = materialise(filters(facts, key, day).withColumn("load", F.lit("all")), "index")
    (
        found.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*_MONTH, "load")
        .parquet(_path(root))
    )


def _is_set(place: Column) -> Column:
    byte = F.conv(F.hex(F.substring("bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def maybe_held(rows: DataFrame, index: DataFrame, key: Sequence[Column], day: str) -> DataFrame:
    """Rows whose key some filter of their month may hold; all others are certain to be new.

    Only the bitmaps of the rows' months are read, and of these one block per load and key.
    """
    choice, places = _places(key)
    asked = rows.withColumns(
        {"_yr": F.year(day), "_mo": F.month(day), "_choice": choice, "_places": F.array(*places)}
    )
    months = asked.select(F.col("_yr").alias("yr"), F.col("_mo").alias("mo")).distinct()
    near = materialise(index.join(F.broadcast(materialise(months, "asked_months")), _MONTH), "index_near")
    loads = near.select(*_MONTH, "load", "blocks").distinct().withColumnsRenamed({"yr": "_yr", "mo": "_mo"})
    probes = lookup_join(asked, materialise(loads, "loads"), ["_yr", "_mo"], how="inner")
    probes = probes.withColumn("_block", F.expr("pmod(_choice, blocks)"))
    blocks = near.select(
        F.col("yr").alias("_yr"), F.col("mo").alias("_mo"), "load", F.col("block").alias("_block"), "bits"
    )
    hit = probes.join(blocks, ["_yr", "_mo", "load", "_block"])
    return hit.filter(F.forall("_places", _is_set)).select(*rows.columns).distinct()
