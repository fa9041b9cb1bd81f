"""Sharding along a Hilbert curve through the metadata of documents.

Source, language and size are cut to a few steps each, by the share of rows that come
before a value in the order of all values; the Hilbert index of the cell puts cells that are
near in all three next to each other.  Rows in that order are cut into runs of equal numbers
of rows, so each shard covers a small box and files can be skipped by any of the three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coffer.llm.frames import checked_join
from coffer.operators.ranking import number_rows, part_offsets, ranged
from coffer.session import materialise

SHARDS = 16

# Steps of each dimension, as bits.
BITS = 5
DIMS = 3


def _gray_tables(n: int) -> tuple[list[int], list[int], list[int]]:
    """For each corner of an ``n``-cube: its place on the Gray path, and by place the entry
    corner and the direction of the part of the curve there."""
    size = 1 << n
    gray = [i ^ (i >> 1) for i in range(size)]
    place = [gray.index(c) for c in range(size)]
    entry = [0 if i == 0 else gray[2 * ((i - 1) // 2)] for i in range(size)]
    ones = lambda i: (i ^ (i + 1)).bit_length() - 1
    turn = [0 if i == 0 else ones(i - 1 if i % 2 == 0 else i) % n for i in range(size)]
    return place, entry, turn


def _pick(values: list[int], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def _rotated(x: Column, by: Column, n: int, left: bool) -> Column:
    """The low ``n`` bits of ``x`` turned by 0 to ``n - 1`` places."""
    mask = (1 << n) - 1
    out = x
    for k in range(1, n):
        step = k if left else n - k
        turned = F.shiftleft(x, step).bitwiseOR(F.shiftright(x, n - step)).bitwiseAND(F.lit(mask))
        out = F.when(by == k, turned).otherwise(out)
    return out


def hilbert_index(coordinates: list[Column], bits: int = BITS) -> Column:
    """Place of a cell on the Hilbert curve of ``bits`` bits per dimension.

    From the coarsest bit on, the corner in which the cell lies is turned into the frame
    of the part of the curve there; its place on the path gives the next digits.
    """
    n = len(coordinates)
    place, entry, turn = _gray_tables(n)
    zero = F.lit(0)
    start = F.struct(zero.alias("h"), zero.alias("e"), zero.alias("d"))

    def corner(level: Column) -> Column:
        bit = zero
        for i, c in enumerate(coordinates):
            one = F.pmod(F.floor(c / F.pow(F.lit(2.0), level)), F.lit(2)).cast("int")
            bit = bit + one * F.lit(1 << i)
        return bit

    def step(state: Column, level: Column) -> Column:
        e, d = state["e"], state["d"]
        direction = F.pmod(d + 1, F.lit(n))
        framed = _rotated(corner(level).bitwiseXOR(e), direction, n, left=False)
        # One value on: an array of one is how a lambda names an intermediate result.
        return F.transform(
            F.array(_pick(place, framed)),
            lambda w: F.struct(
                (state["h"] * (1 << n) + w).alias("h"),
                e.bitwiseXOR(_rotated(_pick(entry, w), direction, n, left=True)).alias("e"),
                F.pmod(d + _pick(turn, w) + 1, F.lit(n)).cast("int").alias("d"),
            ),
        )[0]

    levels = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))
    return F.aggregate(levels, start, step, lambda state: state["h"])


def value_steps(rows: DataFrame, column: str, total: int, bits: int) -> DataFrame:
    """``value`` and ``step`` of every value of ``column``: its step of ``2 ** bits`` follows from the
    rows with lesser values, of ``total`` in all.  NULL is the least.

    Rows of a value are counted before they move; values are put in order by range
    partitions and the sums of those before, so there may be any number of them.
    """
    values = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    parts = ranged(values, [F.col("value").asc_nulls_first()], f"{column}_values")
    earlier = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    # One offset per shuffle partition.
    before = F.col("_offset") + F.coalesce(F.sum("n").over(earlier), F.lit(0))
    placed = parts.join(F.broadcast(part_offsets(parts, F.sum("n"))), "_part").withColumn("before", before)
    step = F.expr(f"cast((before * {1 << bits}) div {total} AS int)").alias("step")
    return materialise(placed.select("value", step), f"{column}_steps")


def shard_documents(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``,
    ``curve`` of every row.

    Size is the UTF-8 bytes of the text plus 1; NULL has none, so 1.  The law is ``rows``:
    counts of shards differ by one at most.  Order is the Hilbert index, then the checksum
    and size of the text, so that equal texts of one cell stand together, then source,
    language and id.  NULLs come first.  Equal rows are told apart by nothing; they take
    neighbouring slots.

    Texts are read once; what is put in order are narrow rows, by range partitions and
    the sizes of those before, so no task sees more than its range.
    """
    text = F.col(text_col).cast("string")
    narrow = materialise(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("source"),
            F.col(lang_col).cast("string").alias("lang"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        ),
        "shard_rows",
    )
    total = max(narrow.count(), 1)
    dims = ["source", "lang", "size"]
    cells = narrow
    for dim in dims:
        steps = value_steps(narrow, dim, total, BITS).withColumnsRenamed({"value": "_value", "step": f"{dim}_at"})
        # A value may hold most rows; while the values are few every task has them.
        cells = checked_join(cells, steps, F.col(dim).eqNullSafe(F.col("_value")), "inner").drop("_value")
    at = [f"{dim}_at" for dim in dims]
    placed = materialise(cells.withColumn("curve", hilbert_index([F.col(a) for a in at]).cast("int")).drop(*at), "curve")
    order = ["curve", "crc", "size", "source", "lang", "id"]
    ranked = number_rows(placed, order, "number", start=-1, one_task_rows=0)
    # Shard s begins at row ceil(s * total / shards).
    cut = ranked.withColumn("shard", F.expr(f"cast((number * {shards}) div {total} as int)"))
    slot = F.expr(f"number - (shard * bigint({total}) + {shards - 1}) div {shards}")
    return cut.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        slot.alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
