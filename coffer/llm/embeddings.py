"""Near duplicates among embeddings.

Random hyperplanes give each vector one sign code per table.  Vectors that share a code in
some table are first compared by 128 more signs, which are all that is sent to each table;
only those that are near some other then meet it as whole vectors, and exact cosine in
double precision decides.  Linked vectors form components.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.llm.components import connected_components
from coffer.session import materialise

SEED = 4241

# Chance to miss a pair whose cosine is just the threshold; pairs above it are missed less.
MISS = 1e-3

# Members of a code that one task compares at once; a larger code is cut into blocks.
BLOCK = 2048

# Mean members per code; the number of bits follows the table by this.
MEAN_BUCKET = 256

# Signs by which members of a code are sorted out before their vectors are sent.  A pair at
# the threshold differs in more of them than allowed once in ten thousand.
SKETCH_BITS = 128
SKETCH_SPREAD = 3.72


def table_plan(rows: int, threshold: float) -> tuple[int, int]:
    """Bits per code and number of tables.

    Bits grow with the logarithm of the rows, so that codes keep the same mean size, and
    tables grow so that the chance to miss a pair at the threshold stays ``MISS``.
    """
    bits = max(4, math.ceil(math.log2(max(rows, 2) / MEAN_BUCKET)))
    agree = (1 - math.acos(min(max(threshold, -1.0), 1.0)) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISS) / math.log1p(-agree)))


def _planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, bits * tables))


def _codes(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    signs = vectors @ _planes(vectors.shape[1], bits, tables) > 0
    return signs.reshape(len(vectors), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def _sketches(vectors: np.ndarray) -> np.ndarray:
    """Two words of signs per vector."""
    planes = np.random.default_rng([SEED + 1, vectors.shape[1]]).standard_normal((vectors.shape[1], SKETCH_BITS))
    return np.packbits(vectors @ planes > 0, axis=1).view(np.uint64)


def sketch_limit(threshold: float) -> int:
    """Most signs in which a pair of the threshold's cosine may differ."""
    apart = math.acos(min(max(threshold, -1.0), 1.0)) / math.pi
    return math.ceil(SKETCH_BITS * apart + SKETCH_SPREAD * math.sqrt(SKETCH_BITS * apart * (1 - apart)))


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision.

    Scaled by the largest component first, so that no square overflows or vanishes.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    v = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _coded(vectors: DataFrame, bits: int, tables: int) -> DataFrame:
    """One row per vector and table: ``dim``, ``tab``, ``code``, ``rep`` and the sketch."""

    def rows(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = _unit(part.column("vec"), int(dim))
                codes, sketch = _codes(x, bits, tables), _sketches(x).view(np.int64)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("dim"),
                            pa.array(np.full(part.num_rows, t, dtype=np.int32)),
                            pa.array(codes[:, t]),
                            part.column("rep"),
                            pa.array(sketch[:, 0]),
                            pa.array(sketch[:, 1]),
                        ],
                        ["dim", "tab", "code", "rep", "s1", "s2"],
                    )

    return vectors.select("dim", "rep", "vec").mapInArrow(
        rows, "dim int, tab int, code bigint, rep bigint, s1 bigint, s2 bigint"
    )


_KEY = ["dim", "tab", "code"]


def _in_blocks(members: DataFrame) -> DataFrame:
    """Members of each code once for each pair of blocks they are in: ``low``, ``high``, ``block``.

    Codes within ``BLOCK`` members are one block.
    """
    large = members.groupBy(*_KEY).count().filter(F.col("count") > BLOCK)
    large = materialise(large.select(*_KEY, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "large_codes")
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    placed = members.join(large, _KEY, "left").withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(F.least("block", other).alias("low"), F.greatest("block", other).alias("high")),
    )
    return placed.select(*members.columns, "block", F.explode(pairs).alias("pair")).select(
        *members.columns, "block", F.col("pair.low").alias("low"), F.col("pair.high").alias("high")
    )


def _near_some(limit: int):
    """Members of a bucket whose sketch is near that of another."""

    def found(key, bucket):
        left, right = key[3].as_py(), key[4].as_py()
        block = bucket.column("block").to_numpy()
        s1, s2 = (bucket.column(c).to_numpy().view(np.uint64) for c in ("s1", "s2"))
        rows, cols = np.flatnonzero(block == left), np.flatnonzero(block == right)
        near = np.zeros(len(block), dtype=bool)
        for begin in range(0, len(rows), 512):
            own = rows[begin : begin + 512]
            apart = np.bitwise_count(s1[own, None] ^ s1[cols]).astype(np.int16)
            apart += np.bitwise_count(s2[own, None] ^ s2[cols])
            close = (apart <= limit) & (own[:, None] != cols)
            near[own] |= close.any(axis=1)
            near[cols] |= close.any(axis=0)
        return bucket.select([*_KEY, "rep"]).filter(pa.array(near))

    return found


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least position reachable from each of ``n`` positions by the given pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        now = root.copy()
        np.minimum.at(now, a, low)
        np.minimum.at(now, b, low)
        now = now[now]
        if (now == root).all():
            return root
        root = now


def _compared(threshold: float, bits: int, tables: int):
    """Links inside one bucket, or between two blocks of a large one.

    A pair counts in the first table in which its codes agree, so no link counts twice.
    """

    def links(key, bucket):
        dim, tab, left, right = key[0].as_py(), key[1].as_py(), key[3].as_py(), key[4].as_py()
        rep = bucket.column("rep").to_numpy()
        copies = bucket.column("copies").to_numpy()
        block = bucket.column("block").to_numpy()
        x = _unit(bucket.column("vec"), dim)
        codes = _codes(x, bits, tables)
        rows, cols = np.flatnonzero(block == left), np.flatnonzero(block == right)
        count = np.zeros(len(rep), dtype=np.int64)
        root = np.arange(len(rep))
        for begin in range(0, len(rows), 256):
            own = rows[begin : begin + 256]
            i, j = np.nonzero(x[own] @ x[cols].T >= threshold)
            i, j = own[i], cols[j]
            if left == right:
                once = i < j
                i, j = i[once], j[once]
            if tab and len(i):
                new = np.ones(len(i), dtype=bool)
                for t in range(tab):
                    new &= codes[i, t] != codes[j, t]
                i, j = i[new], j[new]
            np.add.at(count, i, copies[j])
            np.add.at(count, j, copies[i])
            if len(i):
                # Links found so far and these, as pairs of a position and its root.
                at = np.arange(len(rep))
                root = _local_roots(len(rep), np.concatenate([i, at]), np.concatenate([j, root]))
        hit = np.flatnonzero(count)
        # The root that has the least id, for edges that point to few ids.
        least = np.full(len(rep), np.iinfo(np.int64).max)
        np.minimum.at(least, root, rep)
        return pa.table({"rep": rep[hit], "n": count[hit], "near": least[root[hit]]})

    return links


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row.

    Equal vectors are one until the end, so copies cost one row each.  A vector that is
    NULL, empty, zero, or holds a NULL or non-finite component has no link; vectors of
    different lengths do not link.  A row with a NULL id links like any other when an
    equal vector has an id; else it has no component.  Rows that share an id and a vector
    are copies.  Each row in gives one row out.

    A bucket with more than 2,048 members is compared block by block, in as many groups
    as there are pairs of blocks, so no group holds more than two blocks.
    """
    v = F.col(vec_col)
    exists = F.exists(v, lambda c: c != 0)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = materialise(
        vectors.select(
            F.col(id_col).cast("bigint").alias("id"),
            v.alias("vec"),
            F.coalesce(v.isNotNull() & finite & exists, F.lit(False)).alias("valid"),
            F.xxhash64(v).alias("h1"),
            F.xxhash64(F.lit("second"), v).alias("h2"),
        ),
        "vectors",
    )
    groups = materialise(
        rows.filter("valid")
        .groupBy("h1", "h2")
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("vec").alias("vec"))
        .filter("rep IS NOT NULL")
        .withColumn("dim", F.size("vec")),
        "distinct_vectors",
    )
    bits, tables = table_plan(groups.count(), threshold)
    sketched = _in_blocks(materialise(_coded(groups, bits, tables), "codes"))
    near = sketched.groupBy(*_KEY, "low", "high").applyInArrow(
        _near_some(sketch_limit(threshold)), "dim int, tab int, code bigint, rep bigint"
    )
    near = materialise(near.distinct(), "near_codes")
    # A vector goes only to the tables in which it is near another.
    sent = near.join(groups.select("rep", "copies", "vec"), "rep").select(*_KEY, "rep", "copies", "vec")
    spread = _in_blocks(sent)
    found = materialise(
        spread.groupBy(*_KEY, "low", "high").applyInArrow(
            _compared(threshold, bits, tables), "rep bigint, n bigint, near bigint"
        ),
        "vector_links",
    )

    counts = found.groupBy("rep").agg(F.sum("n").alias("near_links"))
    parts = connected_components(found.select("rep", "near"), "rep", "near")
    by_group = (
        groups.select("h1", "h2", "rep", "copies")
        .join(counts, "rep", "left")
        .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "h1",
            "h2",
            F.lit(True).alias("valid"),
            (F.coalesce("near_links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    # Only groups with a link change anything, and a hot one is split as a join.
    linked = by_group.filter("links > 0")
    return (
        rows.drop("vec")
        .join(linked, ["h1", "h2", "valid"], "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
            F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(False)).alias("kept"),
        )
    )
