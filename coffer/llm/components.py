"""Connected components of an edge table, as rounds of Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.session import materialise


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return row[0], row[1]


def _least(edges: DataFrame, near: str, far: str) -> DataFrame:
    """``far`` side of every edge with the least id that ``near`` sees, itself included."""
    least = edges.groupBy(near).agg(F.min(far).alias("m"))
    least = least.select(near, F.least(near, "m").alias("m"))
    return edges.join(least, near)


def connected_components(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``component`` (least id reachable) of every id named in ``pairs``.

    Alternates two steps until nothing changes: each node sends its larger neighbours to
    the least id around it, then its smaller ones.  The number of rounds grows with the
    logarithm of the longest chain.  A table is written per round in the shared folder;
    least ids are pre-aggregated, and a node with very many neighbours meets them in a
    join, which adaptive execution splits.  No row of the graph passes the driver.
    """
    edges = materialise(
        pairs.filter(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .distinct(),
        "edges",
    )
    mark = _signature(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _least(both, "u", "v")
            .filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # After the large step every edge points downwards: u is the larger end.
        seen = _least(large, "u", "v")
        small = (
            seen.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(seen.select("u", F.col("m").alias("v")))
            .filter(F.col("u") != F.col("v"))
            .distinct()
        )
        edges = materialise(small, "edges")
        now = _signature(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
