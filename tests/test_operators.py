from __future__ import annotations

import random

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from coffer.operators import dedupe, lookup, quantiles, ranking


def facts(spark, n=2000, seed=3):
    """A third of the rows share one key, and some keys are NULL or unknown."""
    rng = random.Random(seed)
    data = [(i, 1 if rng.random() < 0.35 else rng.choice([None, 2, 3, 4, 99])) for i in range(n)]
    return spark.createDataFrame(data, "id long, k int")


def test_lookup_join_gives_the_same_rows_beyond_the_broadcast_bound(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "k int, name string")
    for how in ("left", "inner"):
        small = lookup.lookup_join(facts(spark), dim, ["k"], how)
        large = lookup.lookup_join(facts(spark), dim, ["k"], how, max_rows=2)
        assert "Broadcast" in small._jdf.queryExecution().toString()
        assert rows(small.select("id", "k", "name")) == rows(large.select("id", "k", "name"))


def test_salted_join_spreads_a_hot_key(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    joined = lookup.lookup_join(facts(spark).filter("k = 1"), dim, ["k"], max_rows=0)
    largest = joined.groupBy(F.pmod(F.xxhash64("id", "k"), F.lit(lookup.SALTS))).count().agg(F.max("count")).first()[0]
    assert largest < joined.count() / lookup.SALTS * 3


def test_resolve_name_folds_text_and_takes_the_highest_id(spark):
    dim = spark.createDataFrame([(1, " Food "), (2, "food"), (3, "Rent"), (4, "  ")], "cid int, name string")
    sheet = spark.createDataFrame([(1, "FOOD"), (2, " rent"), (3, "none"), (4, ""), (5, None)], "i int, category string")
    got = lookup.resolve_name(sheet, "category", dim, "name", "cid")
    assert [r[1] for r in rows(got.select("i", "cid"), "i")] == [2, 3, None, None, None]
    assert rows(lookup.unresolved_names(got, "category", "cid")) == [("none", 1)]


def test_keep_last_and_first_follow_the_given_order(spark):
    data = [("a", 1, 1), ("a", 2, 5), ("a", 1, 9), (None, 1, 2), ("", 1, 3)]
    df = spark.createDataFrame(data, "k string, _batch_id int, _row_idx int")
    keys = dedupe.text_keys(df, ["k"])
    order = ["_batch_id", "_row_idx"]
    assert rows(dedupe.keep_last(df, keys, order)) == [("", 1, 3), ("a", 2, 5)]
    assert rows(dedupe.keep_first(df, keys, order)) == [("a", 1, 1), (None, 1, 2)]


def test_keep_last_drops_losers_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, o int")
    plan = dedupe.keep_last(df, [F.col("k")], ["o"])._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    below = physical[physical.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_number_rows_is_the_same_in_one_task_and_distributed(spark):
    df = facts(spark).withColumn("k", F.coalesce("k", F.lit(0)))
    near = ranking.number_rows(df, ["k", "id"], "no", start=10)
    far = ranking.number_rows(df, ["k", "id"], "no", start=10, one_task_rows=5)
    assert rows(near.select("id", "no")) == rows(far.select("id", "no"))
    assert [r[0] for r in rows(far.select("no"), "no")] == list(range(11, 2011))


def test_rank_desc_is_the_same_in_one_task_and_distributed(spark):
    df = facts(spark).withColumn("v", F.pmod(F.col("id") * 7919, F.lit(300)))
    near = ranking.rank_desc(df, "v", "place")
    far = ranking.rank_desc(df, "v", "place", one_task_rows=5)
    assert rows(near.select("id", "v", "place")) == rows(far.select("id", "v", "place"))


def test_quantiles_are_exact(spark):
    rng = random.Random(5)
    groups = {
        1: [rng.randrange(10**6) for _ in range(6000)],
        2: [rng.choice([1, 2, 2, 2, 9]) for _ in range(4000)],
        3: [4, 8],
        4: [7],
    }
    df = spark.createDataFrame([(k, float(v)) for k, values in groups.items() for v in values], "k int, v double")
    df = df.unionByName(spark.createDataFrame([(4, None)], "k int, v double"))
    shares = (0.01, 0.25, 0.5, 0.99)
    got = quantiles.exact_quantiles(df, "k", "v", shares, ("a", "b", "c", "d"))
    for k, *found in rows(got, "k"):
        assert np.allclose(found, np.quantile(groups[k], shares)), k


def test_quantile_values_spread_over_parts(spark, monkeypatch):
    """One group with distinct values: no part holds more than its share of them."""
    seen = {}
    whole = quantiles.ranged

    def watched(df, order, name):
        seen["parts"] = whole(df.repartition(4), order, name)
        return seen["parts"]

    monkeypatch.setattr(quantiles, "ranged", watched)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(40_000).selectExpr("0 AS k", "cast(id * 7919 % 40009 AS double) AS v")
        got = quantiles.exact_quantiles(df, "k", "v", [0.5], ["m"]).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in seen["parts"].groupBy("_part").count().collect()]
    assert len(sizes) >= 3 and max(sizes) < 2 * 40_000 / len(sizes)
    assert got["m"] == np.median([i * 7919 % 40009 for i in range(40_000)])


def test_lookup_is_measured_in_bytes(spark, monkeypatch):
    facts_ = spark.range(10).selectExpr("id AS k")
    names = spark.range(10).selectExpr("id AS k", "repeat('x', 1000) AS name")
    assert lookup.measured(names) == (10, 10 * 1000 + 10 * 2 * 16)
    assert "Broadcast" in lookup.lookup_join(facts_, names, ["k"])._jdf.queryExecution().toString()
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 5000)
    assert lookup.lookup_join(facts_, names, ["k"]).filter("name IS NOT NULL").count() == 10
    assert "_salt" in lookup.lookup_join(facts_, names, ["k"])._jdf.queryExecution().toString()
