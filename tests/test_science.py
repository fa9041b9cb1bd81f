from __future__ import annotations

import dataclasses
import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from ledgers import ledger, tx
from pyspark.sql import functions as F

from coffer.plans import science


@pytest.fixture(scope="module")
def book(spark):
    """400 days of spend in two categories and none, with a few huge amounts."""
    rng = random.Random(11)
    events = []
    for i in range(1500):
        day = date(2023, 1, 1) + timedelta(days=rng.randrange(400))
        amount = rng.randrange(100, 200) if i % 97 else 5000
        category = rng.choice([1, 1, 1, 2, None])
        events.append(tx(i, day.isoformat(), amount, category=category, spending=rng.choice(["fixed", None])))
    return ledger(spark, events)


@pytest.fixture(scope="module")
def spend(book):
    df = book.transactions.select("transaction_id", "transaction_date", "category_id", "amount").toPandas()
    df["amount"] = df["amount"].astype(float)
    df["key"] = df["category_id"].fillna(-1)
    df["day"] = pd.to_datetime(df["transaction_date"])
    return df.set_index("transaction_id").sort_index()


def by_id(df):
    return df.toPandas().set_index("id").sort_index()


def test_zscore(book, spend):
    got = by_id(science.anomaly_zscore(book))
    want = (spend["amount"] - spend["amount"].mean()) / spend["amount"].std(ddof=0)
    assert np.allclose(got["z_score"], want, atol=1e-5)
    assert (got["is_anomaly"] == (want.abs() > 3)).all() and got["is_anomaly"].sum() == 16


def test_category_zscore(book, spend):
    got = by_id(science.anomaly_category_zscore(book))
    groups = spend.groupby("key")["amount"]
    want = (spend["amount"] - groups.transform("mean")) / groups.transform(lambda s: s.std(ddof=0))
    assert np.allclose(got["z_score"], want, atol=1e-5)


def test_rolling_zscore_against_brute_force(book, spend):
    got = by_id(science.anomaly_rolling_z(book))
    for i, row in spend.iterrows():
        near = spend[
            (spend["key"] == row["key"]) & (spend["day"] <= row["day"]) & (spend["day"] > row["day"] - pd.Timedelta(days=30))
        ]["amount"]
        assert got.loc[i, "window_count"] == len(near)
        assert got.loc[i, "day_of_week"] == row["day"].dayofweek
        deviation = near.std(ddof=0)
        if deviation > 0:
            assert abs(got.loc[i, "rolling_z"] - (row["amount"] - near.mean()) / deviation) < 1e-4
        else:
            assert pd.isna(got.loc[i, "rolling_z"])


def test_equal_amounts_have_no_score(spark):
    flat = ledger(spark, [tx(i, "2024-01-01", 5) for i in range(4)])
    got = science.anomaly_zscore(flat).select("z_score", "is_anomaly").distinct().collect()
    assert [tuple(r) for r in got] == [(None, False)]


def test_profile(book, spend):
    got = science.spend_profile(book).toPandas()
    assert len(got) == 3
    for _, row in got.iterrows():
        group = spend[spend["key"] == (-1 if pd.isna(row["category_id"]) else row["category_id"])]["amount"]
        assert row["tx_count"] == len(group)
        assert abs(row["mean_amount"] - group.mean()) < 1e-3
        assert abs(row["std_amount"] - group.std(ddof=0)) < 1e-3
        low, high = np.quantile(group, [0.25, 0.75])
        assert np.allclose((row["q1_amount"], row["q3_amount"]), (low, high))
        assert row["median_amount"] == group.median()
        fence = 1.5 * (high - low)
        assert row["outliers"] == ((group < low - fence) | (group > high + fence)).sum()


def test_forecast_follows_a_straight_line(spark):
    events = []
    for month in range(24):
        yr, mo = 2022 + month // 12, month % 12 + 1
        events.append(tx(month, f"{yr}-{mo:02d}-10", 1000 + 100 * month, category=1))
    book = ledger(spark, events)
    got = science.spend_forecast(book).filter("series = 'all'").orderBy("step").collect()
    assert [(r["yr"], r["mo"]) for r in got] == [(2024, 1), (2024, 2), (2024, 3)]
    for row, want in zip(got, (3400, 3500, 3600)):
        assert abs(row["forecast"] - want) <= 1 and row["lower"] <= row["forecast"] <= row["upper"]
    errors = science.forecast_backtest(book).filter("series = 'Food & Drinks'").first()
    assert errors["months"] == 3 and errors["rmse_model"] <= 1
    assert abs(errors["rmse_last"] - np.sqrt((100**2 + 200**2 + 300**2) / 3)) <= 1


def walk(nodes, point):
    """Depth of one point in one tree, a step at a time."""
    at = 0
    while nodes[at][0] >= 0:
        feature, cut, _ = nodes[at]
        at = 2 * at + (2 if point[feature] > cut else 1)
    return nodes[at][2]


def test_batch_scores_equal_a_walk_through_each_tree(spark, book):
    trees, sample, limit = 7, 32, 5
    features = science.anomaly_features(book)
    drawn = science._training_rows(features, trees, sample)
    nodes = drawn.groupBy("tree").applyInPandas(science._tree_grower(limit), science._NODES).toPandas()
    points = features.orderBy("id").toPandas()
    scored = pd.concat(science._scorer(nodes, trees, sample, limit)(iter([points[:700], points[700:]])))
    forest = [
        {n.node: (n.feature, n.cut, n.depth) for n in part.itertuples()} for _, part in nodes.groupby("tree")
    ]
    matrix = points[list(science.FEATURES)].to_numpy()
    want = [2 ** (-np.mean([walk(tree, p) for tree in forest]) / science._expected_depth(sample)) for p in matrix]
    assert np.allclose(scored["score"], want)


@pytest.mark.parametrize("rows", [40, 1000, 30_000, 60_000])
def test_trees_draw_by_one_rule_at_any_size(spark, rows):
    features = spark.range(rows).selectExpr("id", "cast(id AS double) AS amount")
    trees, sample = 12, 64
    drawn = science._training_rows(features, trees, sample).select("id", "tree").collect()
    share = min(science.DRAW_PRIME, -(-science.DRAW_PRIME * sample // rows))
    want = {(i, t) for i in range(rows) for t in range(trees) if science.draw(i, t) < share}
    assert {tuple(r) for r in drawn} == want and len(drawn) == len(want)
    expected = min(rows, sample)
    counts = [sum(t == tree for _, t in want) for tree in range(trees)]
    assert all(abs(n - expected) <= 5 * expected**0.5 for n in counts)
    if rows > 1000:  # trees draw apart from each other
        both = sum((i, 0) in want and (i, 1) in want for i in range(rows))
        assert both <= 4


@pytest.mark.parametrize("base", [10**9, 10**11])
def test_scores_of_amounts_far_from_zero(spark, base):
    """60 equal amounts but for small steps, one 40 higher: nothing cancels."""
    amounts = [base + i % 3 for i in range(60)] + [base + 40]
    book = ledger(spark, [tx(i, "2024-01-05", a, category=1) for i, a in enumerate(amounts)])
    values = np.array(amounts, dtype=float) - base
    want = (values - values.mean()) / values.std()
    for plan, column in (
        (science.anomaly_zscore, "z_score"),
        (science.anomaly_category_zscore, "z_score"),
        (science.anomaly_rolling_z, "rolling_z"),
    ):
        assert np.allclose(by_id(plan(book))[column], want, atol=1e-4), plan.__name__
    assert abs(science.spend_profile(book).first()["std_amount"] - values.std()) < 1e-3


def test_months_without_spend_count_and_a_category_may_be_called_all(spark):
    events = [tx(1, "2023-01-10", 100, category=1), tx(2, "2023-04-10", 300, category=2)]
    book = ledger(spark, events)
    names = book.categories.withColumn("category_name", F.when(F.col("category_id") == 1, "all").otherwise("b"))
    book = dataclasses.replace(book, categories=names)
    got = science.monthly_series(book).orderBy("kind", "series", "t").collect()
    assert [(r["kind"], r["series"], r["mo"], r["y"]) for r in got] == [
        ("category", "all", 1, 100.0), ("category", "all", 2, 0.0), ("category", "all", 3, 0.0),
        ("category", "all", 4, 0.0), ("category", "b", 4, 300.0), ("total", "all", 1, 100.0),
        ("total", "all", 2, 0.0), ("total", "all", 3, 0.0), ("total", "all", 4, 300.0),
    ]
    ahead = science.spend_forecast(book, 1).select("yr", "mo").distinct().collect()
    assert [tuple(r) for r in ahead] == [(2023, 5)]


def test_forest_flags_the_share_asked_for_and_finds_the_huge_amounts(book, spend):
    got = by_id(science.anomaly_iforest(book))
    flagged = got["anomaly_iforest"] == -1
    assert abs(flagged.mean() - 0.05) < 0.01
    huge = spend.index[spend["amount"] == 5000]
    assert flagged[huge].all()
    again = by_id(science.anomaly_iforest(book))
    assert (again["score"] == got["score"]).all()
