"""Spend profile, anomaly scores and forecast.

Statistics come from exact integer sums (count, sum, sum of squares) that Spark adds
up before any shuffle, and are then joined back to the rows that need them; no
window ever holds the transactions of one category.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coffer.operators.lookup import lookup_join
from coffer.operators.quantiles import exact_quantiles
from coffer.plans import marts
from coffer.schema import Ledger
from coffer.session import materialise

_NO_CATEGORY = -1

# What tells one series from another: a category may have any name.
_SERIES = ["kind", "series"]


def _moments(amount: str = "amount") -> list[Column]:
    """Count, sum, and the deviation by a method that does not cancel."""
    a = F.col(amount)
    return [
        F.count(a).alias("n"),
        F.sum(a).cast("decimal(38,0)").alias("s"),
        F.stddev_pop(a.cast("double")).alias("std"),
    ]


def _power_sums(amount: str = "amount") -> list[Column]:
    a = F.col(amount)
    return [
        F.count(a).alias("n"),
        F.sum(a).cast("decimal(38,0)").alias("s"),
        F.sum(a * a).cast("decimal(38,0)").alias("ss"),
    ]


def _mean() -> Column:
    return F.col("s").cast("double") / F.col("n")


def _deviation() -> Column:
    """Population standard deviation from exact count, sum and sum of squares.

    The subtraction happens on whole numbers, so nothing cancels.  Where these pass 38
    digits (a hundred million amounts of 1e11 each do not) it happens in double.
    """
    n = F.col("n").cast("decimal(20,0)")
    whole = F.try_subtract(F.try_multiply(n, F.col("ss")), F.try_multiply(F.col("s"), F.col("s")))
    exact = F.sqrt(whole.cast("double")) / F.col("n")
    rough = F.sqrt(F.greatest(F.col("ss").cast("double") / F.col("n") - _mean() * _mean(), F.lit(0.0)))
    return F.coalesce(exact, rough)


def _z(value: Column, mean: Column, deviation: Column) -> Column:
    """Standard score; NULL where the values do not vary."""
    return F.when(deviation > 0, F.round((value - mean) / deviation, 6))


def spend_profile(ledger: Ledger) -> DataFrame:
    """Distribution of spend per category: count, gaps, mean, spread, quartiles, outliers.

    Quartiles are exact and interpolated.  Outliers lie more than one and a half
    quartile ranges outside the quartiles.
    """
    key = F.coalesce("category_id", F.lit(_NO_CATEGORY)).alias("_key")
    facts = marts.spend_facts(ledger).select(
        key,
        "category_id",
        "spending_type",
        "payment_method",
        "description",
        "amount",
        F.col("amount").cast("double").alias("v"),
    )
    quartiles = exact_quantiles(
        facts, "_key", "v", (0.25, 0.5, 0.75), ("q1_amount", "median_amount", "q3_amount")
    )
    quartiles = materialise(
        quartiles.withColumn("fence", 1.5 * (F.col("q3_amount") - F.col("q1_amount"))), "spend_quartiles"
    )
    low, high = F.col("q1_amount") - F.col("fence"), F.col("q3_amount") + F.col("fence")
    stats = (
        lookup_join(facts, quartiles, ["_key"], how="inner")
        .groupBy("category_id", "q1_amount", "median_amount", "q3_amount")
        .agg(
            *_moments(),
            F.count_if(F.col("spending_type").isNull()).alias("missing_spending_type"),
            F.count_if(F.col("payment_method").isNull()).alias("missing_payment_method"),
            F.count_if(F.col("description").isNull()).alias("missing_description"),
            F.min("amount").alias("min_amount"),
            F.max("amount").alias("max_amount"),
            F.count_if((F.col("v") < low) | (F.col("v") > high)).alias("outliers"),
        )
    )
    names = ledger.categories.select("category_id", "category_name")
    return stats.join(names, "category_id", "left").select(
        "category_id",
        "category_name",
        F.col("n").alias("tx_count"),
        "missing_spending_type",
        "missing_payment_method",
        "missing_description",
        F.round(_mean(), 4).alias("mean_amount"),
        F.round("std", 4).alias("std_amount"),
        "min_amount",
        "q1_amount",
        "median_amount",
        "q3_amount",
        "max_amount",
        "outliers",
    )


def anomaly_zscore(ledger: Ledger, threshold: float = 3.0) -> DataFrame:
    """Standard score of each spend over all spend, flagged beyond ``threshold``."""
    facts = marts.spend_facts(ledger)
    moments = facts.agg(*_moments())
    stats = moments.select(F.struct(_mean().alias("mean"), "std").alias("stats"))
    scored = facts.withColumn("_stats", stats.scalar())
    z = _z(F.col("amount").cast("double"), F.col("_stats.mean"), F.col("_stats.std"))
    return scored.select(
        "id", "expense_date", "category_id", "amount", z.alias("z_score")
    ).withColumn("is_anomaly", F.coalesce(F.abs("z_score") > threshold, F.lit(False)))


def anomaly_category_zscore(ledger: Ledger, threshold: float = 3.0) -> DataFrame:
    """Standard score of each spend within its category (nameless spend is one group)."""
    key = F.coalesce("category_id", F.lit(_NO_CATEGORY))
    facts = marts.spend_facts(ledger).select("id", "expense_date", "category_id", "amount", key.alias("_key"))
    stats = facts.groupBy("_key").agg(*_moments()).select("_key", _mean().alias("_mean"), F.col("std").alias("_std"))
    scored = lookup_join(facts, materialise(stats, "category_stats"), ["_key"], salt_by=["id"])
    z = _z(F.col("amount").cast("double"), F.col("_mean"), F.col("_std"))
    return scored.select("id", "expense_date", "category_id", "amount", z.alias("z_score")).withColumn(
        "is_anomaly", F.coalesce(F.abs("z_score") > threshold, F.lit(False))
    )


def daily_window_stats(ledger: Ledger, days: int = 30) -> DataFrame:
    """Count, sum and sum of squares per category over the ``days`` days up to each spend day.

    Spend is summed per category and day before the window, so the window holds
    days, not transactions.
    """
    key = F.coalesce("category_id", F.lit(_NO_CATEGORY)).alias("_key")
    daily = marts.spend_facts(ledger).groupBy(key, "expense_date").agg(*_power_sums())
    trailing = (
        Window.partitionBy("_key")
        .orderBy(F.unix_date("expense_date"))
        .rangeBetween(-(days - 1), Window.currentRow)
    )
    return daily.select(
        "_key",
        "expense_date",
        F.sum("n").over(trailing).alias("n"),
        F.sum("s").over(trailing).cast("decimal(38,0)").alias("s"),
        F.sum("ss").over(trailing).cast("decimal(38,0)").alias("ss"),
    )


def anomaly_rolling_z(ledger: Ledger, days: int = 30, threshold: float = 3.0) -> DataFrame:
    """Standard score of each spend against its category's last ``days`` days, with weekday (Monday 0)."""
    key = F.coalesce("category_id", F.lit(_NO_CATEGORY)).alias("_key")
    facts = marts.spend_facts(ledger).select("id", "expense_date", "category_id", "amount", key)
    stats = daily_window_stats(ledger, days).select(
        "_key", "expense_date", F.col("n").alias("window_count"), _mean().alias("_mean"), _deviation().alias("_std")
    )
    stats = materialise(stats, "daily_stats")
    scored = lookup_join(facts, stats, ["_key", "expense_date"], how="inner", salt_by=["id"])
    z = _z(F.col("amount").cast("double"), F.col("_mean"), F.col("_std"))
    return scored.select(
        "id",
        "expense_date",
        "category_id",
        "amount",
        F.weekday("expense_date").alias("day_of_week"),
        "window_count",
        F.round("_mean", 4).alias("rolling_mean"),
        z.alias("rolling_z"),
    ).withColumn("is_anomaly", F.coalesce(F.abs("rolling_z") > threshold, F.lit(False)))


# ---------------------------------------------------------------------------
# Forecast
# ---------------------------------------------------------------------------


def monthly_series(ledger: Ledger) -> DataFrame:
    """Spend per month for each named category (kind ``category``) and in all (kind ``total``).

    The facts are read once, and the series is written: it has a row per month and
    category.  Months without spend count 0, from the first month of a series to the last
    month of the ledger.
    """
    by_key = marts.spend_facts(ledger).groupBy("yr", "mo", "category_id").agg(F.sum("amount").alias("spent"))
    by_key = materialise(by_key, "month_sums")
    names = ledger.categories.select("category_id", F.col("category_name").alias("series"))
    named = by_key.join(names, "category_id").select(F.lit("category").alias("kind"), "series", "yr", "mo", "spent")
    total = by_key.select(F.lit("total").alias("kind"), F.lit("all").alias("series"), "yr", "mo", "spent")
    spent = (
        named.unionByName(total)
        .groupBy(*_SERIES, (F.col("yr") * 12 + F.col("mo") - 1).alias("t"))
        .agg(F.sum("spent").cast("double").alias("y"))
    )
    end = by_key.agg(F.max(F.col("yr") * 12 + F.col("mo") - 1)).scalar()
    months = spent.groupBy(*_SERIES).agg(F.min("t").alias("first")).select(
        *_SERIES, F.explode(F.sequence("first", end)).alias("t")
    )
    full = months.join(spent, [*_SERIES, "t"], "left").select(
        *_SERIES,
        F.floor(F.col("t") / 12).cast("int").alias("yr"),
        (F.col("t") % 12 + 1).cast("int").alias("mo"),
        F.coalesce("y", F.lit(0.0)).alias("y"),
        "t",
    )
    return materialise(full, "monthly_series")


def _fit(series: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trend per series and effect per month of the year, by least squares then averages."""
    trend = series.groupBy(*_SERIES).agg(
        F.regr_slope("y", "t").alias("slope"), F.regr_intercept("y", "t").alias("intercept"), F.max("t").alias("last_t")
    )
    trended = series.join(trend, _SERIES).withColumn(
        "rest", F.col("y") - (F.col("intercept") + F.col("slope") * F.col("t"))
    )
    season = trended.groupBy(*_SERIES, "mo").agg(F.avg("rest").alias("effect"))
    spread = (
        trended.join(season, [*_SERIES, "mo"])
        .groupBy(*_SERIES)
        .agg(F.stddev_pop(F.col("rest") - F.col("effect")).alias("sigma"))
    )
    return trend.join(spread, _SERIES), season


def _predict(trend: DataFrame, season: DataFrame, months: int) -> DataFrame:
    ahead = trend.select("*", F.explode(F.sequence(F.lit(1), F.lit(months))).alias("step")).withColumn(
        "t", F.col("last_t") + F.col("step")
    )
    ahead = ahead.withColumns({"yr": F.floor(F.col("t") / 12).cast("int"), "mo": (F.col("t") % 12 + 1).cast("int")})
    effect = F.coalesce("effect", F.lit(0.0))
    return ahead.join(season, [*_SERIES, "mo"], "left").withColumn(
        "forecast", F.col("intercept") + F.col("slope") * F.col("t") + effect
    )


def spend_forecast(ledger: Ledger, months: int = 3) -> DataFrame:
    """Spend ``months`` months ahead per series in whole units, with a 95 percent band."""
    band = 1.96 * F.col("sigma")
    return _predict(*_fit(monthly_series(ledger)), months).select(
        *_SERIES,
        "yr",
        "mo",
        "step",
        F.round("forecast").cast("bigint").alias("forecast"),
        F.round(F.col("forecast") - band).cast("bigint").alias("lower"),
        F.round(F.col("forecast") + band).cast("bigint").alias("upper"),
    )


def forecast_backtest(ledger: Ledger, months: int = 3) -> DataFrame:
    """Error over the last ``months`` months, fitted on the earlier ones.

    ``rmse_model`` is the trend with month effects, ``rmse_last`` the last known month.
    """
    series = monthly_series(ledger)
    last = series.groupBy(*_SERIES).agg(F.max("t").alias("end_t"))
    split = series.join(last, _SERIES)
    train = split.filter(F.col("t") <= F.col("end_t") - months).drop("end_t")
    test = split.filter(F.col("t") > F.col("end_t") - months).select(*_SERIES, "t", "y")
    carried = train.groupBy(*_SERIES).agg(F.max_by("y", "t").alias("last_y"))
    trend, season = _fit(train)
    predicted = (
        test.withColumn("mo", (F.col("t") % 12 + 1).cast("int"))
        .join(trend, _SERIES)
        .join(season, [*_SERIES, "mo"], "left")
        .join(carried, _SERIES)
        .withColumn(
            "forecast", F.col("intercept") + F.col("slope") * F.col("t") + F.coalesce("effect", F.lit(0.0))
        )
    )
    squared = lambda c: F.pow(F.col("y") - F.col(c), F.lit(2.0))
    return predicted.groupBy(*_SERIES).agg(
        F.count(F.lit(1)).alias("months"),
        F.round(F.sqrt(F.avg(squared("forecast")))).cast("bigint").alias("rmse_model"),
        F.round(F.sqrt(F.avg(squared("last_y")))).cast("bigint").alias("rmse_last"),
    )


# ---------------------------------------------------------------------------
# Isolation forest
# ---------------------------------------------------------------------------

FEATURES = ("amount", "day_of_week", "category", "rolling_z")
_NODES = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("cut", T.DoubleType()),
        T.StructField("depth", T.DoubleType()),
    ]
)

# Draws are remainders modulo this prime, so that any engine with 64-bit integers makes the same.
DRAW_PRIME = (1 << 31) - 1


def draw_multipliers(tree: int) -> tuple[int, int]:
    """Factor and summand of a tree's draws."""
    return (48271 * (tree + 1) + 16807) % DRAW_PRIME, (69621 * (tree + 7)) % DRAW_PRIME


def draw(key: int, tree: int) -> int:
    """Number below the prime that key and tree decide: a line, a square and a factor."""
    factor, summand = draw_multipliers(tree)
    line = (key % DRAW_PRIME * factor + summand) % DRAW_PRIME
    return (line * line % DRAW_PRIME * 39373 + line) % DRAW_PRIME


def _expected_depth(n: int) -> float:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _grow(points: np.ndarray, tree: int, limit: int) -> list[tuple[int, int, float, float]]:
    """Nodes of one tree as (node, feature, cut, depth); children of ``i`` are ``2i + 1`` and ``2i + 2``.

    A node's draws choose the feature, among those that vary, and the cut between its ends.
    """
    nodes, open_nodes = [], [(0, 0, points)]
    while open_nodes:
        node, level, part = open_nodes.pop()
        spans = np.ptp(part, axis=0) if len(part) else np.zeros(0)
        choices = np.flatnonzero(spans > 0)
        if level >= limit or len(part) <= 1 or len(choices) == 0:
            nodes.append((node, -1, 0.0, level + _expected_depth(len(part))))
            continue
        feature = int(choices[draw(2 * node + 1, tree) % len(choices)])
        column = part[:, feature]
        low, high = float(column.min()), float(column.max())
        cut = low + (high - low) * (draw(2 * node + 2, tree) / DRAW_PRIME)
        nodes.append((node, feature, cut, 0.0))
        left = column <= cut
        open_nodes += [(2 * node + 1, level + 1, part[left]), (2 * node + 2, level + 1, part[~left])]
    return nodes


def _tree_grower(limit: int):
    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        points = rows[list(FEATURES)].to_numpy(float)
        found = pd.DataFrame(_grow(points, int(key[0]), limit), columns=["node", "feature", "cut", "depth"])
        found.insert(0, "tree", int(key[0]))
        return found

    return grow


def anomaly_features(ledger: Ledger) -> DataFrame:
    """Numeric features per spend: amount, weekday, category, rolling standard score."""
    scored = anomaly_rolling_z(ledger)
    return scored.select(
        "id",
        "expense_date",
        "category_id",
        F.col("amount").cast("double").alias("amount"),
        F.col("day_of_week").cast("double").alias("day_of_week"),
        F.coalesce("category_id", F.lit(_NO_CATEGORY)).cast("double").alias("category"),
        F.coalesce("rolling_z", F.lit(0.0)).alias("rolling_z"),
    )


def _training_rows(features: DataFrame, trees: int, sample: int) -> DataFrame:
    """About ``sample`` rows for each tree, by one rule at any size of the table.

    A row is in a tree when the draw of its id and that tree is below the tree's share.  A
    table with fewer rows than ``sample`` is in every tree.  Each row unfolds only the
    trees it is in, which are ``trees * sample`` rows in all, about.
    """
    total = max(features.count(), 1)
    share = min(DRAW_PRIME, -(-DRAW_PRIME * sample // total))
    prime = F.lit(DRAW_PRIME).cast("bigint")
    key = F.pmod(F.col("id"), prime)
    lines = F.array(
        *[F.pmod(key * F.lit(a).cast("bigint") + F.lit(b).cast("bigint"), prime) for a, b in map(draw_multipliers, range(trees))]
    )
    drawn = F.transform(lines, lambda x: F.pmod(F.pmod(x * x, prime) * 39373 + x, prime))
    chosen = F.transform(drawn, lambda d, tree: F.when(d < share, tree))
    return features.withColumn("tree", F.explode(F.filter(chosen, lambda tree: tree.isNotNull())))


def _scorer(nodes: pd.DataFrame, trees: int, sample: int, limit: int):
    """Function that adds the anomaly score to batches of feature rows."""
    size = (1 << (limit + 1)) - 1
    feature = np.full((trees, size), -1, dtype=np.int32)
    cut = np.zeros((trees, size))
    depth = np.zeros((trees, size))
    at = (nodes["tree"].to_numpy(), nodes["node"].to_numpy())
    feature[at], cut[at], depth[at] = nodes["feature"], nodes["cut"], nodes["depth"]
    scale = max(_expected_depth(sample), 1.0)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch[list(FEATURES)].to_numpy(float)
            rows = np.arange(len(points))
            total = np.zeros(len(points))
            for tree in range(trees):
                node = np.zeros(len(points), dtype=np.int64)
                for _ in range(limit):
                    split = feature[tree, node]
                    right = points[rows, np.maximum(split, 0)] > cut[tree, node]
                    node = np.where(split >= 0, 2 * node + 1 + right, node)
                total += depth[tree, node]
            yield batch[["id", "expense_date", "category_id", "amount"]].assign(
                score=np.power(2.0, -total / trees / scale)
            )

    return score


def anomaly_iforest(
    ledger: Ledger, contamination: float = 0.05, trees: int = 100, sample: int = 256
) -> DataFrame:
    """Isolation-forest score per spend; the top ``contamination`` share is flagged.

    Trees grow in parallel from about ``sample`` rows each; their depth, and with it the
    number of nodes of all trees, is fixed by the parameters, so they travel with the scoring tasks.  Rows are scored in Arrow batches where they
    are.  Features and scores are each written once, as several steps read them.
    """
    limit = int(np.ceil(np.log2(max(sample, 2))))
    features = materialise(anomaly_features(ledger), "forest_features")
    grown = _training_rows(features, trees, sample).groupBy("tree").applyInPandas(_tree_grower(limit), _NODES)
    nodes = grown.toPandas()
    schema = "id long, expense_date date, category_id int, amount double, score double"
    scored = features.mapInPandas(_scorer(nodes, trees, sample, limit), schema)
    scored = materialise(scored.withColumn("score", F.round("score", 9)), "forest_scores")
    everything = scored.select(F.lit(0).alias("_all"), "score")
    cutoff = exact_quantiles(everything, "_all", "score", [1.0 - contamination], ["cutoff"]).select("cutoff").scalar()
    return scored.select(
        "id",
        "expense_date",
        "category_id",
        F.col("amount").cast("bigint").alias("amount"),
        "score",
        F.when(F.col("score") > cutoff, -1).otherwise(1).alias("anomaly_iforest"),
    )
