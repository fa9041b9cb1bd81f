"""Forecasts of monthly spend by seasonal and by autoregressive models.

Both are least squares over a few terms per month.  The products of terms are summed in Spark
for all series, models and origins at once; what is solved per series is a system of a few
equations.  ``science.spend_forecast`` is the plain trend with month effects.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.plans.science import monthly_series
from coffer.schema import Ledger
from coffer.session import materialise

SERIES = ["kind", "series"]

# Added to the squares of every term, which keeps a system solvable whatever the series.
RIDGE = 1e-3

# Candidate models: change points of the trend, and harmonics of the year.
CHANGES, HARMONICS = (0, 3), (1, 2)

# Rolling origins of back-tests, this many months apart, with so many months ahead each.
ORIGINS, AHEAD = 4, 3

# Months that a series needs before an origin.
LEAST_MONTHS = 24

# Orders tried by the autoregressive model; residuals come from this many lags.
AR_ORDERS, MA_ORDERS, LONG_ORDER = (1, 2), (0, 1), 3


def least_squares(rows: DataFrame, group: list[str], terms: int, x: str = "x", y: str = "y") -> DataFrame:
    """``coef`` of the array ``x`` of ``terms`` numbers for ``y``, and the rows ``n``, per group."""
    pairs = [(i, j) for i in range(terms) for j in range(i, terms)]
    term = lambda i: F.col(x)[i]
    sums = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(term(i) * term(j)) for i, j in pairs]).alias("_xx"),
        F.array(*[F.sum(term(i) * F.col(y)) for i in range(terms)]).alias("_xy"),
    )

    @F.pandas_udf("array<double>")
    def solved(xx: pd.Series, xy: pd.Series) -> pd.Series:
        at = np.array(pairs)
        gram = np.zeros((len(xx), terms, terms))
        gram[:, at[:, 0], at[:, 1]] = np.stack(xx.to_list()) if len(xx) else 0.0
        gram[:, at[:, 1], at[:, 0]] = gram[:, at[:, 0], at[:, 1]]
        gram += RIDGE * np.eye(terms)
        right = np.stack(xy.to_list())[..., None] if len(xy) else np.zeros((0, terms, 1))
        return pd.Series(list(np.linalg.solve(gram, right)[..., 0]))

    return sums.select(*group, "n", solved("_xx", "_xy").alias("coef"))


def _value(x: str = "x", coef: str = "coef") -> Column:
    return F.aggregate(F.zip_with(x, coef, lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v)


def _scaled(series: DataFrame) -> DataFrame:
    """Series in parts of their largest month, with their first and last month."""
    ends = series.groupBy(*SERIES).agg(
        F.min("t").alias("first"), F.max("t").alias("last"), F.greatest(F.max("y"), F.lit(1.0)).alias("scale")
    )
    return series.select(*SERIES, "t", "y").join(ends, SERIES).withColumn("y", F.col("y") / F.col("scale"))


# ---------------------------------------------------------------------------
# Trend with change points and harmonics of the year
# ---------------------------------------------------------------------------

_TERMS = 2 + max(CHANGES) + 2 * max(HARMONICS)


def seasonal_terms(t: Column, first: Column, end: Column, changes: Column, harmonics: Column) -> Column:
    """Level, slope in years, slopes from change points on, and waves; 0 for those a model lacks.

    Change points part the months from ``first`` to ``end`` evenly.
    """
    years = lambda since: (t - since) / F.lit(12.0)
    points = [first + (end - first) * F.lit(j / (max(CHANGES) + 1)) for j in range(1, max(CHANGES) + 1)]
    bends = [F.when(changes > 0, F.greatest(years(p), F.lit(0.0))).otherwise(0.0) for p in points]
    waves = []
    for k in range(1, max(HARMONICS) + 1):
        # Of whole months, so that every year has the same waves.
        angle = F.pmod(t * k, F.lit(12)) * F.lit(np.pi / 6)
        waves += [F.when(harmonics >= k, wave(angle)).otherwise(0.0) for wave in (F.sin, F.cos)]
    return F.array(F.lit(1.0), years(first), *bends, *waves)


def _with_models(rows: DataFrame) -> DataFrame:
    models = F.array(*[F.struct(F.lit(c).alias("changes"), F.lit(h).alias("harmonics")) for c in CHANGES for h in HARMONICS])
    return rows.withColumn("_m", F.explode(models)).select("*", "_m.*").drop("_m")


def _with_origins(rows: DataFrame) -> DataFrame:
    """Every row under each origin: the last month that a fit may know."""
    back = F.explode(F.array(*[F.lit(AHEAD * k) for k in range(1, ORIGINS + 1)]))
    return rows.withColumn("_back", back).withColumn("origin", F.col("last") - F.col("_back")).drop("_back")


def _terms_column(end: str) -> Column:
    return seasonal_terms(F.col("t"), F.col("first"), F.col(end), F.col("changes"), F.col("harmonics"))


def _back_tested(series: DataFrame) -> DataFrame:
    """Squared error, in parts of the scale, of every model, origin and month ahead."""
    tried = _with_models(_with_origins(_scaled(series))).withColumn("x", _terms_column("origin"))
    tried = tried.filter(F.col("origin") - F.col("first") + 1 >= LEAST_MONTHS)
    model = [*SERIES, "changes", "harmonics", "origin"]
    fitted = least_squares(tried.filter("t <= origin"), model, _TERMS)
    ahead = tried.filter((F.col("t") > F.col("origin")) & (F.col("t") <= F.col("origin") + AHEAD))
    off = F.col("y") - _value()
    return ahead.join(fitted, model).select(
        *model, "scale", (F.col("t") - F.col("origin")).cast("int").alias("step"), (off * off).alias("squared")
    )


def seasonal_backtest(ledger: Ledger) -> DataFrame:
    """Error of every model by months ahead, over the origins that the series is long enough for."""
    return (
        _back_tested(monthly_series(ledger))
        .groupBy(*SERIES, "changes", "harmonics", "step")
        .agg(F.count(F.lit(1)).alias("origins"), F.round(F.sqrt(F.avg("squared")) * F.max("scale")).cast("bigint").alias("rmse"))
    )


def seasonal_forecast(ledger: Ledger, months: int = AHEAD) -> DataFrame:
    """Spend ``months`` months ahead by the model of least error in back-tests, per series.

    Of models with equal errors, and for series too short to test, the one with fewer
    change points and harmonics.
    """
    series = monthly_series(ledger)
    error = _back_tested(series).groupBy(*SERIES, "changes", "harmonics").agg(F.avg("squared").alias("error"))
    chosen = error.groupBy(*SERIES).agg(F.min(F.struct(F.round("error", 12).alias("error"), "changes", "harmonics")).alias("m"))
    chosen = materialise(chosen.select(*SERIES, "m.changes", "m.harmonics"), "chosen")
    plainest = {"changes": min(CHANGES), "harmonics": min(HARMONICS)}
    rows = _scaled(series).join(chosen, SERIES, "left").fillna(plainest).withColumn("x", _terms_column("last"))
    fitted = least_squares(rows, SERIES, _TERMS)
    ends = rows.select(*SERIES, "first", "last", "scale", "changes", "harmonics").distinct()
    ahead = ends.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(months)))).withColumn(
        "t", F.col("last") + F.col("step")
    )
    return (
        ahead.withColumn("x", _terms_column("last"))
        .join(fitted, SERIES)
        .select(
            *SERIES,
            F.floor(F.col("t") / 12).cast("int").alias("yr"),
            (F.col("t") % 12 + 1).cast("int").alias("mo"),
            "step",
            "changes",
            "harmonics",
            F.round(_value() * F.col("scale")).cast("bigint").alias("forecast"),
        )
    )


# ---------------------------------------------------------------------------
# Autoregression with moving averages
# ---------------------------------------------------------------------------


def _lagged(rows: DataFrame, value: str, lags: int, out: str) -> DataFrame:
    """Earlier values by month as the array ``out``; months that lack one are left out."""
    told = rows.select(*SERIES, F.col("t").alias("_at"), F.col(value).alias("_v"), F.explode(F.sequence(F.lit(1), F.lit(lags))).alias("_lag"))
    earlier = told.groupBy(*SERIES, (F.col("_at") + F.col("_lag")).alias("t")).agg(F.sort_array(F.collect_list(F.struct(-F.col("_at"), "_v"))).alias("_l"))
    full = earlier.filter(F.size("_l") == lags).select(*SERIES, "t", F.col("_l._v").alias(out))
    return rows.join(full, [*SERIES, "t"])


def _orders(rows: DataFrame) -> DataFrame:
    """Every row under each pair of orders, with 0 for terms that the orders lack."""
    kinds = F.array(*[F.struct(F.lit(p).alias("ar"), F.lit(q).alias("ma")) for p in AR_ORDERS for q in MA_ORDERS])
    tried = rows.withColumn("_o", F.explode(kinds)).select("*", "_o.*").drop("_o")
    terms = [F.when(F.col("ar") >= i, F.col("ys")[i - 1]).otherwise(0.0) for i in range(1, max(AR_ORDERS) + 1)]
    terms += [F.when(F.col("ma") >= i, F.col("es")[i - 1]).otherwise(0.0) for i in range(1, max(MA_ORDERS) + 1)]
    return tried.withColumn("x", F.array(F.lit(1.0), *terms))


def _arma(series: DataFrame) -> DataFrame:
    """Per series the orders, the coefficients, and the last values and residuals, latest first.

    Residuals of a longer autoregression stand for the shocks, whose lags are further terms.
    Of the orders tried the one with the least information criterion (Schwarz) is taken, the
    lower of equals; all are fitted to the same months.
    """
    lagged = _lagged(series, "y", LONG_ORDER, "ys")
    long = lagged.withColumn("x", F.concat(F.array(F.lit(1.0)), "ys"))
    shocks = long.join(least_squares(long, SERIES, 1 + LONG_ORDER), SERIES)
    shocks = materialise(shocks.select(*SERIES, "t", "y", "ys", (F.col("y") - _value()).alias("e")), "shocks")
    tried = _orders(_lagged(shocks, "e", max(MA_ORDERS), "es"))
    model = [*SERIES, "ar", "ma"]
    fitted = least_squares(tried, model, 1 + max(AR_ORDERS) + max(MA_ORDERS))
    left = F.col("y") - _value()
    spread = tried.join(fitted, model).groupBy(*model).agg(F.avg(left * left).alias("left"), F.first("coef").alias("coef"), F.max("n").alias("n"))
    criterion = F.col("n") * F.log(F.greatest("left", F.lit(1e-12))) + (1 + F.col("ar") + F.col("ma")) * F.log("n")
    best = spread.groupBy(*SERIES).agg(F.min(F.struct(F.round(criterion, 6).alias("c"), "ar", "ma", "coef")).alias("m"))
    last = shocks.groupBy(*SERIES).agg(
        F.max_by(F.struct("y", "ys", "e", "t"), "t").alias("last"),
    )
    now = F.struct(F.col("last.y").alias("y1"), F.col("last.ys")[0].alias("y2"), F.col("last.e").alias("e1"))
    return best.join(last, SERIES).select(*SERIES, "m.ar", "m.ma", "m.coef", now.alias("now"), F.col("last.t").alias("end"))


def _steps_ahead(months: int) -> Column:
    """Values ahead, one after the other; shocks to come count 0."""

    def step(state: Column, _: Column) -> Column:
        c = lambda i: F.col("coef")[i]
        ahead = c(0) + c(1) * state["y1"] + c(2) * state["y2"] + c(3) * state["e1"]
        return F.struct(
            ahead.alias("y1"), state["y1"].alias("y2"), F.lit(0.0).alias("e1"), F.concat(state["out"], F.array(ahead)).alias("out")
        )

    start = F.struct(F.col("now.y1").alias("y1"), F.col("now.y2").alias("y2"), F.col("now.e1").alias("e1"), F.array().cast("array<double>").alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(months)), start, step, lambda s: s["out"])


def arma_backtest(ledger: Ledger, months: int = AHEAD) -> DataFrame:
    """Error over the last ``months`` months of the model fitted to the earlier ones, with its orders.

    Beside ``science.forecast_backtest``, which has the plain models over the same months.
    """
    series = _scaled(monthly_series(ledger))
    train = series.filter(F.col("t") <= F.col("last") - months)
    test = series.filter(F.col("t") > F.col("last") - months)
    found = _arma(train.select(*SERIES, "t", "y")).withColumn("ahead", _steps_ahead(months))
    off = F.col("y") - F.element_at("ahead", (F.col("t") - F.col("end")).cast("int"))
    return (
        test.join(found, SERIES)
        .groupBy(*SERIES, "ar", "ma")
        .agg(F.count(F.lit(1)).alias("months"), F.round(F.sqrt(F.avg(off * off)) * F.max("scale")).cast("bigint").alias("rmse_arma"))
    )


def arma_forecast(ledger: Ledger, months: int = AHEAD) -> DataFrame:
    """Spend ``months`` months ahead per series by the autoregressive model."""
    series = _scaled(monthly_series(ledger))
    found = _arma(series.select(*SERIES, "t", "y")).withColumn("ahead", _steps_ahead(months))
    scales = series.select(*SERIES, "scale").distinct()
    steps = found.join(scales, SERIES).select(*SERIES, "ar", "ma", "end", "scale", F.posexplode("ahead").alias("at", "value"))
    t = F.col("end") + F.col("at") + 1
    return steps.select(
        *SERIES,
        F.floor(t / 12).cast("int").alias("yr"),
        (t % 12 + 1).cast("int").alias("mo"),
        (F.col("at") + 1).alias("step"),
        "ar",
        "ma",
        F.round(F.col("value") * F.col("scale")).cast("bigint").alias("forecast"),
    )
