"""Seasonal and autoregressive forecasts against least squares by numpy."""

from __future__ import annotations

import numpy as np
import pytest
from ledgers import ledger, tx
from pyspark.sql import functions as F

from coffer.plans import forecasting


def book(spark, values, category=1, first=2015):
    """One purchase a month of category 1."""
    days = [f"{first + i // 12}-{i % 12 + 1:02}-10" for i in range(len(values))]
    return ledger(spark, [tx(i, day, int(v), category=category, sub=None) for i, (day, v) in enumerate(zip(days, values), 1)])


def by_numpy(x, y):
    return np.linalg.solve(x.T @ x + forecasting.RIDGE * np.eye(x.shape[1]), x.T @ y)


def terms(t, first, end, changes, harmonics):
    points = [first + (end - first) * j / 4 for j in (1, 2, 3)]
    row = [1.0, (t - first) / 12, *[max(t - p, 0) / 12 * (changes > 0) for p in points]]
    for k in (1, 2):
        row += [f(2 * np.pi * k * t / 12) * (harmonics >= k) for f in (np.sin, np.cos)]
    return row


def test_least_squares_by_group(spark):
    rng = np.random.default_rng(1)
    rows = [(g, rng.normal(size=3).tolist(), float(rng.normal())) for g in "ab" for _ in range(20)]
    frame = spark.createDataFrame(rows, "g string, x array<double>, y double")
    for r in forecasting.least_squares(frame, ["g"], 3).collect():
        x, y = (np.array(v) for v in zip(*[(x, y) for g, x, y in rows if g == r["g"]]))
        assert r["n"] == 20 and np.allclose(r["coef"], by_numpy(x, y))
    assert forecasting.least_squares(frame.limit(0), ["g"], 3).count() == 0


def test_seasons_and_changes_are_found(spark):
    t = np.arange(12 * 2015, 12 * 2015 + 72)
    wave = 4000 + 1500 * np.sin(2 * np.pi * t / 12) + 700 * np.cos(4 * np.pi * t / 12)
    bent = 2000 + 40 * np.maximum(np.arange(72) - 35, 0)
    for values, what, needed in ((wave, "harmonics", 2), (bent, "changes", 3)):
        values = np.round(values)
        got = forecasting.seasonal_forecast(book(spark, values)).filter("kind = 'total'").orderBy("step").collect()
        assert got[0][what] == needed
        least = got[0]["changes"], got[0]["harmonics"]
        first, last, scale = t[0], t[-1], values.max()
        x = np.array([terms(u, first, last, *least) for u in t])
        coef = by_numpy(x, values / scale)
        want = [round(float(np.dot(terms(last + s, first, last, *least), coef) * scale)) for s in (1, 2, 3)]
        assert [r["forecast"] for r in got] == pytest.approx(want, abs=1)
        assert [(r["yr"], r["mo"]) for r in got] == [(2021, 1), (2021, 2), (2021, 3)]
    errors = forecasting.seasonal_backtest(book(spark, np.round(wave))).filter("kind = 'total' AND changes = 0").collect()
    rmse = {(r["harmonics"], r["step"]): r["rmse"] for r in errors}
    assert max(rmse[2, s] for s in (1, 2, 3)) < 0.2 * min(rmse[1, s] for s in (1, 2, 3))
    assert all(r["origins"] == 4 for r in errors)


def test_short_series(spark):
    short = book(spark, [100, 300, 200])
    assert forecasting.seasonal_backtest(short).count() == 0
    plain = forecasting.seasonal_forecast(short).filter("kind = 'total'").collect()
    assert len(plain) == 3 and {(r["changes"], r["harmonics"]) for r in plain} == {(0, 1)}
    assert forecasting.arma_forecast(short).count() == 0
    assert forecasting.arma_backtest(short).count() == 0
    assert forecasting.seasonal_forecast(ledger(spark)).count() == 0


def test_autoregression_finds_its_orders(spark):
    rng = np.random.default_rng(3)
    values = {}
    for name, ar, ma in (("one", (0.8, 0.0), 0.0), ("two", (0.4, 0.45), 0.0), ("mixed", (0.5, 0.0), 0.8)):
        y, e = [0.0, 0.0], [0.0, 0.0]
        for shock in rng.normal(size=600):
            y.append(ar[0] * y[-1] + ar[1] * y[-2] + shock + ma * e[-1])
            e.append(shock)
        values[name] = np.round(10_000 + 300 * np.array(y[2:]))
    orders = {}
    for name, v in values.items():
        got = forecasting.arma_forecast(book(spark, v, first=1900)).filter("kind = 'total'").orderBy("step").collect()
        orders[name] = got[0]["ar"], got[0]["ma"]
        assert [r["step"] for r in got] == [1, 2, 3]
        # Forecasts go back to the mean.
        assert abs(got[2]["forecast"] - 10_000) <= abs(v[-1] - 10_000) + 400
    assert orders["one"] == (1, 0) and orders["two"] == (2, 0) and orders["mixed"][1] == 1


def test_autoregression_by_numpy(spark):
    rng = np.random.default_rng(5)
    v = np.round(5000 + np.cumsum(rng.normal(size=60) * 100))
    got = forecasting.arma_backtest(book(spark, v)).filter("kind = 'total'").first()
    y = v[:-3] / v.max()
    lag = lambda a, k, start: np.array([a[i - k] for i in range(start, len(a))])
    long = np.column_stack([np.ones(len(y) - 3), *[lag(y, k, 3) for k in (1, 2, 3)]])
    e = np.concatenate([np.zeros(3), y[3:] - long @ by_numpy(long, y[3:])])
    best = None
    for p in (1, 2):
        for q in (0, 1):
            x = np.column_stack([np.ones(len(y) - 4), lag(y, 1, 4), lag(y, 2, 4) * (p > 1), lag(e, 1, 4) * (q > 0)])
            coef = by_numpy(x, y[4:])
            rest = np.mean((y[4:] - x @ coef) ** 2)
            best = min(best or (np.inf,), (len(x) * np.log(rest) + (1 + p + q) * np.log(len(x)), p, q, coef), key=lambda b: b[0])
    _, p, q, c = best
    y1, y2, e1, ahead = y[-1], y[-2], e[-1], []
    for _ in range(3):
        ahead.append(c[0] + c[1] * y1 + c[2] * y2 + c[3] * e1)
        y1, y2, e1 = ahead[-1], y1, 0.0
    rmse = np.sqrt(np.mean((np.array(ahead) * v.max() - v[-3:]) ** 2))
    assert (got["ar"], got["ma"], got["months"]) == (p, q, 3) and got["rmse_arma"] == pytest.approx(rmse, abs=1)


def test_all_series_are_forecast(spark):
    events = [tx(i, f"20{10 + i // 24}-{i // 2 % 12 + 1:02}-0{i % 2 + 1}", 100 + i * 7 % 90, category=1 + i % 2, sub=None) for i in range(240)]
    both = ledger(spark, events)
    assert forecasting.arma_forecast(both).select("kind", "series").distinct().count() == 3
    steps = forecasting.seasonal_forecast(both, months=5).groupBy("kind", "series").agg(F.count(F.lit(1)).alias("n"))
    assert {r["n"] for r in steps.collect()} == {5}
