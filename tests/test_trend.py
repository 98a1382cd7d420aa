"""The bending trend and Holt-Winters against plain versions and planted series."""

import datetime as dt
from itertools import product

import numpy as np
import pytest
from tidewell.config import ConfigManager
from tidewell.plans import smoothing, trend
from tidewell.plans.forecaster import TimeSeriesForecaster
from tidewell.plans.smoothing import BOUNDS, holt_winters, holt_winters_forecast, holt_winters_weights, search, smooth
from tidewell.plans.trend import prophet_forecast

MONTHS = [dt.date(2012 + i // 12, i % 12 + 1, 1) for i in range(240)]


def frame(spark, series, extra=()):
    rows = [(k, MONTHS[i], None if v is None else float(v), float(i % 5)) for k, y in series.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "g string, d date, y double, x double").repartition(3)


def by_group(df):
    out = {}
    for r in df.orderBy("d" if "d" in df.columns else "date").collect():
        out.setdefault(r.g, []).append(r)
    return out


def test_bends_minimise_the_penalised_square():
    r = np.random.default_rng(1)
    for _ in range(20):
        t = np.linspace(0, 1, 40)
        h = np.maximum(t[:, None] - np.linspace(0.1, 0.8, 6), 0)
        y = h @ (r.normal(size=6) * (r.random(6) < 0.4)) + r.normal(size=40) / 50
        gram, moment, penalty = (h.T @ h)[None], (h.T @ y)[None], np.array([0.01])
        d = trend.bends(gram, moment, penalty, np.zeros((1, 6)))[0]
        slope = h.T @ (h @ d - y)
        assert (np.abs(slope[d == 0]) <= 0.01 + 1e-6).all() and np.allclose(slope[d != 0], -0.01 * np.sign(d[d != 0]), atol=1e-6)


def test_changepoints_lie_in_the_first_part():
    assert trend.changepoints(100, 25, 0.8).tolist() == np.round(np.linspace(0, 79, 26)).astype(int)[1:].tolist()
    assert len(trend.changepoints(10, 25, 0.8)) == 7 and len(trend.changepoints(1, 25, 0.8)) == 0 and len(trend.changepoints(50, 0, 0.8)) == 0


def test_a_planted_bend_is_followed(spark):
    r = np.random.default_rng(2)
    t = np.arange(108)
    y = 100 + 2.0 * t - 3.0 * np.maximum(t - 48, 0) + 8 * np.sin(2 * np.pi * t / 12) + r.normal(size=108)
    found = by_group(prophet_forecast(frame(spark, {"a": y[:96]}), "d", "y", 12, "g"))["a"]
    straight = by_group(prophet_forecast(frame(spark, {"a": y[:96]}), "d", "y", 12, "g", n_changepoints=0))["a"]
    miss = lambda rows: float(np.abs(np.array([x.prediction for x in rows]) - y[96:]).mean())
    assert [x.date for x in found] == MONTHS[96:108] and miss(found) < 6 and miss(straight) > 20


@pytest.mark.parametrize("size", [0.0, 0.15, 0.4])
def test_bounds_cover_planted_series(spark, size):
    """Series that bend in the first four fifths of their history and as often after it: about 80 of 100 months lie within."""
    r, series, ahead = np.random.default_rng(3), {}, {}
    t = np.arange(108) / 95
    for k in range(60):
        where = np.concatenate([r.uniform(0, 0.8, 25), r.uniform(1, t[-1], r.poisson(25 * (t[-1] - 1)))])
        bends = np.maximum(t[:, None] - where, 0) @ r.laplace(0, max(size, 1e-12), len(where))
        y = 50 * (1 + 0.5 * t + bends + r.normal(size=108) * 0.05)
        series[f"s{k}"], ahead[f"s{k}"] = y[:96], y[96:]
    found = by_group(prophet_forecast(frame(spark, series), "d", "y", 12, "g", yearly_seasonality=False, changepoint_prior_scale=0.2))
    inside = [x.prediction_lower <= v <= x.prediction_upper for k, rows in found.items() for x, v in zip(rows, ahead[k], strict=True)]
    assert 0.7 <= np.mean(inside) <= 0.92, np.mean(inside)
    wide = np.array([[x.prediction_upper - x.prediction_lower for x in rows] for rows in found.values()]).mean(axis=0)
    assert not size or wide[-1] > 1.1 * wide[0]  # bounds open up where trends bend


def test_segments_are_independent(spark):
    r = np.random.default_rng(4)
    series = {k: 10 + r.random() * np.arange(n) + r.normal(size=n) for k, n in (("a", 60), ("b", 40), ("c", 3), ("d", 1))}
    whole = by_group(prophet_forecast(frame(spark, series), "d", "y", 6, "g"))
    for k, y in series.items():
        one = by_group(prophet_forecast(frame(spark, {k: y}), "d", "y", 6, "g"))[k]
        assert [x.date for x in one] == [x.date for x in whole[k]]
        assert np.allclose([x[2:] for x in map(tuple, one)], [x[2:] for x in map(tuple, whole[k])], rtol=1e-4, atol=1e-4)
        assert all(x.prediction_lower < x.prediction < x.prediction_upper for x in one)


def test_awkward_series_and_options(spark):
    gap = [5.0 if i % 7 else None for i in range(50)]
    found = by_group(prophet_forecast(frame(spark, {"gap": gap, "none": [None] * 5, "zero": [0.0] * 30}), "d", "y", 3, "g", uncertainty_samples=50))
    assert all(abs(x.prediction - 5) < 0.2 for x in found["gap"]) and all(abs(x.prediction) < 1e-6 for k in ("none", "zero") for x in found[k])
    assert prophet_forecast(frame(spark, {"a": [1.0]}).limit(0), "d", "y", 3, "g").count() == 0
    y = 20 + 3.0 * (np.arange(80) % 5)
    df = frame(spark, {"a": y})
    held = by_group(prophet_forecast(df, "d", "y", 2, "g", additional_regressors=["x", "absent"], yearly_seasonality=False))["a"]
    assert all(abs(x.prediction - (20 + 3.0 * (79 % 5))) < 0.5 for x in held)
    flat = by_group(prophet_forecast(frame(spark, {"a": np.arange(60.0)}), "d", "y", 2, "g", growth="flat", yearly_seasonality=False))["a"]
    assert all(abs(x.prediction - 29.5) < 1e-6 for x in flat)
    for wrong in ({"growth": "logistic"}, {"daily_seasonality": True}):
        with pytest.raises(ValueError):
            prophet_forecast(df, "d", "y", 2, "g", **wrong)
    with pytest.raises(TypeError):
        prophet_forecast(df, "d", "y", 2, "g", made_up=1)


@pytest.mark.parametrize("kind", ["prophet", "holt_winters"])
def test_forecaster_takes_the_usual_options(spark, kind):
    options = {"prophet": {"yearly_seasonality": True, "weekly_seasonality": False, "growth": "linear"}, "holt_winters": {"seasonal_periods": 12, "damped_trend": True, "trend": "add"}}[kind]
    y = 100 + np.arange(72) + 10 * np.sin(2 * np.pi * np.arange(72) / 12)
    config = ConfigManager(values={"forecasting": {"model_type": kind, "backtest_months": 12, kind: options}}, environment={})
    made = TimeSeriesForecaster(config).fit(frame(spark, {"a": y}).drop("g", "x"), "y", "d")
    assert made.evaluate().first().wape < 10


# Holt-Winters


def plain(y, w, trend_, seasonal, m=12):
    """One series, one step at a time: squared error."""
    a, b, g, phi = w
    n = m if seasonal else 1
    level, sse = float(np.mean(y[:n])), 0.0
    if trend_ == "add":
        slope = (np.mean(y[n : 2 * n]) - level) / n if len(y) >= 2 * n else (y[min(n, len(y) - 1)] - y[0]) / n
    else:
        slope = (np.mean(y[n : 2 * n]) / level) ** (1 / n) if trend_ else None
    s = [(v - level if seasonal == "add" else v / level) if seasonal else 0.0 for v in y[:n]]
    for t, v in enumerate(y):
        base = level if slope is None else level + phi * slope if trend_ == "add" else level * slope**phi
        own = s[t % n]
        sse += (v - (base + own if seasonal == "add" else base * own if seasonal else base)) ** 2
        new = a * (v - own if seasonal == "add" else v / own if seasonal else v) + (1 - a) * base
        if slope is not None:
            slope = b * (new - level) + (1 - b) * phi * slope if trend_ == "add" else b * new / level + (1 - b) * slope**phi
        level = new
        if seasonal:
            s[t % n] = g * (v - level if seasonal == "add" else v / level) + (1 - g) * own
    return sse


@pytest.mark.parametrize("how", list(product([None, "add", "mul"], [None, "add", "mul"], [False, True])))
def test_search_is_no_worse_than_a_fine_grid(how):
    trend_, seasonal, damped = how
    r = np.random.default_rng(5)
    t = np.arange(48)
    y = np.stack([100 + k * t + 8 * np.sin(2 * np.pi * t / 12) + r.normal(size=48).cumsum() for k in (0.1, 2, 5)])
    w, sse = search(y, trend_, seasonal, 12, damped)
    for i in range(3):
        assert sse[i] == pytest.approx(plain(y[i], w[i], trend_, seasonal))
    grid = [np.linspace(0.02, 0.98, 9), np.linspace(0.02, 0.98, 7) if trend_ else [0.0], np.linspace(0.02, 0.98, 7) if seasonal else [0.0], np.linspace(0.8, 0.99, 6) if damped and trend_ else [1.0]]
    best = smoothing._best(y, np.array(list(product(*grid))), trend_, seasonal, 12)[0].min(axis=1)
    assert (sse <= best * (1 + 1e-9)).all()
    free = [True, bool(trend_), bool(seasonal), damped and bool(trend_)]
    assert all((BOUNDS[j, 0] <= w[:, j]).all() and (w[:, j] <= BOUNDS[j, 1]).all() for j in range(4) if free[j])


def test_damping_is_found():
    t = np.arange(80)
    y = 50 + 30 * np.cumsum(0.9**t)
    w, sse = search(y[None], "add", None, 12, True)
    assert abs(w[0, 3] - 0.9) < 0.02 and sse[0] < search(y[None], "add", None, 12, False)[1][0]
    ahead = holt_winters(y, 40, seasonal=None, damped=True)
    assert ahead[-1] - ahead[-2] < 0.2 * (ahead[1] - ahead[0])


def test_values_that_cannot_be_smoothed():
    y = np.arange(48.0)
    for how in ({"trend": "mul"}, {"seasonal": "mul"}):
        with pytest.raises(ValueError, match="above 0"):
            holt_winters(y, 3, **how)
    with pytest.raises(ValueError, match="add"):
        holt_winters(y + 1, 3, trend="linear")
    assert np.isfinite(smooth(y[None] + 1, np.array([[0.5, 0.5, 0.5, 0.9]]), 3, "mul", "mul", 12)[1]).all()


def test_segments_of_several_lengths(spark):
    r = np.random.default_rng(6)
    series = {k: 50 + np.arange(n) + r.normal(size=n) for k, n in (("a", 60), ("b", 60), ("c", 30), ("d", 5))}
    df = frame(spark, series)
    found = by_group(holt_winters_forecast(df, "d", "y", 6, "g", damped_trend=True))
    for k, y in series.items():
        assert np.allclose([x.prediction for x in found[k]], holt_winters(y, 6, damped=True), rtol=1e-6) and found[k][0].date == MONTHS[len(y)]
    weights = {x.g: x for x in holt_winters_weights(df, "d", "y", "g").collect()}
    assert set(weights) == set(series) and weights["c"].sse == pytest.approx(search(series["c"][None])[1][0])
    assert holt_winters_forecast(df.limit(0), "d", "y", 6, "g").count() == 0
