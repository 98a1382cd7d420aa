"""Boosted trees against plain ones grown row by row, over small tables and over tables that lie in partitions."""

import math

import numpy as np
import pytest
from tidewell.config import ConfigManager
from tidewell.plans import boosting
from tidewell.plans.boosting import CatBoost, LightGBM, XGBoost, target_statistics
from tidewell.plans.forecaster import TimeSeriesForecaster
from tidewell.plans.models import load_model, make_model, save_model

NAMES = ["a", "b", "c"]


def frame(spark, x, y, parts=3):
    rows = [(*(None if math.isnan(v) else float(v) for v in r), float(t)) for r, t in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(parts)


def data(seed, n=300):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.normal(size=n).round(1), r.integers(0, 6, n), r.random(n).round(2)])
    y = np.sin(3 * x[:, 0]) + (x[:, 1] > 2) * x[:, 2] + r.normal(size=n) / 10
    x[r.random((n, 3)) < 0.1] = np.nan
    return x, y


def plain(x, y, growth, rounds, rate, leaves=1 << 30, depth=1 << 30, alpha=0.0, lam=0.0, gamma=0.0, weight=0.0, least=1):
    """Predictions of the rows, by trying every split of every leaf on the rows themselves."""
    worth = lambda g, h: max(abs(g) - alpha, 0) ** 2 / (h + lam) if h + lam > 0 else 0.0
    p = np.full(len(y), y.mean())

    def sides(rows):
        for f in range(x.shape[1]):
            own = x[rows, f]
            for cut in np.unique(x[~np.isnan(x[:, f]), f]):
                for nulls in (True, False):
                    yield f, cut, nulls, np.where(np.isnan(own), nulls, own <= cut)

    def split(rows, g):
        found = None
        for f, cut, nulls, left in sides(rows):
            a, b = g[rows[left]], g[rows[~left]]
            if min(len(a), len(b)) < max(least, 1) or min(len(a), len(b)) < weight:
                continue
            gain = worth(a.sum(), len(a)) + worth(b.sum(), len(b)) - worth(g[rows].sum(), len(rows))
            if gain > max(gamma, 1e-12) and (found is None or gain > found[0] + 1e-9):
                found = (gain, f, cut, nulls, left)
        return found

    for _ in range(rounds):
        g = p - y
        parts = [(np.arange(len(y)), 0)]
        if growth == "leafwise":
            while len(parts) < leaves:
                tried = [(s, i) for i, (rows, d) in enumerate(parts) if d < depth and (s := split(rows, g))]
                if not tried:
                    break
                s, i = max(tried, key=lambda t: t[0][0])
                rows, d = parts.pop(i)
                parts += [(rows[s[4]], d + 1), (rows[~s[4]], d + 1)]
        elif growth == "depthwise":
            done = []
            while parts:
                rows, d = parts.pop()
                s = split(rows, g) if d < depth else None
                if s:
                    parts += [(rows[s[4]], d + 1), (rows[~s[4]], d + 1)]
                else:
                    done.append((rows, d))
            parts = done
        else:
            for _ in range(depth):
                total = {}
                for rows, _ in parts:
                    for f, cut, nulls, left in sides(rows):
                        a, b = g[rows[left]], g[rows[~left]]
                        gain = max(worth(a.sum(), len(a)) + worth(b.sum(), len(b)) - worth(g[rows].sum(), len(rows)), 0) if len(a) and len(b) else 0
                        total[f, cut, nulls] = total.get((f, cut, nulls), 0) + gain
                f, cut, nulls = max(total, key=total.get)
                if total[f, cut, nulls] <= 1e-12:
                    break
                go = np.where(np.isnan(x[:, f]), nulls, x[:, f] <= cut)
                parts = [(rows[m], 0) for rows, _ in parts for m in (go[rows], ~go[rows])]
        for rows, _ in parts:
            t = g[rows].sum()
            if len(rows) + lam > 0:
                p[rows] -= rate * math.copysign(max(abs(t) - alpha, 0), t) / (len(rows) + lam)
    return p


CASES = [
    (LightGBM, {"n_estimators": 3, "num_leaves": 7, "learning_rate": 0.5, "min_child_samples": 10}, {"growth": "leafwise", "rounds": 3, "rate": 0.5, "leaves": 7, "least": 10}),
    (LightGBM, {"n_estimators": 1, "num_leaves": 20, "max_depth": 3, "reg_lambda": 1.5, "min_split_gain": 0.2, "min_child_samples": 1}, {"growth": "leafwise", "rounds": 1, "rate": 0.1, "leaves": 20, "depth": 3, "lam": 1.5, "gamma": 0.2}),
    (XGBoost, {"n_estimators": 3, "max_depth": 3, "reg_alpha": 1.0, "gamma": 0.3, "min_child_weight": 6}, {"growth": "depthwise", "rounds": 3, "rate": 0.3, "depth": 3, "lam": 1.0, "alpha": 1.0, "gamma": 0.3, "weight": 6}),
    (CatBoost, {"iterations": 3, "depth": 3, "learning_rate": 0.4}, {"growth": "symmetric", "rounds": 3, "rate": 0.4, "depth": 3, "lam": 3.0}),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_trees_equal_plain_ones(spark, case):
    make, params, how = CASES[case]
    for seed in (case, 10 + case):
        x, y = data(seed)
        model = make(**params, nulls="learn")
        df = frame(spark, x, y)
        found = model.fit(df, NAMES, "y").predict(df, NAMES).collect()
        expect = plain(x, y, **how)
        key = lambda r: tuple(-9.0 if v is None or math.isnan(v) else v for v in r)
        got = sorted(key((r.a, r.b, r.c, r.y, r.prediction)) for r in found)
        assert np.allclose(got, sorted(key((*r, t, p)) for r, t, p in zip(x.tolist(), y.tolist(), expect.tolist(), strict=True)), atol=1e-8)
        one = found[0]
        assert model.predict_one([one.a, one.b, one.c]) == pytest.approx(one.prediction)
    assert sum(model.importances()) == pytest.approx(1) and len(model.importances()) == 3


@pytest.mark.parametrize("case", [0, 2, 3])
def test_tables_in_partitions_grow_the_same_trees(spark, case, monkeypatch):
    make, params, _ = CASES[case]
    x, y = data(5)
    df = frame(spark, x, y, 4)
    held = make(**params, nulls="learn").fit(df, NAMES, "y")
    monkeypatch.setattr(boosting, "SMALL", 10)
    monkeypatch.setattr(boosting, "KEEP", 2)
    spread = make(**params, nulls="learn").fit(df, NAMES, "y")
    assert [t.feature for t in spread.trees] == [t.feature for t in held.trees] and [t.bin for t in spread.trees] == [t.bin for t in held.trees]
    assert all(np.allclose(a.value, b.value) for a, b in zip(spread.trees, held.trees, strict=True))


def test_samples_of_rows_and_columns(spark):
    x, y = data(3)
    df = frame(spark, x, y)
    whole, some = (XGBoost(n_estimators=4, max_depth=2, **kw).fit(df, NAMES, "y") for kw in ({}, {"subsample": 0.5, "colsample_bytree": 0.34}))
    assert all(len({f for f in t.feature if f >= 0}) <= 1 for t in some.trees) and [t.value for t in some.trees] != [t.value for t in whole.trees]
    r = np.arange(100_000) * 7919
    shares = [boosting._sampled(r, 1, k, 0.3) for k in (0, 1)]
    assert all(abs(s.mean() - 0.3) < 0.01 for s in shares) and 0.07 < (shares[0] & shares[1]).mean() < 0.11


def test_parameters_are_honoured_or_refused(spark):
    for name, params in (("xgboost", {"made_up": 1}), ("lightgbm", {"gamma": 1}), ("catboost", {"num_leaves": 4}), ("random_forest", {"made_up": 1}), ("random_forest", {"max_depth": 99})):
        with pytest.raises(ValueError, match="parameter"):
            make_model(name, **params).fit(spark.createDataFrame([(1.0, 2.0)], "a double, y double"), ["a"], "y")
    for make, params in ((XGBoost, {"objective": "rank:pairwise"}), (XGBoost, {"subsample": 0}), (LightGBM, {"boosting_type": "dart"}), (CatBoost, {"grow_policy": "Lossguide"}), (LightGBM, {"nulls": "drop"})):
        with pytest.raises(ValueError):
            make(**params)
    m = XGBoost(n_jobs=4, verbosity=0, objective="reg:squarederror", max_depth=-1, grow_policy="lossguide", max_leaves=5, random_state=None)
    assert (m.rules.depth, m.rules.leaves, m.rules.growth, m.rules.seed) == (0, 5, "leafwise", 42)


def test_awkward_tables(spark):
    x, y = data(1, 40)
    for rows in ([(1.0, 5.0)], [(None, 3.0), (None, None)], [(2.0, 1.0)] * 30):
        df = spark.createDataFrame(rows, "a double, y double")
        for make in (XGBoost, LightGBM, CatBoost):
            m = make(nulls="learn", n_estimators=5).fit(df, ["a"], "y")
            want = np.mean([t or 0.0 for _, t in rows])
            assert all(r.prediction == pytest.approx(want) for r in m.predict(df, ["a"]).collect()) and len(m.trees) == 1
    empty = spark.createDataFrame([], "a double, y double")
    assert XGBoost(n_estimators=2).fit(empty, ["a"], "y").predict(empty, ["a"]).count() == 0
    none = XGBoost(n_estimators=2).fit(frame(spark, x, y), [], "y")
    assert {round(r.prediction, 9) for r in none.predict(frame(spark, x, y), []).collect()} == {round(float(y.mean()), 9)}
    zero = XGBoost(n_estimators=2).fit(frame(spark, x, y), NAMES, "y")  # nulls count as 0
    assert zero.predict_one([0.0, 1.0, 0.0]) == zero.predict(spark.createDataFrame([(None, 1.0, None)], "a double, b double, c double"), NAMES).first().prediction


def test_many_values_are_cut_by_quantiles(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 3))
    y = (x[:, 0] > 0.3) * 2.0 + x[:, 1]
    m = LightGBM(n_estimators=30, max_bin=31).fit(frame(spark, x, y), NAMES, "y")
    assert all(len(e) <= 30 for e in m.edges) and m.importances()[2] < 0.05
    p = np.array([x_.prediction - x_.y for x_ in m.predict(frame(spark, x, y), NAMES).collect()])
    assert p.std() < 0.35 * y.std()


def test_target_statistics_never_see_their_own_row(spark):
    r = np.random.default_rng(8)
    rows = [(int(i), "hot" if i % 3 else f"c{i % 7}" if i % 5 else None, float(r.integers(0, 100))) for i in range(400)]
    df = spark.createDataFrame(rows, "i long, k string, y double").repartition(5)
    found = {x.i: x.k_ordered for x in target_statistics(df, "k", "y", order_by=["i"]).collect()}
    prior, seen = np.mean([y for *_, y in rows]), {}
    for i, k, y in rows:
        s, n = seen.get(k, (0.0, 0))
        assert found[i] == pytest.approx((s + prior) / (n + 1))
        seen[k] = (s + y, n + 1)
    first = {x.i: x.k_ordered for x in target_statistics(df, "k", "y").collect()}
    assert first == {x.i: x.k_ordered for x in target_statistics(df.repartition(2), "k", "y").collect()}


def test_catboost_with_categories(spark):
    r = np.random.default_rng(9)
    rows = [(f"k{int(k)}", float(v), float(10 * (int(k) % 3) + v)) for k, v in zip(r.integers(0, 12, 600), r.random(600), strict=True)]
    df = spark.createDataFrame(rows, "k string, v double, y double")
    m = CatBoost(iterations=40, learning_rate=0.3, depth=4, cat_features=["k"]).fit(df, ["k", "v"], "y")
    found = m.predict(df, ["k", "v"]).collect()
    assert np.std([x.prediction - x.y for x in found]) < 2.0 and m.predict(df, ["k", "v"]).columns == ["k", "v", "y", "prediction"]
    new = m.predict(spark.createDataFrame([("unseen", 0.5), (None, 0.5)], "k string, v double"), ["k", "v"]).collect()
    assert all(5 < x.prediction < 15 for x in new)
    with pytest.raises(ValueError, match="cat_features"):
        CatBoost(cat_features=["z"]).fit(df, ["k"], "y")


@pytest.mark.parametrize("kind", ["xgboost", "lightgbm", "catboost"])
def test_forecaster_with_boosted_trees(spark, tmp_path, kind):
    rows = [(f"{2015 + i // 12}-{i % 12 + 1:02}-01", 100.0 + 10 * (i % 12) + i) for i in range(72)]
    df = spark.createDataFrame(rows, "date string, y double")
    config = ConfigManager(values={"forecasting": {"model_type": kind, "backtest_months": 6, kind: {"n_estimators": 30, "learning_rate": 0.2}}}, environment={})
    made = TimeSeriesForecaster(config).fit(df, "y", "date")
    ahead = [x.prediction for x in made.predict(6).collect()]
    assert len(ahead) == 6 and all(80 < p < 300 for p in ahead)
    made.save(str(tmp_path / kind), spark)
    again = TimeSeriesForecaster.load(str(tmp_path / kind), spark, config)
    assert [x.prediction for x in again.predict(6).collect()] == ahead
    save_model(made.model, str(tmp_path / "m"), spark, {})
    assert load_model(str(tmp_path / "m"), spark)[0].state() == made.model.state()
