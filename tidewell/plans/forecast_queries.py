"""Registered queries of models and forecasts. Linear models are checked by SQL that solves their normal equations.

Amounts are in millions, so that penalties and rounding are of one size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.config import ConfigManager
from tidewell.operators.features import FeaturePipeline, Lag, Rolling
from tidewell.plans.forecaster import TimeSeriesForecaster, segment_ridge_forecast
from tidewell.plans.models import BayesianRidge, Linear, Trees, register_model
from tidewell.plans.queries import MONTHLY, PANEL, monthly, panel, query, rounded, table
from tidewell.plans.smoothing import holt_winters_forecast, holt_winters_weights, trend_fourier_forecast
from tidewell.plans.trend import prophet_forecast
from tidewell.scratch import scratch
from tidewell.sources.io import read_csv


def solved(name: str, rows: str, features: Sequence[str], y: str, alpha: float, key: str = "1") -> str:
    """CTEs up to ``name`` (key, w, b): the ridge of ``y`` on ``features`` over ``rows`` for each key, by elimination."""
    p = len(features)
    centred = [f"(x[{i}] - mx[{i}])" for i in range(1, p + 1)] + ["(y - my)"]
    matrix = ", ".join(
        "[" + ", ".join(
            f"sum({centred[i]} * {centred[j]})" + (f" + {alpha}" if i == j else "") for j in range(p + 1)
        ) + "]" for i in range(p)
    )
    return f"""{name}_x AS (SELECT {key} AS key, [{", ".join(f"({f})::DOUBLE" for f in features)}] AS x, ({y})::DOUBLE AS y FROM {rows}),
    {name}_m AS (SELECT key, [{", ".join(f"avg(x[{i}])" for i in range(1, p + 1))}] AS mx, avg(y) AS my FROM {name}_x GROUP BY key),
    {name}_a AS (SELECT key, [{matrix}] AS a FROM {name}_x JOIN {name}_m USING (key) GROUP BY key),
    {name}_e AS (SELECT key, 1 AS k, a FROM {name}_a UNION ALL
        SELECT key, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / a[k][k]) ELSE list_transform(r, lambda
            v, j: v - r[k] * a[k][j] / a[k][k]) END) FROM {name}_e WHERE k <= {p}),
    {name} AS (SELECT key, list_transform(a, lambda r: r[{p + 1}]) AS w, my - list_dot_product(list_transform(a, lambda r: r[{p + 1}]), mx) AS b FROM
        {name}_e JOIN {name}_m USING (key) WHERE k = {p + 1})"""


def scaled(df: DataFrame) -> DataFrame:
    return df.withColumn("actual", F.col("actual") / 1e6)


# ---------------------------------------------------------------- models

_INDEXED = f"{MONTHLY}, t AS (SELECT row_number() OVER (ORDER BY date) AS x, actual / 1e6 AS y FROM monthly)"
_SUMS = f"""{_INDEXED}, m AS (SELECT avg(x) AS mx, avg(y) AS my, count(*) AS n FROM t), c AS (SELECT sum((x - mx) * (x - mx)) AS xx, sum((x - mx) * (y
    - my)) AS xy, sum((y - my) * (y - my)) AS yy, any_value(mx) AS mx, any_value(my) AS my, any_value(n) AS n FROM t, m)"""


def _indexed(spark: SparkSession, d: str) -> DataFrame:
    from tidewell.operators.ordered import numbered

    return numbered(monthly(spark, d).select("date", (F.col("actual") / 1e6).alias("y")), ["date"], "x").select("x", "y")


@query(f"WITH {_SUMS} SELECT x, round(my + xy / xx * (x - mx), 4) AS prediction FROM t, c")
def linear_trend(spark: SparkSession, d: str) -> DataFrame:
    rows = _indexed(spark, d)
    return rounded(Linear("linear").fit(rows, ["x"], "y").predict(rows, ["x"]).select("x", "prediction"), 4)


@query(
    f"WITH {_SUMS} SELECT x, round(my + sign(xy) * greatest(abs(xy) / n - 0.5, 0) / (xx / n) * (x - mx), 3) + 0.0 AS prediction FROM t, c"
)
def lasso_trend(spark: SparkSession, d: str) -> DataFrame:
    rows = _indexed(spark, d)
    return rounded(Linear("lasso", alpha=0.5).fit(rows, ["x"], "y").predict(rows, ["x"]).select("x", "prediction"), 3)


@query(
    f"WITH {_SUMS} SELECT x, round(my + sign(xy) * greatest(abs(xy) / n - 0.15, 0) / (xx / n + 0.35) * (x - mx), 3) + 0.0 AS prediction FROM t, c"
)
def elastic_net_trend(spark: SparkSession, d: str) -> DataFrame:
    rows = _indexed(spark, d)
    return rounded(Linear("elastic_net", alpha=0.5, l1_ratio=0.3).fit(rows, ["x"], "y").predict(rows, ["x"]).select("x", "prediction"), 3)


@query(f"""WITH RECURSIVE {_SUMS}, i AS (SELECT 0 AS k, 0.0::DOUBLE AS w, 1.0::DOUBLE AS weight, 1 / greatest(yy / n, 1e-12) AS noise, false AS done,
    xx, xy, yy, mx, my, n FROM c UNION ALL
        SELECT k + 1, u, (g + 2e-6) / (u * u + 2e-6), (n - g + 2e-6) / (greatest(yy - 2 * u * xy + u * u * xx, 1e-12) + 2e-6), abs(u - w) < 1e-3, xx,
            xy, yy, mx, my, n
        FROM (SELECT *, xy / (xx + weight / noise) AS u, noise * xx / (weight + noise * xx) AS g FROM i WHERE NOT done AND k < 300)),
    f AS (SELECT * FROM i ORDER BY k DESC LIMIT 1) SELECT x, round(my + w * (x - mx), 4) AS prediction FROM t, f""")
def bayesian_ridge_trend(spark: SparkSession, d: str) -> DataFrame:
    rows = _indexed(spark, d)
    return rounded(BayesianRidge().fit(rows, ["x"], "y").predict(rows, ["x"]).select("x", "prediction"), 4)


@query(f"""WITH {MONTHLY}, t AS (SELECT month(date) AS x, actual / 1e6 AS y FROM monthly), s AS (SELECT c, t.x <= c AS low, avg(y) AS m, var_pop(y) *
    count(*) AS sse FROM t, generate_series(1, 11) g(c) GROUP BY ALL),
    b AS (SELECT c FROM s GROUP BY c HAVING count(*) = 2 ORDER BY sum(sse), c LIMIT 1) SELECT x::INTEGER AS x, round(m, 4) AS prediction, count(*) AS
        n FROM t, b JOIN s USING (c) WHERE low = (x <= c) GROUP BY ALL""")
def trees_stump(spark: SparkSession, d: str) -> DataFrame:
    """One boosted tree of one split is the best split of the months in two."""
    rows = monthly(spark, d).select(F.month("date").alias("x"), (F.col("actual") / 1e6).alias("y"))
    found = Trees("gbt", n_estimators=1, max_depth=1).fit(rows, ["x"], "y").predict(rows, ["x"])
    return rounded(found.groupBy("x", "prediction").agg(F.count(F.lit(1)).alias("n")), 4)


@query(f"""WITH {MONTHLY}, t AS (SELECT month(date) AS x, actual / 1e6 AS y FROM monthly), s AS (SELECT c, t.x <= c AS low, avg(y) AS m, var_pop(y) *
    count(*) AS sse FROM t, generate_series(1, 11) g(c) GROUP BY ALL),
    b AS (SELECT c FROM s GROUP BY c HAVING count(*) = 2 ORDER BY sum(sse), c LIMIT 1) SELECT x::INTEGER AS x, round(m, 4) AS prediction, count(*) AS
        n FROM t, b JOIN s USING (c) WHERE low = (x <= c) GROUP BY ALL""")
def forest_stump(spark: SparkSession, d: str) -> DataFrame:
    """A forest of one tree of one split, grown from every row once."""
    rows = monthly(spark, d).select(F.month("date").alias("x"), (F.col("actual") / 1e6).alias("y"))
    found = Trees("random_forest", n_estimators=1, max_depth=1, bootstrap=False).fit(rows, ["x"], "y").predict(rows, ["x"])
    return rounded(found.groupBy("x", "prediction").agg(F.count(F.lit(1)).alias("n")), 4)


# ---------------------------------------------------------------- the forecaster

# The series that is modelled, its training rows (all but the last twelve months) and their features.
_SERIES = f"""{PANEL}, series AS (SELECT date, sum(actual / 1e6) AS y FROM panel GROUP BY 1), ends AS (SELECT min(date) AS o, max(date) AS e FROM
    series)"""
_TRAIN = f"{_SERIES}, train AS (SELECT * FROM series, ends WHERE date <= e - INTERVAL 12 MONTH)"
_TEST = """test AS (SELECT *, lag(y, 1) OVER (ORDER BY date) AS lag_1, lag(y, 12) OVER (ORDER BY date) AS lag_12, avg(y) OVER (ORDER BY date ROWS 2
    PRECEDING) AS mean_3 FROM series, ends WHERE date > e - INTERVAL 12 MONTH)"""
_LAGS = [
    "coalesce(lag(y, 1) OVER (ORDER BY date), 0)", "coalesce(lag(y, 12) OVER (ORDER BY date), 0)",
    "avg(y) OVER (ORDER BY date ROWS 2 PRECEDING)",
]
_DATE = ["year(date)", "month(date)", "sin(2 * pi() * month(date) / 12)", "cos(2 * pi() * month(date) / 12)", "date - o"]


def _ahead(model: str, lags: bool = True) -> str:
    """CTE ``ahead`` (date, prediction): twelve months after the training rows by the weights of ``model``."""
    history = "[CASE WHEN len(y) >= 1 THEN y[len(y)] ELSE 0 END, CASE WHEN len(y) >= 12 THEN y[len(y) - 11] ELSE 0 END, list_avg(y[greatest(len(y) - 2, 1):])]" if lags else "[]::DOUBLE[]"
    parts = ", ".join(f"({x.replace('date', 'nx')})::DOUBLE" for x in _DATE)
    return f"""h AS (SELECT list(y ORDER BY date) AS y, max(date) AS last, any_value(o) AS o FROM train),
    f AS (SELECT 0 AS i, last, o, y FROM h UNION ALL
        SELECT i + 1, last, o, list_append(y, b + list_dot_product(w, list_concat({history}, [{parts}]))) FROM (SELECT *, (last + to_months(i +
            1))::DATE AS nx FROM f) s, {model} WHERE i < 12),
    ahead AS (SELECT (last + to_months(i))::DATE AS date, round(y[len(y)], 4) AS prediction FROM f WHERE i > 0)"""


def forecaster(spark: SparkSession, d: str, kind: str, lags: bool = True, **more: object) -> TimeSeriesForecaster:
    config = ConfigManager(values={"forecasting": {"model_type": kind, "backtest_months": 12, **more}}, environment={})
    pipeline = FeaturePipeline([Lag("actual", [1, 12]), Rolling("actual", [3])]) if lags else None
    return TimeSeriesForecaster(config).fit(scaled(panel(spark, d)), "actual", "date", group_by="segment", feature_engineer=pipeline)


_RIDGE = solved("ridge", "train", _LAGS + _DATE, "y", 1.0)


@query(f"WITH RECURSIVE {_TRAIN}, {_RIDGE}, {_ahead('ridge')} SELECT * FROM ahead")
def forecast_ridge(spark: SparkSession, d: str) -> DataFrame:
    return rounded(forecaster(spark, d, "ridge").predict(12), 4)


@query(f"WITH RECURSIVE {_TRAIN}, {_RIDGE}, {_ahead('ridge')} SELECT * FROM ahead")
def forecast_saved_model(spark: SparkSession, d: str) -> DataFrame:
    """The model saved with its pipeline, loaded again, and asked for the same months."""
    path = f"{scratch(spark)}/model"
    made = forecaster(spark, d, "ridge")
    made.save(path, spark)
    return rounded(TimeSeriesForecaster.load(path, spark, made.config).predict(12), 4)


@query(f"WITH RECURSIVE {_TRAIN}, {solved('heavy', 'train', _LAGS + _DATE, 'y', 50.0)}, {_ahead('heavy')} SELECT * FROM ahead")
def forecast_registered_model(spark: SparkSession, d: str) -> DataFrame:
    register_model("heavy_ridge", lambda **_: Linear("ridge", alpha=50.0))
    return rounded(forecaster(spark, d, "heavy_ridge").predict(12), 4)


@query(f"""WITH RECURSIVE {_TRAIN}, {_RIDGE}, {solved('heavy', 'train', _LAGS + _DATE, 'y', 50.0)},
    pair AS (SELECT list_transform(list_zip(r.w, h.w), lambda z: 0.25 * z[1] + 0.75 * z[2]) AS w, 0.25 * r.b + 0.75 * h.b AS b FROM ridge r, heavy h),
        {_ahead('pair')} SELECT * FROM ahead""")
def ensemble_of_ridges(spark: SparkSession, d: str) -> DataFrame:
    register_model("heavy_ridge", lambda **_: Linear("ridge", alpha=50.0))
    return rounded(
        forecaster(spark, d, "ensemble", ensemble={"model_a": "ridge", "model_b": "heavy_ridge", "weight_a": 0.25}).predict(12),
        4,
    )


@query(
    f"WITH RECURSIVE {_TRAIN}, {_RIDGE}, names AS (SELECT unnest(['actual_lag_1', 'actual_lag_12', 'actual_rolling_mean_3', 'date_year', 'date_month', 'date_month_sin', 'date_month_cos', 'date_time_index']) AS feature, generate_subscripts(w, 1) AS i FROM ridge) SELECT feature, round(abs(w[i]), 4) AS importance FROM names, ridge"
)
def ridge_importance(spark: SparkSession, d: str) -> DataFrame:
    found = forecaster(spark, d, "ridge").feature_importance()
    return rounded(spark.createDataFrame(list(found.items()), "feature string, importance double"), 4)


_TESTED = f"""{_TRAIN}, {_RIDGE}, {_TEST}, tested AS (SELECT date, y, b + list_dot_product(w, [coalesce(lag_1, 0), coalesce(lag_12, 0), mean_3,
    {', '.join(f'({x})::DOUBLE' for x in _DATE)}]) AS p FROM test, ridge)"""


@query(f"WITH RECURSIVE {_TESTED} SELECT date, round(y, 4) AS actual, round(p, 4) AS prediction FROM tested")
def predictions_on_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows without features go through the fitted pipeline."""
    made = forecaster(spark, d, "ridge")
    raw = made.parts["test"].select("date", "actual")
    return rounded(made.predict_on_df(raw).orderBy("date"), 4)


@query(f"""WITH RECURSIVE {_TESTED}, c AS (SELECT *, lag(y, 1) OVER (ORDER BY date) AS l FROM tested) SELECT round(avg(abs(y - p)), 4) AS mae,
    round(sqrt(avg(power(y - p, 2))), 4) AS rmse, round(1 - sum(power(y - p, 2)) / (var_pop(y) * count(*)), 3) AS r2,
    round(avg(abs((y - p) / y)) * 100, 3) AS mape, round(avg(abs(y - p)) / avg(abs(y - l)), 3) AS mase, round(avg(p - y), 4) AS bias FROM c""")
def evaluation_ridge(spark: SparkSession, d: str) -> DataFrame:
    m = forecaster(spark, d, "ridge").evaluate()
    return m.select(*(F.round(c, n).alias(c) for c, n in (("mae", 4), ("rmse", 4), ("r2", 3), ("mape", 3), ("mase", 3), ("bias", 4))))


@query(f"""WITH RECURSIVE {_TRAIN}, {solved('ridge', 'train', _DATE, 'y', 1.0)}, {_ahead('ridge', lags=False)} SELECT * FROM ahead""")
def cli_forecast(spark: SparkSession, d: str) -> DataFrame:
    """``forecast`` of the command line: a ridge over parts of the date, written as CSV."""
    from tidewell.plans.engine_queries import _cli

    folder = scratch(spark)
    scaled(panel(spark, d)).write.parquet(f"{folder}/panel.parquet")
    config = {
        "data_source": {"date_column": "date", "amount_column": "actual"},
        "forecasting": {"model_type": "ridge", "backtest_months": 12},
    }
    assert _cli(
        spark, config, "forecast", "--input", f"{folder}/panel.parquet", "--output-dir", f"{folder}/out", "--group-by",
        "segment", "--periods", "12",
    ) == 0
    return rounded(read_csv(spark, f"{folder}/out/*", "date date, prediction double"), 4)


_BY_DAY = """series AS (SELECT date_trunc('month', o_orderdate)::DATE AS date, sum(o_totalprice) / 1e6 AS y FROM orders GROUP BY 1), ends AS (SELECT min(date)
    AS o, max(date) AS e FROM series), train AS (SELECT * FROM series, ends WHERE date <= e - INTERVAL 12 MONTH)"""


@query(f"""WITH RECURSIVE {_BY_DAY}, {solved('ridge', 'train', _DATE, 'y', 1.0)}, {_ahead('ridge', lags=False)}
    SELECT date AS month_start, day(last_day(date)) AS days, round(prediction, 2) AS total, round(prediction, 2) AS model FROM ahead""")
def cli_forecast_daily(spark: SparkSession, d: str) -> DataFrame:
    """``forecast --daily``: monthly forecasts spread over the days of their months, read back and added up by month. The
    day after the training rows is taken for today, and a month that the forecast held twice would count once."""
    from tidewell.plans.engine_queries import _cli

    folder, o = scratch(spark), table(spark, d, "orders")
    rows = o.select(F.trunc("o_orderdate", "MM").alias("date"), F.to_date("o_orderdate").alias("day"), (F.col("o_totalprice") / 1e6).alias("actual"))
    rows.write.parquet(f"{folder}/orders.parquet")
    today = rows.agg(F.last_day(F.add_months(F.max("date"), -12))).first()[0]
    config = {
        "data_source": {"date_column": "date", "amount_column": "actual", "daily_date_column": "day"},
        "forecasting": {"model_type": "ridge", "backtest_months": 12, "as_of_date": str(today)},
    }
    assert _cli(spark, config, "forecast", "--input", f"{folder}/orders.parquet", "--output-dir", f"{folder}/out", "--periods", "12", "--daily") == 0
    days = read_csv(spark, f"{folder}/out/daily_forecast*", "date date, month_start date, y_pred double, month_total_model double")
    return days.groupBy("month_start").agg(
        F.count(F.lit(1)).alias("days"), F.round(F.sum("y_pred"), 2).alias("total"), F.round(F.max("month_total_model"), 2).alias("model"),
    )


@query(None)
def forecast_trees(spark: SparkSession, d: str) -> DataFrame:
    return forecaster(spark, d, "xgboost", xgboost={"n_estimators": 10, "max_depth": 3}).predict(12)


def _evidence(rows: str, features: Sequence[str], y: str) -> str:
    """CTE ``evidence`` (w, b): a ridge whose penalty follows from the data, found by repeated elimination."""
    p = len(features)
    eliminated = "SELECT *, list_transform(range(1, {p} + 1), lambda i: list_concat(list_transform(xx[i], lambda v, j: v + CASE WHEN i = j THEN weight / noise ELSE 0 END), [xy[i]], list_transform(range(1, {p} + 1), lambda j: CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END))) AS a FROM evid WHERE NOT done AND k < 300".replace("{p}", str(p))
    for k in range(1, p + 1):
        eliminated = f"SELECT * EXCLUDE (a), list_transform(a, lambda r, i: CASE WHEN i = {k} THEN list_transform(r, lambda v: v / a[{k}][{k}]) ELSE list_transform(r, lambda v, j: v - r[{k}] * a[{k}][j] / a[{k}][{k}]) END) AS a FROM ({eliminated})"
    sums = ", ".join("[" + ", ".join(f"sum((x[{i}] - mx[{i}]) * (x[{j}] - mx[{j}]))" for j in range(1, p + 1)) + "]" for i in range(1, p + 1))
    moments = ", ".join(f"sum((x[{i}] - mx[{i}]) * (y - my))" for i in range(1, p + 1))
    dot = lambda a, b: f"list_dot_product({a}, {b})"
    return f"""ex AS (SELECT [{", ".join(f"({f})::DOUBLE" for f in features)}] AS x, ({y})::DOUBLE AS y FROM {rows}),
    em AS (SELECT [{", ".join(f"avg(x[{i}])" for i in range(1, p + 1))}] AS mx, avg(y) AS my FROM ex),
    eg AS (SELECT [{sums}] AS xx, [{moments}] AS xy, sum((y - my) * (y - my)) AS yy, count(*) AS n, any_value(mx) AS mx, any_value(my) AS my FROM ex, em),
    evid AS (SELECT 0 AS k, list_transform(xy, lambda v: 0.0::DOUBLE) AS w, 1.0::DOUBLE AS weight, 1 / greatest(yy / n, 1e-12) AS noise, false AS done, xx, xy, yy, n, mx, my FROM eg
        UNION ALL SELECT k + 1, u, (g + 2e-6) / ({dot('u', 'u')} + 2e-6), (n - g + 2e-6) / (greatest(yy - 2 * {dot('u', 'xy')} + {dot('u', f'list_transform(xx, lambda r: {dot("r", "u")})')}, 1e-12) + 2e-6),
            list_sum(list_transform(u, lambda v, i: abs(v - w[i]))) < 1e-3, xx, xy, yy, n, mx, my
        FROM (SELECT *, list_transform(a, lambda r: r[{p + 1}]) AS u, {p} - weight / noise * list_sum(list_transform(a, lambda r, i: r[{p + 1} + i])) AS g FROM ({eliminated}))),
    evidence AS (SELECT w, my - {dot('w', 'mx')} AS b FROM evid ORDER BY k DESC LIMIT 1)"""


_LOGS = f"""{PANEL}, raw AS (SELECT date, sum(actual / 1e6) AS actual FROM panel GROUP BY 1), series AS (SELECT date, actual, ln(1 + actual) AS y FROM raw),
    ends AS (SELECT min(date) AS o, max(date) AS e, max(y) AS top FROM series), train AS (SELECT * FROM series, ends WHERE date <= e - INTERVAL 12 MONTH)"""


@query(f"""WITH RECURSIVE {_LOGS}, {_evidence('train', _LAGS + _DATE, 'y')}, {_TEST.replace('SELECT *,', 'SELECT series.*, o, e, top,', 1)},
    c AS (SELECT date, actual AS y, exp(least(b + list_dot_product(w, [coalesce(lag_1, 0), coalesce(lag_12, 0), mean_3, {', '.join(f'({x})::DOUBLE' for x in _DATE)}]), top + 2)) - 1 AS p,
        lag(actual, 1) OVER (ORDER BY date) AS l FROM test, evidence)
    SELECT round(avg(abs(y - p)), 3) AS mae, round(sqrt(avg(power(y - p, 2))), 3) AS rmse, round(1 - sum(power(y - p, 2)) / (var_pop(y) * count(*)), 3) AS r2,
    round(avg(abs((y - p) / y)) * 100, 2) AS mape, round(avg(abs(y - p)) / avg(abs(y - l)), 3) AS mase, round(avg(p - y), 3) AS bias FROM c""")
def forecast_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """A ridge of eight features in logs, whose penalty follows from the data, measured on the months that it didn't see."""
    m = forecaster(spark, d, "bayesian_ridge", use_log_transform=True).evaluate()
    return m.select(*(F.round(c, n).alias(c) for c, n in (("mae", 3), ("rmse", 3), ("r2", 3), ("mape", 2), ("mase", 3), ("bias", 3))))


@query(None)
def ensemble_forecast(spark: SparkSession, d: str) -> DataFrame:
    return forecaster(spark, d, "ensemble", ensemble={"model_a": "ridge", "model_b": "random_forest", "weight_a": 0.5}).predict(12)


# ---------------------------------------------------------------- whole series


_GRID = ((0.1, 0.3, 0.5, 0.7, 0.9), (0.05, 0.3, 0.6), (0.1, 0.4, 0.7), (0.8, 0.9, 0.98))


@query(f"""WITH RECURSIVE {PANEL}, h AS (SELECT segment, list(actual / 1e6 ORDER BY date) AS y FROM panel GROUP BY 1),
    w AS (SELECT a, b, g, phi FROM (SELECT unnest({list(_GRID[0])}::DOUBLE[]) AS a), (SELECT unnest({list(_GRID[1])}::DOUBLE[]) AS b), (SELECT
        unnest({list(_GRID[2])}::DOUBLE[]) AS g), (SELECT unnest({list(_GRID[3])}::DOUBLE[]) AS phi)),
    s AS (SELECT segment, y, a, b, g, phi, 0 AS t, list_avg(y[1:12]) AS level, (list_avg(y[13:24]) - list_avg(y[1:12])) / 12 AS slope,
        list_transform(y[1:12], lambda v: v - list_avg(y[1:12])) AS season, 0.0::DOUBLE AS sse FROM h, w UNION ALL
        SELECT segment, y, a, b, g, phi, t + 1, now, b * (now - level) + (1 - b) * phi * slope, list_transform(season, lambda v, i: CASE WHEN i = t % 12 + 1
            THEN g * (y[t + 1] - now) + (1 - g) * v ELSE v END), sse + power(y[t + 1] - (level + phi * slope) - season[t % 12 + 1], 2)
        FROM (SELECT *, a * (y[t + 1] - season[t % 12 + 1]) + (1 - a) * (level + phi * slope) AS now FROM s WHERE t < len(y)))
    SELECT segment, round(min(sse), 4) AS grid_sse, true AS not_above FROM s WHERE t = len(y) GROUP BY segment""")
def holt_winters(spark: SparkSession, d: str) -> DataFrame:
    """The squared error of the best weights of a grid, damping included, and that the search finds none that is worse."""
    from itertools import product

    rows = scaled(panel(spark, d))
    found = holt_winters_weights(rows, "date", "actual", "segment", damped=True).select("segment", F.col("sse").alias("found"))
    grid = holt_winters_weights(rows, "date", "actual", "segment", grid=list(product(*_GRID)), damped=True)
    return grid.join(found, "segment").select("segment", F.round("sse", 4).alias("grid_sse"), (F.col("found") <= F.col("sse") + 1e-9).alias("not_above"))


@query(f"""WITH RECURSIVE {PANEL}, h AS (SELECT segment, list(actual / 1e6 ORDER BY date) AS y, max(date) AS last FROM panel GROUP BY 1),
    s AS (SELECT segment, last, y, 0 AS t, list_avg(y[1:12]) AS level, (list_avg(y[13:24]) - list_avg(y[1:12])) / 12 AS slope, list_transform(y[1:12],
        lambda v: v - list_avg(y[1:12])) AS season FROM h UNION ALL
        SELECT segment, last, y, t + 1, now, 0.1 * (now - level) + 0.9 * slope, list_transform(season, lambda v, i: CASE WHEN i = t % 12 + 1 THEN 0.3
            * (y[t + 1] - now) + 0.7 * v ELSE v END)
        FROM (SELECT *, 0.5 * (y[t + 1] - season[t % 12 + 1]) + 0.5 * (level + slope) AS now FROM s WHERE t < len(y)))
    SELECT segment, (last + to_months(k::INTEGER))::DATE AS date, round(level + slope * k + season[(len(y) + k - 1) % 12 + 1], 4) AS prediction FROM
        s, generate_series(1, 12) g(k) WHERE t = len(y)""")
def holt_winters_given_weights(spark: SparkSession, d: str) -> DataFrame:
    return rounded(holt_winters_forecast(scaled(panel(spark, d)), "date", "actual", 12, "segment", weights=[0.5, 0.1, 0.3, 1.0]), 4)


_YEAR = "((date - o) / 365.25)"
_WAVES = [_YEAR, *(f"{f}(2 * pi() * {k} * {_YEAR})" for k in (1, 2, 3) for f in ("sin", "cos"))]


def _fourier(rows: str, key: str, extra: Sequence[str] = ()) -> str:
    """The trend's bounds and its forecast; ``rows`` has key, date, y, o (first date) and what ``extra`` needs."""
    terms = [*_WAVES, *extra]
    values = "[" + ", ".join(f"({x})::DOUBLE" for x in terms) + "]"
    return f"""{solved('fit', rows, terms, 'y', 0.0, key)}, spread AS (SELECT {key} AS key, stddev_samp(y - b - list_dot_product(w, {values})) AS s,
        max(date) AS last, any_value(o) AS o FROM {rows} JOIN fit ON fit.key = {key} GROUP BY 1),
    ahead AS (SELECT key, o, s, (date_trunc('month', last) + to_months(k::INTEGER))::DATE AS date FROM spread, generate_series(1, 12) g(k))"""


def _shown(values: str, key: str = "") -> str:
    return f"SELECT {key}date, round(p, 4) AS prediction, round(p - 1.2816 * s, 4) AS prediction_lower, round(p + 1.2816 * s, 4) AS prediction_upper FROM (SELECT key, date, s, b + list_dot_product(w, {values}) AS p FROM ahead JOIN fit USING (key))"


_AHEAD = "[" + ", ".join(f"({x})::DOUBLE" for x in _WAVES) + "]"


@query(
    f"WITH RECURSIVE {MONTHLY}, r AS (SELECT date, actual / 1e6 AS y, min(date) OVER () AS o FROM monthly), {_fourier('r', '1')} {_shown(_AHEAD)}"
)
def trend_fourier(spark: SparkSession, d: str) -> DataFrame:
    return rounded(trend_fourier_forecast(scaled(monthly(spark, d)), "date", "actual", 12), 4)


@query(
    f"WITH RECURSIVE {PANEL}, r AS (SELECT segment, date, actual / 1e6 AS y, min(date) OVER (PARTITION BY segment) AS o FROM panel), {_fourier('r', 'segment')} {_shown(_AHEAD, 'key AS segment, ')}"
)
def trend_fourier_by_segment(spark: SparkSession, d: str) -> DataFrame:
    return rounded(trend_fourier_forecast(scaled(panel(spark, d)), "date", "actual", 12, group_by="segment"), 4)


@query(f"""WITH RECURSIVE {MONTHLY}, r AS (SELECT date, actual / 1e6 AS y, min(date) OVER () AS o, (day(last_day(date)) - 30)::DOUBLE AS d FROM
    monthly), {_fourier('r', '1', ['d'])},
    held AS (SELECT arg_max(d, date) AS d FROM r) {_shown(_AHEAD[:-1] + ', (SELECT d FROM held)]')}""")
def trend_fourier_with_regressor(spark: SparkSession, d: str) -> DataFrame:
    rows = scaled(monthly(spark, d)).withColumn("d", F.day(F.last_day("date")) - 30)
    return rounded(trend_fourier_forecast(rows, "date", "actual", 12, regressors=["d"]), 4)


@query(f"""WITH RECURSIVE {PANEL}, p AS (SELECT segment, date, actual / 1e6 AS y FROM panel), r AS (SELECT *, coalesce(lag(y, 1) OVER w, 0) AS l1,
    coalesce(lag(y, 12) OVER w, 0) AS l12 FROM p WINDOW w AS (PARTITION BY segment ORDER BY date)),
    {solved('fit', 'r', ['l1', 'l12', 'sin(2 * pi() * month(date) / 12)', 'cos(2 * pi() * month(date) / 12)'], 'y', 1.0, 'segment')}, h AS (SELECT
        segment, list(y ORDER BY date) AS y, max(date) AS last FROM p GROUP BY 1),
    f AS (SELECT segment, last, 0 AS i, y FROM h UNION ALL
        SELECT segment, last, i + 1, list_append(y, b + list_dot_product(w, [y[len(y)], CASE WHEN len(y) >= 12 THEN y[len(y) - 11] ELSE 0 END, sin(2 *
            pi() * month(nx) / 12), cos(2 * pi() * month(nx) / 12)]))
        FROM (SELECT *, (last + to_months(i + 1))::DATE AS nx FROM f) s JOIN fit ON fit.key = segment WHERE i < 12)
    SELECT segment, (last + to_months(i))::DATE AS date, round(y[len(y)], 4) AS prediction FROM f WHERE i > 0""")
def forecast_per_segment(spark: SparkSession, d: str) -> DataFrame:
    """A ridge of each segment's own is fitted by its sums of products; all segments forecast side by side."""
    return rounded(segment_ridge_forecast(scaled(panel(spark, d)), "segment", "date", "actual", 12), 4)


# ---------------------------------------------------------------- a trend that bends


def _bent(rows: str, key: str, penalty: float) -> str:
    """One changepoint, at the last of the first four fifths of the rows: level and slope are taken out of the bend's column,
    and the bend is its least-squares value moved towards zero by the penalty."""
    return f"""r AS (SELECT {key} AS key, date, y / max(abs(y)) OVER w AS z, max(abs(y)) OVER w AS scale,
        (date - min(date) OVER w)::DOUBLE / (max(date) OVER w - min(date) OVER w) AS t, row_number() OVER (PARTITION BY {key} ORDER BY date) - 1 AS i, count(*) OVER w AS n
        FROM {rows} WINDOW w AS (PARTITION BY {key})),
    p AS (SELECT key, t AS s FROM r WHERE i = floor(n * 0.8) - 1),
    h AS (SELECT r.*, s, greatest(t - s, 0) AS h FROM r JOIN p USING (key)),
    m AS (SELECT key, avg(t) AS mt, avg(z) AS mz, avg(h) AS mh, regr_slope(h, t) AS bh, regr_slope(z, t) AS bz FROM h GROUP BY key),
    f AS (SELECT h.*, mt, mz, mh, bz, bh, h - mh - bh * (t - mt) AS e FROM h JOIN m USING (key)),
    d AS (SELECT key, sign(sum(e * z)) * greatest(abs(sum(e * z)) - {penalty}, 0) / sum(e * e) AS d, any_value(s) AS s, any_value(mt) AS mt, any_value(mz) AS mz,
        any_value(mh) AS mh, any_value(bz) AS bz, any_value(bh) AS bh, any_value(scale) AS scale, max(date) AS last, min(date) AS o FROM f GROUP BY key),
    a AS (SELECT *, (date_trunc('month', last) + to_months(k::INTEGER))::DATE AS date FROM d, generate_series(1, 12) g(k)),
    x AS (SELECT *, (date - o)::DOUBLE / (last - o) AS t FROM a)"""


_BENT = "round(scale * (mz + bz * (t - mt) + d * (t - s - mh - bh * (t - mt))), 4) AS prediction"


@query(f"WITH {MONTHLY}, v AS (SELECT date, actual / 1e6 AS y FROM monthly), {_bent('v', '1', 0.05)} SELECT date, {_BENT} FROM x")
def prophet_one_changepoint(spark: SparkSession, d: str) -> DataFrame:
    found = prophet_forecast(
        scaled(monthly(spark, d)), "date", "actual", 12, yearly_seasonality=False, n_changepoints=1, changepoint_penalty=0.05,
    )
    return rounded(found.select("date", "prediction"), 4)


@query(f"WITH {PANEL}, v AS (SELECT segment, date, actual / 1e6 AS y FROM panel), {_bent('v', 'segment', 0.02)} SELECT key AS segment, date, {_BENT} FROM x")
def prophet_one_changepoint_by_segment(spark: SparkSession, d: str) -> DataFrame:
    found = prophet_forecast(
        scaled(panel(spark, d)), "date", "actual", 12, "segment", yearly_seasonality=False, n_changepoints=1, changepoint_penalty=0.02,
    )
    return rounded(found.select("segment", "date", "prediction"), 4)


@query(f"""WITH {PANEL}, v AS (SELECT segment, max(date) AS last FROM panel GROUP BY 1) SELECT segment, (date_trunc('month', last) + to_months(k::INTEGER))::DATE AS date,
    true AS ordered FROM v, generate_series(1, 12) g(k)""")
def prophet_bounds(spark: SparkSession, d: str) -> DataFrame:
    """The whole model for each segment: its months, and that the bounds enclose the forecast."""
    found = prophet_forecast(scaled(panel(spark, d)), "date", "actual", 12, "segment")
    return found.select("segment", "date", ((F.col("prediction_lower") < F.col("prediction")) & (F.col("prediction") < F.col("prediction_upper"))).alias("ordered"))
