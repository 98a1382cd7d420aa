"""The monthly forecaster: split, fit, recursive prediction, evaluation, persistence.

The frame is aggregated to one row a month before anything comes to the driver, so what is collected is a few hundred
numbers whatever the size of the data. Linear models over many segments forecast inside Catalyst (``fold_forecast``).
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence
from dataclasses import asdict
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.functions.numbers import number
from tidewell.operators.features import FeaturePipeline, Names, col, names
from tidewell.operators.metrics import accuracy, horizon_errors
from tidewell.operators.series import LogTransform, prepare, split, sum_by_date
from tidewell.plans.models import Regressor, load_model, make_model, save_model
from tidewell.plans.smoothing import holt_winters_forecast
from tidewell.plans.trend import prophet_forecast


def months_after(start: date, n: int) -> list[date]:
    k = start.year * 12 + start.month - 1
    return [date((k + i) // 12, (k + i) % 12 + 1, 1) for i in range(n)]


def date_features(df: DataFrame, name: str, origin: date | None = None) -> DataFrame:
    """``_year``, ``_month``, its place on the circle, and ``_time_index``: days since ``origin`` or the first date."""
    d = col(name).cast("date")
    start = F.lit(origin.isoformat()).cast("date") if origin else F.lit(df.agg(F.min(d)).first()[0])
    m = F.month(d)
    return df.withColumns(
        {
            f"{name}_year": F.year(d), f"{name}_month": m, f"{name}_month_sin": F.sin(2 * F.pi() * m / 12),
            f"{name}_month_cos": F.cos(2 * F.pi() * m / 12), f"{name}_time_index": F.datediff(d, start),
        }
    )


def future_value(feature: str, target: str, name: str, when: date, history: Sequence[float], origin: date, last: dict[str, Any]) -> float:
    """What a feature is in a month to come: lags and rolling means of the history, parts of the date, or its last value."""
    if m := re.fullmatch(rf"{re.escape(target)}_lag_(\d+)", feature):
        k = int(m[1])
        return float(history[-k]) if len(history) >= k else 0.0
    if m := re.fullmatch(rf"{re.escape(target)}_rolling_mean_(\d+)", feature):
        tail = history[-int(m[1]) :]
        return math.fsum(tail) / len(tail) if tail else 0.0
    quarter = (when.month - 1) // 3 + 1
    parts = {"year": when.year, "month": when.month, "quarter": quarter, "time_index": (when - origin).days}
    for part, value, n in (("month", when.month, 12), ("quarter", quarter, 4)):
        parts[f"{part}_sin"], parts[f"{part}_cos"] = math.sin(2 * math.pi * value / n), math.cos(2 * math.pi * value / n)
    if feature.startswith(f"{name}_") and feature[len(name) + 1 :] in parts:
        return float(parts[feature[len(name) + 1 :]])
    return float(last.get(feature) or 0.0)


def fold_forecast(
    series: DataFrame, coefficients: dict[str, float], intercept: float, periods: int, order_by: str, target: str,
    group_by: Names = None,
) -> DataFrame:
    """Recursive forecast of a linear model over ``lag_k``, ``rolling_mean_w``, ``month_sin`` and ``month_cos``, in Catalyst.

    [group,] horizon, date, prediction. A segment's history is one array and the months are folded over it: segments
    forecast side by side, without Python. A lag before the first value is 0.
    """
    groups = names(group_by)
    ordered = F.array_sort(
        F.collect_list(F.struct(col(order_by).cast("date").alias("d"), F.coalesce(number(col(target)), F.lit(0.0)).alias("y")))
    )
    hist = series.groupBy(*map(col, groups)).agg(ordered.alias("__h")).select(
        *map(col, groups), F.transform("__h", lambda x: x["y"]).alias("__y"),
        F.element_at("__h", -1)["d"].alias("__last"),
    )

    def step(state: Column, h: Column) -> Column:
        month = F.month(F.add_months(F.col("__last"), h))
        total: Column = F.lit(float(intercept))
        for name, w in coefficients.items():
            kind, _, k = name.rpartition("_")
            if kind == "lag":
                value = F.coalesce(F.when(F.size(state) >= int(k), F.element_at(state, -int(k))), F.lit(0.0))
            elif kind == "rolling_mean":
                n = F.least(F.size(state), F.lit(int(k)))
                value = F.aggregate(F.slice(state, -n, n), F.lit(0.0), lambda a, b: a + b) / n
            elif name in ("month_sin", "month_cos"):
                value = (F.sin if name == "month_sin" else F.cos)(2 * F.pi() * month / 12)
            else:
                raise ValueError(f"not a feature of the fold: {name}")
            total = total + value * float(w)
        return F.concat(state, F.array(total))

    folded = hist.withColumn("__y", F.aggregate(F.sequence(F.lit(1), F.lit(periods)), F.col("__y"), step))
    tail = F.slice(F.col("__y"), -periods, periods)
    rows = folded.select(*map(col, groups), "__last", F.posexplode(tail).alias("__i", "prediction"))
    return rows.select(
        *map(col, groups), (F.col("__i") + 1).alias("horizon"),
        F.trunc(F.add_months("__last", F.col("__i") + 1), "MM").alias("date"), "prediction",
    )


def solved(matrix: Column, n: int) -> Column:
    """The solution of n equations, given as an array of n rows of n + 1 numbers with a positive definite left side: Gauss's
    elimination as array functions."""

    def step(a: Column, k: Column) -> Column:
        pivot = F.element_at(a, k)
        row = F.transform(pivot, lambda v: v / F.element_at(pivot, k))
        return F.transform(
            a, lambda r, i: F.when(i == k - 1, row).otherwise(F.transform(r, lambda v, j: v - F.element_at(r, k) * F.element_at(row, j + 1))),
        )

    done = F.aggregate(F.sequence(F.lit(1), F.lit(n)), matrix, step)
    return F.transform(done, lambda r: F.element_at(r, n + 1))


def segment_ridge_forecast(
    panel: DataFrame, segment: str, date_column: str, target: str, periods: int, alpha: float = 1.0,
    lags: Sequence[int] = (1, 12),
) -> DataFrame:
    """[segment,] date, prediction: a lagged ridge of each segment, fitted and folded.

    All segments at once, without Python: the sums of products are one aggregation by segment, each segment's equations are
    solved in its row, and its months are folded over its history. A segment is a monthly series, so its history fits a row.
    """
    lags = list(lags)
    if alpha <= 0:
        raise ValueError("a ridge needs a penalty above 0")
    w = Window.partitionBy("__s").orderBy("__d")
    rows = panel.select(
        col(segment).alias("__s"), col(date_column).cast("date").alias("__d"), F.coalesce(number(col(target)), F.lit(0.0)).alias("__y"),
    )
    turn = lambda d: [f(2 * F.pi() * F.month(d) / 12) for f in (F.sin, F.cos)]
    x = [f"__x{i}" for i in range(len(lags) + 2)]
    made = [*(F.coalesce(F.lag("__y", k).over(w), F.lit(0.0)) for k in lags), *turn(F.col("__d"))]
    known = rows.select("*", *(c.alias(n) for c, n in zip(made, x, strict=True)))
    n, p = F.count(F.lit(1)), len(x)
    products = {f"__g{i}_{j}": F.covar_pop(x[i], x[j]) * n for i in range(p) for j in range(i, p)}
    moments = {f"__c{i}": F.covar_pop(x[i], "__y") * n for i in range(p)}
    sums = known.groupBy("__s").agg(
        *(c.alias(k) for k, c in {**products, **moments}.items()), *(F.avg(c).alias(f"__m_{c}") for c in (*x, "__y")),
        F.max("__d").alias("__last"), F.array_sort(F.collect_list(F.struct("__d", "__y"))).alias("__h"),
    )
    gram = lambda i, j: F.col(f"__g{min(i, j)}_{max(i, j)}") + (alpha if i == j else 0.0)
    matrix = F.array(*(F.array(*(gram(i, j) for j in range(p)), F.col(f"__c{i}")) for i in range(p)))
    fitted = sums.select("__s", "__last", F.transform("__h", lambda h: h["__y"]).alias("__h"), solved(matrix, p).alias("__w"), *(f"__m_{c}" for c in (*x, "__y")))

    def step(state: Column, h: Column) -> Column:
        now = [F.coalesce(F.when(F.size(state) >= k, F.element_at(state, -k)), F.lit(0.0)) for k in lags] + turn(F.add_months("__last", h))
        parts = [(v - F.col(f"__m_{c}")) * F.element_at("__w", i + 1) for i, (v, c) in enumerate(zip(now, x, strict=True))]
        return F.concat(state, F.array(sum(parts, F.col("__m___y"))))

    folded = fitted.withColumn("__h", F.aggregate(F.sequence(F.lit(1), F.lit(periods)), F.col("__h"), step))
    out = folded.select("__s", "__last", F.posexplode(F.slice("__h", -periods, periods)).alias("__i", "prediction"))
    return out.select(F.col("__s").alias(segment), F.trunc(F.add_months("__last", F.col("__i") + 1), "MM").alias("date"), "prediction")


class TimeSeriesForecaster:
    """Forecasts a monthly target, of one series or of a panel summed by month.

    ``config`` needs only get(path, default). The forecast begins after the training rows; predicting twice gives the
    same months again. An inverse transform is applied only where a transform was.
    """

    def __init__(self, config: Any) -> None:
        self.config, self.model, self.log, self.pipeline, self.features = config, None, None, None, []
        self.cached: DataFrame | None = None
        self.split_meta: dict[str, Any] = {}
        self.horizon_rows: DataFrame | None = None

    def adaptive_params(self, rows: int) -> dict[str, Any]:
        """Parameters of boosted trees: the general ones, and over them those of the tier that the number of rows falls into."""
        get = self.config.get
        tiers = (
            (int(get("forecasting.segment_tuning.small_threshold", 30)), "small"),
            (int(get("forecasting.segment_tuning.medium_threshold", 48)), "medium"), (math.inf, "large"),
        )
        tier = next(name for below, name in tiers if rows < below)
        special = get(f"forecasting.segment_tuning.{tier}", None) if get("forecasting.segment_tuning.enabled", False) else None
        return (get("forecasting.xgboost", None) or {}) | (special or {})

    def prepare_data(self, df: DataFrame, target: str, date_column: str, group_by: Names = None, summed: bool = False) -> DataFrame:
        c = self.config.get
        out, _ = prepare(
            df, date_column, target, group_by, c("data_source.date_format", None),
            c("forecasting.outlier_handling", None) if (c("forecasting.outlier_handling", None) or {}).get("enabled") else None,
            summed=summed,
        )
        return out

    def in_logs(self, df: DataFrame, target: str) -> DataFrame:
        """The target in logs where they are asked for: of the series that is modelled, so after segments are summed."""
        if self.config.get("forecasting.use_log_transform", False):
            self.log = LogTransform.fit(df, target, float(self.config.get("forecasting.log_transform_offset", 0) or 0))
            df = df.withColumn(target, self.log.apply(number(col(target))))
        return df

    def fit(
        self, df: DataFrame, target: str, date_column: str, group_by: str | None = None, already_prepared: bool = False,
        feature_engineer: FeaturePipeline | None = None, features: Sequence[str] | None = None,
    ) -> TimeSeriesForecaster:
        c = self.config.get
        self.target, self.date, self.group_by = target, date_column, group_by
        data = df if already_prepared else self.prepare_data(df, target, date_column, group_by, summed=True)
        # One row for each date before anything is modelled or collected; a series that has one already stays as it is.
        data = sum_by_date(data.withColumn(date_column, col(date_column).cast("date")), date_column, group_by)
        if not already_prepared:
            data = self.in_logs(data, target)
        marked, self.split_meta = split(
            data, date_column, int(c("forecasting.backtest_months", 0) or 0),
            int(c("forecasting.validation_months", 0) or 0), c("forecasting.backtest_cutoff_month", None),
            float(c("forecasting.test_size", 0.2)), float(c("forecasting.validation_split", 0.1)),
        )
        self.cached = marked = marked.persist()
        parts = {k: marked.filter(F.col("split") == k).drop("split") for k in ("train", "validation", "test")}
        self.pipeline = feature_engineer
        if feature_engineer is not None:
            feature_engineer.long = False  # a row for each date
            parts["train"] = feature_engineer.fit_transform(parts["train"], None, date_column)
            parts["validation"], parts["test"] = feature_engineer.transform(parts["validation"]), feature_engineer.transform(parts["test"])
        rows, self.origin, self.train_end = parts["train"].agg(
            F.count(F.lit(1)), F.min(col(date_column).cast("date")), F.max(col(date_column).cast("date")),
        ).first()
        if not rows:
            raise ValueError("no rows to train on")
        self.parts = {k: date_features(v, date_column, self.origin) for k, v in parts.items()}
        train = self.parts["train"]
        kinds = ("double", "float", "integer", "long", "short", "byte", "decimal")
        self.features = list(features) if features else [
            f.name for f in train.schema if f.name not in (target, date_column) and f.dataType.typeName() in kinds
        ]
        ordered = train.select(
            col(date_column).cast("date").alias("__d"), F.coalesce(number(col(target)), F.lit(0.0)).alias("__y"),
            *(number(col(f)).alias(f) for f in self.features),
        ).orderBy("__d").collect()
        self.history, self.last_row = [r["__y"] for r in ordered], ordered[-1].asDict()
        self.dates = [r["__d"] for r in ordered]
        kind = c("forecasting.model_type", "xgboost")
        self.kind = kind
        if kind in _SERIES:
            self.model = None
        elif kind == "ensemble":
            self.weight = float((c("forecasting.ensemble", None) or {}).get("weight_a", 0.5))
            pair = [(c("forecasting.ensemble", None) or {}).get(k, d) for k, d in (("model_a", "ridge"), ("model_b", "xgboost"))]
            self.model = _Pair([make_model(k).fit(train, self.features, target) for k in pair], self.weight)
        else:
            params = self.adaptive_params(rows) if kind == "xgboost" else dict(c(f"forecasting.{kind}", None) or {})
            self.model = make_model(kind, **params).fit(train, self.features, target)
        return self

    def predict(self, periods: int | None = None, future: DataFrame | None = None) -> DataFrame:
        """(date, prediction) of the months after the training rows, or of the rows of ``future``.

        Features that ``future`` doesn't have keep their last value of the training rows.
        """
        if future is not None and self.model is not None:
            rows = date_features(future, self.date, self.origin)
            rows = rows.withColumns({f: F.lit(float(self.last_row.get(f) or 0.0)) for f in self.features if f not in rows.columns})
            return self._back(self.model.predict(rows, self.features).select(col(self.date).cast("date").alias("date"), "prediction"))
        n = int(self.config.get("forecasting.forecast_horizon", 12)) if periods is None else periods
        spark = self.parts["train"].sparkSession
        if self.kind in _SERIES:
            return self._back(
                _SERIES[self.kind](
                    self.parts["train"], self.date, self.target, n,
                    **(self.config.get(f"forecasting.{self.kind}", None) or {}),
                )
            )
        history, out = list(self.history), []
        for when in months_after(months_after(self.train_end, 2)[1], n):
            y = self.model.predict_one(
                [future_value(f, self.target, self.date, when, history, self.origin, self.last_row) for f in self.features]
            )
            history.append(y)
            out.append((when, y))
        return self._back(spark.createDataFrame(out, "date date, prediction double"))

    def _back(self, df: DataFrame) -> DataFrame:
        """Out of logs: the prediction, and its bounds where there are any."""
        return df.withColumns({c: self.log.invert(F.col(c)) for c in df.columns if c.startswith("prediction")}) if self.log else df

    def release(self) -> None:
        """Give back what fit() keeps in memory; predictions still work, and are computed anew."""
        if self.cached is not None:
            self.cached.unpersist()

    def predict_on_df(self, df: DataFrame) -> DataFrame:
        """(date, actual, prediction) of the rows of ``df``; forecasts of whole series are matched by month.

        Rows that lack features go through the fitted pipeline; what it doesn't make keeps its last value of the training rows.
        """
        if self.kind in _SERIES:
            last = df.agg(F.max(col(self.date).cast("date"))).first()[0]
            n = (last.year - self.train_end.year) * 12 + last.month - self.train_end.month if last else 0
            ahead = self.predict(max(n, 1))
            actual = df.select(F.trunc(col(self.date).cast("date"), "MM").alias("date"), number(col(self.target)).alias("actual"))
            return self._actual(actual.join(ahead, "date"))
        if self.pipeline is not None and any(f not in df.columns for f in self.features):
            df = self.pipeline.transform(df)
        df = date_features(df, self.date, self.origin)
        df = df.withColumns({f: F.lit(float(self.last_row.get(f) or 0.0)) for f in self.features if f not in df.columns})
        found = self.model.predict(df, self.features).select(
            col(self.date).cast("date").alias("date"), number(col(self.target)).alias("actual"), "prediction",
        )
        return self._actual(self._back(found))

    def _actual(self, df: DataFrame) -> DataFrame:
        return df.withColumn("actual", self.log.invert(F.col("actual"))) if self.log else df

    def evaluate(self, part: str = "test") -> DataFrame:
        """One row of metrics of the part's rows; horizon errors are kept in ``horizon_rows``."""
        rows = self.predict_on_df(self.parts[part])
        self.horizon_rows = horizon_errors(rows, "date", "actual", "prediction")
        return accuracy(rows, "actual", "prediction", "date")

    def feature_importance(self) -> dict[str, float]:
        found = self.model.importances() if self.model else None
        return dict(zip(self.features, found, strict=True)) if found else {}

    def save(self, path: str, spark: SparkSession) -> None:
        """All that predict() needs: model, series, features, fitted pipeline, origin and transform."""
        meta = {
            "dates": list(map(str, self.dates)), "pipeline": self.pipeline is not None,
            "kind": self.kind, "target": self.target, "date": self.date, "features": self.features,
            "history": self.history, "origin": str(self.origin), "train_end": str(self.train_end),
            "last_row": self.last_row, "log": asdict(self.log) if self.log else None, "split": self.split_meta,
        }
        if self.pipeline is not None:
            self.pipeline.save(f"{path}/pipeline", spark)
        models = self.model.models if isinstance(self.model, _Pair) else [self.model]
        for i, m in enumerate(models):
            save_model(
                m, f"{path}/{i}", spark,
                json.loads(json.dumps(meta | {"models": len(models), "weight": getattr(self, "weight", None)}, default=str)),
            )

    @classmethod
    def load(cls, path: str, spark: SparkSession, config: Any) -> TimeSeriesForecaster:
        first, meta = load_model(f"{path}/0", spark)
        self = cls(config)
        self.kind, self.target, self.date, self.features, self.history = (
            meta[k] for k in ("kind", "target", "date", "features", "history")
        )
        self.origin, self.train_end, self.last_row, self.split_meta = date.fromisoformat(meta["origin"]), date.fromisoformat(meta["train_end"]), meta["last_row"], meta["split"]
        self.log = LogTransform(**meta["log"]) if meta["log"] else None
        self.model = _Pair(
            [first, *(load_model(f"{path}/{i}", spark)[0] for i in range(1, meta["models"]))], meta["weight"],
        ) if meta["models"] > 1 else first
        self.dates = list(map(date.fromisoformat, meta["dates"]))
        self.pipeline = FeaturePipeline.load(f"{path}/pipeline", spark) if meta["pipeline"] else None
        self.parts = {
            "train": spark.createDataFrame(
                list(zip(self.dates, map(float, self.history), strict=True)),
                f"`{self.date}` date, `{self.target}` double",
            )
        }
        return self


#: Models of a whole series: (series, date column, target, months) to date and prediction, with bounds or without.
_SERIES = {"holt_winters": holt_winters_forecast, "prophet": prophet_forecast}


class _Pair(Regressor):
    """Weighted mean of two fitted models."""

    def __init__(self, models: Sequence[Regressor], weight: float) -> None:
        super().__init__(weight=weight)
        self.models, self.weights = list(models), (weight, 1 - weight)

    def predict(self, df: DataFrame, features: Sequence[str]) -> DataFrame:
        for i, m in enumerate(self.models):
            df = m.predict(df, features).withColumnRenamed("prediction", f"__p{i}")
        return df.withColumn("prediction", F.col("__p0") * self.weights[0] + F.col("__p1") * self.weights[1]).drop("__p0", "__p1")

    def predict_one(self, values: Sequence[float]) -> float:
        return sum(w * m.predict_one(values) for w, m in zip(self.weights, self.models, strict=True))
