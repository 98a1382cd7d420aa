"""Regression models behind one interface, and their registry. Fitting is Spark ML; single rows are predicted on the driver."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from typing import Any

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.numbers import number
from tidewell.operators.features import col


class Regressor:
    """fit(df, features, target), predict(df, features) adds ``prediction``, predict_one(values) is one number."""

    def __init__(self, **params: Any) -> None:
        self.params = params

    def fit(self, df: DataFrame, features: Sequence[str], target: str) -> Regressor:
        raise NotImplementedError

    def predict(self, df: DataFrame, features: Sequence[str]) -> DataFrame:
        raise NotImplementedError

    def predict_one(self, values: Sequence[float]) -> float:
        raise NotImplementedError

    def importances(self) -> list[float] | None:
        return None

    def state(self) -> dict[str, Any]:
        raise NotImplementedError

    def restore(self, state: dict[str, Any]) -> Regressor:
        raise NotImplementedError


def assembled(df: DataFrame, features: Sequence[str], target: str | None = None) -> DataFrame:
    """Numbers without nulls (null is 0) and their vector ``__x``."""
    ready = df.withColumns({f"__f{i}": F.coalesce(number(col(c)), F.lit(0.0)) for i, c in enumerate(features)})
    if target:
        ready = ready.withColumn("__y", F.coalesce(number(col(target)), F.lit(0.0)))
    return VectorAssembler(inputCols=[f"__f{i}" for i in range(len(features))], outputCol="__x").transform(ready)


class Linear(Regressor):
    """Least squares with an optional penalty: none, ridge ``alpha``, or l1 share ``l1_ratio`` of ``alpha``.

    The penalties are those of the common formulation (ridge: squared error plus alpha |w|^2; lasso: squared error over
    2n plus alpha |w|): Spark scales its penalty by the target's population deviation, so that is taken out.
    """

    def __init__(self, kind: str = "linear", **params: Any) -> None:
        super().__init__(**params)
        self.kind = kind

    def fit(self, df: DataFrame, features: Sequence[str], target: str) -> Linear:
        ready = assembled(df, features, target).select("__x", "__y")
        n, s = ready.agg(F.count(F.lit(1)), F.stddev_pop("__y")).first()
        alpha, ratio = float(self.params.get("alpha", 1.0)), float(self.params.get("l1_ratio", 0.5))
        s = s or 1.0
        if self.kind == "linear":
            reg, net = 0.0, 0.0
        elif self.kind == "ridge":
            reg, net = alpha * s / n, 0.0
        else:
            l1 = alpha * (1.0 if self.kind == "lasso" else ratio)
            l2 = 0.0 if self.kind == "lasso" else alpha * (1 - ratio) * s
            reg, net = l1 + l2, l1 / (l1 + l2) if l1 + l2 else 0.0
        fitted = LinearRegression(
            featuresCol="__x", labelCol="__y", predictionCol="prediction", regParam=reg, elasticNetParam=net,
            standardization=False, solver="normal", maxIter=int(self.params.get("max_iter", 1000)), tol=1e-10,
        ).fit(ready)
        self.coefficients, self.intercept = [float(x) for x in fitted.coefficients], float(fitted.intercept)
        return self

    def predict(self, df: DataFrame, features: Sequence[str]) -> DataFrame:
        total = F.lit(self.intercept)
        for c, w in zip(features, self.coefficients, strict=True):
            total = total + F.coalesce(number(col(c)), F.lit(0.0)) * w
        return df.withColumn("prediction", total)

    def predict_one(self, values: Sequence[float]) -> float:
        return self.intercept + math.fsum(w * x for w, x in zip(self.coefficients, values, strict=True))

    def importances(self) -> list[float]:
        return [abs(w) for w in self.coefficients]

    def state(self) -> dict[str, Any]:
        return {"coefficients": self.coefficients, "intercept": self.intercept}

    def restore(self, state: dict[str, Any]) -> Linear:
        self.coefficients, self.intercept = state["coefficients"], state["intercept"]
        return self


class BayesianRidge(Linear):
    """Ridge whose penalty follows from the evidence: the Gram matrix is one aggregation, the iteration is on the driver."""

    def __init__(self, **params: Any) -> None:
        super().__init__("bayesian_ridge", **params)

    def fit(self, df: DataFrame, features: Sequence[str], target: str) -> BayesianRidge:
        names = [f"__f{i}" for i in range(len(features))] + ["__y"]
        ready = df.select(*(F.coalesce(number(col(c)), F.lit(0.0)).alias(a) for c, a in zip([*features, target], names, strict=True)))
        pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
        row = ready.agg(
            F.count(F.lit(1)), *(F.sum(a) for a in names),
            *(F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs),
        ).first()
        n, mean = row[0], np.array(row[1 : len(names) + 1], float) / max(row[0], 1)
        gram = np.zeros((len(names), len(names)))
        for (i, j), v in zip(pairs, row[len(names) + 1 :], strict=True):
            gram[i, j] = gram[j, i] = v - n * mean[i] * mean[j]
        xx, xy, yy = gram[:-1, :-1], gram[:-1, -1], gram[-1, -1]
        values, vectors = np.linalg.eigh(xx)
        values, rotated = np.maximum(values, 0), vectors.T @ xy
        noise, weight, w = 1.0 / max(yy / max(n, 1), 1e-12), 1.0, np.zeros(len(features))
        for _ in range(int(self.params.get("max_iter", 300))):
            new = vectors @ (rotated / (values + weight / noise))
            gamma = float(np.sum(noise * values / (weight + noise * values)))
            error = max(float(yy - 2 * new @ xy + new @ xx @ new), 1e-12)
            weight, noise = (gamma + 2e-6) / (float(new @ new) + 2e-6), (n - gamma + 2e-6) / (error + 2e-6)
            done, w = float(np.abs(new - w).sum()) < 1e-3, new
            if done:
                break
        self.coefficients, self.intercept = [float(x) for x in w], float(mean[-1] - mean[:-1] @ w)
        return self


class Trees(Regressor):
    """Forests and boosted trees of Spark ML; the common names of their parameters are understood."""

    NAMES = {
        "n_estimators": ("numTrees", "maxIter"), "max_depth": ("maxDepth",) * 2, "learning_rate": (None, "stepSize"),
        "subsample": ("subsamplingRate",) * 2, "random_state": ("seed",) * 2,
        "min_child_weight": ("minInstancesPerNode",) * 2, "iterations": (None, "maxIter"), "depth": ("maxDepth",) * 2,
        "random_seed": ("seed",) * 2, "min_child_samples": ("minInstancesPerNode",) * 2, "max_bins": ("maxBins",) * 2,
        "bootstrap": ("bootstrap", None), "min_samples_leaf": ("minInstancesPerNode",) * 2,
    }

    def __init__(self, kind: str = "gbt", **params: Any) -> None:
        super().__init__(**params)
        self.kind = kind

    def fit(self, df: DataFrame, features: Sequence[str], target: str) -> Trees:
        i = int(self.kind != "random_forest")
        unknown = [k for k in self.params if k not in self.NAMES or not self.NAMES[k][i]]
        if unknown or int(self.params.get("max_depth") or self.params.get("depth") or 0) > 30:
            raise ValueError(f"{self.kind}: unknown parameters {unknown}, or deeper than 30 levels; there are {', '.join(k for k, v in self.NAMES.items() if v[i])}")
        options = {self.NAMES[k][i]: v for k, v in self.params.items() if k in self.NAMES and self.NAMES[k][i]}
        kinds = {"stepSize": float, "subsamplingRate": float, "bootstrap": bool}
        options = {"seed": 42} | {k: kinds.get(k, int)(v) for k, v in options.items() if v is not None}
        make = GBTRegressor if i else RandomForestRegressor
        self.model = make(
            featuresCol="__x", labelCol="__y", predictionCol="prediction", **options,
        ).fit(assembled(df, features, target).select("__x", "__y"))
        return self

    def predict(self, df: DataFrame, features: Sequence[str]) -> DataFrame:
        return self.model.transform(assembled(df, features)).drop("__x", *(f"__f{i}" for i in range(len(features))))

    def predict_one(self, values: Sequence[float]) -> float:
        return float(self.model.predict(Vectors.dense([float(x) for x in values])))

    def importances(self) -> list[float]:
        return [float(x) for x in self.model.featureImportances.toArray()]


_REGISTRY: dict[str, tuple[Callable[..., Regressor], bool]] = {}


def register_model(name: str, factory: Callable[..., Regressor], available: bool = True) -> None:
    _REGISTRY[name] = (factory, available)


def available_models() -> list[str]:
    return sorted(n for n, (_, ok) in _REGISTRY.items() if ok)


def make_model(name: str, **params: Any) -> Regressor:
    if name not in _REGISTRY or not _REGISTRY[name][1]:
        raise ValueError(f"there is no model {name!r} here, but there are: {', '.join(available_models())}")
    return _REGISTRY[name][0](**params)


for _name in ("linear", "ridge", "lasso", "elastic_net"):
    register_model(_name, lambda _kind=_name, **kw: Linear(_kind, **kw))
register_model("bayesian_ridge", BayesianRidge)
register_model("random_forest", lambda **kw: Trees("random_forest", **kw))
register_model("gbt", lambda **kw: Trees("gbt", **kw))


def _boosted(name: str) -> Callable[..., Regressor]:
    def make(**params: Any) -> Regressor:
        from tidewell.plans import boosting

        return getattr(boosting, name)(**params)

    return make


for _name, _class in (("xgboost", "XGBoost"), ("lightgbm", "LightGBM"), ("catboost", "CatBoost")):
    register_model(_name, _boosted(_class))


def save_model(model: Regressor | None, path: str, spark: SparkSession, meta: dict[str, Any]) -> None:
    """The model and its metadata as JSON, and trees as a Spark ML model beside it."""
    kind = {"class": type(model).__name__, "kind": getattr(model, "kind", ""), "params": getattr(model, "params", {})}
    if model is None:
        kind["params"] = {}
    elif isinstance(model, Trees):
        model.model.write().overwrite().save(f"{path}/trees")
    else:
        kind["state"] = model.state()
    spark.createDataFrame(
        [(json.dumps(kind | {"meta": meta}, default=str),)], "value string",
    ).coalesce(1).write.mode("overwrite").text(f"{path}/model")


def load_model(path: str, spark: SparkSession) -> tuple[Regressor | None, dict[str, Any]]:
    kind = json.loads(spark.read.text(f"{path}/model").first().value)
    if kind["class"] == "NoneType":
        return None, kind["meta"]
    if kind["class"] == "Trees":
        model: Regressor = Trees(kind["kind"], **kind["params"])
        model.model = (RandomForestRegressionModel if kind["kind"] == "random_forest" else GBTRegressionModel).load(f"{path}/trees")
    elif kind["class"] in ("XGBoost", "LightGBM", "CatBoost"):
        model = _boosted(kind["class"])(**kind["params"]).restore(kind["state"])
    else:
        model = (
            BayesianRidge(**kind["params"]) if kind["class"] == "BayesianRidge" else Linear(kind["kind"], **kind["params"])
        ).restore(kind["state"])
    return model, kind["meta"]


__all__ = ["BayesianRidge", "Linear", "Regressor", "Trees", "available_models", "load_model", "make_model", "register_model", "save_model"]
