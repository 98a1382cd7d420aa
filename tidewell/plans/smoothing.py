"""Holt-Winters smoothing and a trend with Fourier terms. A series is months long: a task smooths whole batches of them.

Smoothing weights (level, trend, season, damping) minimise the squared one-step error within ``BOUNDS``, all four of them:
from the best points of a coarse grid each segment's weights move to the best of their neighbours, in steps that halve,
and then along the way they came. All segments of a batch and all neighbours are smoothed side by side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import product
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StructField, StructType

from tidewell.functions.numbers import number
from tidewell.operators.features import Names, col, names
from tidewell.ship import ship

#: Least and largest weights of level, trend and season, and the damping's.
BOUNDS = np.array([[1e-4, 0.9999]] * 3 + [[0.8, 0.998]])
STARTS = 4  # points of the coarse grid from which each series is searched
CHUNK = 64


def smooth(
    y: np.ndarray, w: np.ndarray, periods: int, trend: str | None, seasonal: str | None, season: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Squared error and forecast of each series (one a row) with its own weights (level, trend, season, damping)."""
    m = season if seasonal else 1
    a, b, g, phi = w.T
    n = y.shape[1]
    level = y[:, :m].mean(axis=1)
    if trend == "add":
        slope = (y[:, m : 2 * m].mean(axis=1) - level) / m if n >= 2 * m else (y[:, min(m, n - 1)] - y[:, 0]) / max(m, 1)
    else:
        slope = (y[:, m : 2 * m].mean(axis=1) / level) ** (1 / m) if trend else np.zeros(len(y))
    s = [y[:, i] - level if seasonal == "add" else y[:, i] / level if seasonal else np.zeros(len(y)) for i in range(m)]
    grow = lambda k: level if not trend else level + slope * k if trend == "add" else level * slope**k
    put = lambda v, x: v + x if seasonal == "add" else v * x if seasonal else v
    sse = np.zeros(len(y))
    with np.errstate(all="ignore"):
        for t in range(n):
            v, own = y[:, t], s[t % m]
            base, last = grow(phi), level
            sse += (v - put(base, own)) ** 2
            level = a * (v - own if seasonal == "add" else v / own if seasonal else v) + (1 - a) * base
            if trend == "add":
                slope = b * (level - last) + (1 - b) * phi * slope
            elif trend:
                slope = b * (level / last) + (1 - b) * slope**phi
            if seasonal:
                s[t % m] = g * (v - level if seasonal == "add" else v / level) + (1 - g) * own
        ahead = np.cumsum(phi[:, None] ** np.arange(1, periods + 1), axis=1)
        out = [put(grow(ahead[:, i]), s[(n + i) % m]) for i in range(periods)]
    return np.where(np.isfinite(sse), sse, np.inf), np.array(out).T.reshape(len(y), periods)


def _parts(y: np.ndarray, trend: str | None, seasonal: str | None, season: int) -> str | None:
    """The season that is used: none with fewer than two cycles. At least four values; multiplicative parts need positive ones."""
    if y.shape[1] < 4:
        raise ValueError("Holt-Winters needs at least 4 values")
    for name, part in (("trend", trend), ("seasonal", seasonal)):
        if part not in (None, "add", "mul"):
            raise ValueError(f'{name} is "add", "mul" or None, not {part!r}')
    seasonal = seasonal if y.shape[1] >= 2 * season else None
    if "mul" in (trend, seasonal) and (y <= 0).any():
        raise ValueError("multiplicative Holt-Winters needs values above 0")
    return seasonal


def _best(y: np.ndarray, grid: np.ndarray, *how: Any) -> tuple[np.ndarray, np.ndarray]:
    """SSE of each series with each row of ``grid``; (series, row)."""
    k = len(grid)
    sse = smooth(np.repeat(y, k, axis=0), np.tile(grid, (len(y), 1)), 0, *how)[0]
    return sse.reshape(len(y), k), grid


def search(
    y: np.ndarray, trend: str | None = "add", seasonal: str | None = "add", season: int = 12, damped: bool = False,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and SSE of each series (one a row) that no neighbour at a distance of 0.0002 improves."""
    seasonal = _parts(y, trend, seasonal, season)
    how = (trend, seasonal, season)
    free = np.array([True, bool(trend), bool(seasonal), damped and bool(trend)])
    coarse = [(0.02, 0.1, 0.3, 0.5, 0.7, 0.9)] + [(0.01, 0.1, 0.3, 0.6, 0.9) if f else (0.0,) for f in free[1:3]]
    grid = np.array(list(product(*coarse, (0.8, 0.87, 0.93, 0.98) if free[3] else (1.0,))))
    sse, _ = _best(y, grid, *how)
    s, k = len(y), min(STARTS, len(grid))
    first = np.argsort(sse, axis=1, kind="stable")[:, :k]
    best, score = grid[first].reshape(s * k, 4), np.take_along_axis(sse, first, 1).ravel()
    low, high = np.where(free, BOUNDS[:, 0], best[0] * ~free), np.where(free, BOUNDS[:, 1], best[0] * ~free)
    own = np.repeat(y, k, axis=0)
    moves = np.array([d * np.eye(4)[i] for i in np.flatnonzero(free) for d in (1, -1)])
    step, came = np.full(s * k, 0.1), np.zeros((s * k, 4))
    for _ in range(400):
        going = np.flatnonzero(step >= 0.0002)
        if not len(going):
            break
        b = best[going]
        tried = np.concatenate([b[:, None] + moves * step[going, None, None], (b + came[going])[:, None]], axis=1).clip(low, high)
        c = tried.shape[1]
        found = smooth(np.repeat(own[going], c, axis=0), tried.reshape(-1, 4), 0, *how)[0].reshape(-1, c)
        at = found.argmin(axis=1)
        rows = np.arange(len(going))
        better = found[rows, at] < score[going]
        came[going] = np.where(better[:, None], tried[rows, at] - b, 0.0)
        best[going], score[going] = np.where(better[:, None], tried[rows, at], b), np.where(better, found[rows, at], score[going])
        step[going] = np.where(better, step[going], step[going] / 2)
    pick = score.reshape(s, k).argmin(axis=1)
    return best.reshape(s, k, 4)[np.arange(s), pick], score.reshape(s, k).min(axis=1)


def holt_winters(
    y: np.ndarray, periods: int, trend: str | None = "add", seasonal: str | None = "add", season: int = 12,
    damped: bool = False, weights: Sequence[float] | None = None,
) -> np.ndarray:
    """Forecast of the ``periods`` after one series, or after several, one a row. ``weights`` (level, trend, season, damping)
    are found by ``search`` unless they are given."""
    rows = np.atleast_2d(np.asarray(y, float))
    if weights is None:
        w, _ = search(rows, trend, seasonal, season, damped)
    else:
        w = np.tile(np.asarray(weights, float), (len(rows), 1))
    out = smooth(rows, w, periods, trend, _parts(rows, trend, seasonal, season), season)[1]
    return out[0] if np.ndim(y) == 1 else out


def _series(df: DataFrame, date_column: str, target: str, group_by: Names) -> DataFrame:
    """One row for each segment: its keys ``__g0``.. and its months in order."""
    ship(df.sparkSession)
    point = F.struct(col(date_column).cast("date").alias("d"), F.coalesce(number(col(target)), F.lit(0.0)).alias("y"))
    keys = [col(g).alias(f"__g{i}") for i, g in enumerate(names(group_by))]
    series = df.groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("p")).filter(F.size("p") > 0)
    return series.select(*(k for k in series.columns if k != "p"), F.element_at("p", -1)["d"].alias("last"), F.transform("p", lambda x: x["y"]).alias("y"))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of a batch whose series have one length, as (rows, values)."""
    lengths = np.array([len(x) for x in batch.column("y")])
    for n in np.unique(lengths):
        own = np.flatnonzero(lengths == n)
        for at in range(0, len(own), CHUNK):
            part = batch.take(pa.array(own[at : at + CHUNK]))
            yield part, part.column("y").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, n)


def holt_winters_forecast(df: DataFrame, date_column: str, target: str, periods: int, group_by: Names = None, **options: Any) -> DataFrame:
    """[group,] date and prediction of the ``periods`` months after each group's last date. Options: those of
    ``holt_winters``; ``seasonal_periods`` and ``damped_trend`` are other names for ``season`` and ``damped``."""
    how = {{"seasonal_periods": "season", "damped_trend": "damped"}.get(k, k): v for k, v in options.items()}
    groups = names(group_by)
    fields = [df.schema[g] for g in groups] + [StructField("date", DateType()), StructField("prediction", DoubleType())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, y in _by_length(batch):
                months = part.column("last").to_numpy(zero_copy_only=False).astype("datetime64[M]")[:, None] + np.arange(1, periods + 1)
                owner = pa.array(np.repeat(np.arange(part.num_rows), periods))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(f"__g{i}").take(owner) for i in range(len(groups))), pa.array(months.astype("datetime64[D]").ravel(), pa.date32()),
                        pa.array(holt_winters(y, periods, **how).ravel()),
                    ],
                    [f.name for f in fields],
                )

    return _series(df, date_column, target, groups).mapInArrow(work, StructType(fields))


def holt_winters_weights(
    df: DataFrame, date_column: str, target: str, group_by: Names = None, grid: Sequence[Sequence[float]] | None = None, **options: Any,
) -> DataFrame:
    """[group,] level, trend, season, damping and sse of each group's best weights: by ``search``, or those of ``grid``."""
    groups = names(group_by)
    columns = ["level", "trend", "season", "damping", "sse"]
    fields = [df.schema[g] for g in groups] + [StructField(c, DoubleType()) for c in columns]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, y in _by_length(batch):
                if grid is None:
                    w, sse = search(y, **options)
                else:
                    trend, season = options.get("trend", "add"), options.get("season", 12)
                    tried, points = _best(y, np.array(grid, float), trend, _parts(y, trend, options.get("seasonal", "add"), season), season)
                    w, sse = points[tried.argmin(axis=1)], tried.min(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f"__g{i}") for i in range(len(groups))), *(pa.array(w[:, i]) for i in range(4)), pa.array(sse)], [f.name for f in fields],
                )

    return _series(df, date_column, target, groups).mapInArrow(work, StructType(fields))


def trend_fourier_forecast(
    df: DataFrame, date_column: str, target: str, periods: int, order: int = 3, z: float = 1.2816,
    group_by: Names = None, regressors: Sequence[str] = (),
) -> DataFrame:
    """[group,] date, prediction, prediction_lower and prediction_upper of the months after each group's last date.

    A linear trend, ``order`` yearly Fourier terms and any ``regressors`` (numeric columns, null is 0; in months to come
    they keep their last value) by least squares, the shortest solution if there are several; rows without a target are
    left out. The bounds are ``z`` residual deviations away (80 per cent as it stands). It is a model of its own, not
    another library's.
    """
    groups = names(group_by)
    given = [f"__r{i}" for i in range(len(regressors))]

    def forecast(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        dates = pd.to_datetime(pdf["date"])
        ahead = pd.date_range(dates.iloc[-1] + pd.offsets.MonthBegin(1), periods=periods, freq="MS")

        def design(when: pd.Series | pd.DatetimeIndex, extra: np.ndarray) -> np.ndarray:
            year = np.asarray((when - dates.iloc[0]) / pd.Timedelta(days=365.25), float)
            waves = [f(2 * np.pi * k * year) for k in range(1, order + 1) for f in (np.sin, np.cos)]
            return np.column_stack([np.ones(len(year)), year, *waves, extra])

        known = pdf["y"].notna().to_numpy()
        x, y = design(dates, pdf[given].to_numpy(float)), pdf["y"].to_numpy(float)
        w = np.linalg.lstsq(x[known], y[known], rcond=None)[0]
        left = y[known] - x[known] @ w
        reach = z * (left.std(ddof=1) if len(left) > 1 else 0.0)
        mean = design(ahead, np.tile(pdf[given].to_numpy(float)[-1], (periods, 1))) @ w
        out = pd.DataFrame({"date": ahead.date, "prediction": mean, "prediction_lower": mean - reach, "prediction_upper": mean + reach})
        for g in groups:
            out[g] = pdf[g].iloc[0]
        return out[[*groups, "date", "prediction", "prediction_lower", "prediction_upper"]]

    extra = [F.coalesce(col(r).cast("double"), F.lit(0.0)).alias(g) for r, g in zip(regressors, given, strict=True)]
    narrow = df.select(*map(col, groups), col(date_column).cast("date").alias("date"), col(target).cast("double").alias("y"), *extra)
    if not groups:
        narrow = narrow.withColumn("__all", F.lit(1))
    schema = ", ".join(
        [
            *(f"`{g}` {narrow.schema[g].dataType.simpleString()}" for g in groups),
            "date date, prediction double, prediction_lower double, prediction_upper double",
        ]
    )
    return narrow.groupBy(*map(col, groups or ["__all"])).applyInPandas(forecast, schema)
