"""A trend that may bend, with yearly terms and regressors: the additive model that is asked for as ``prophet``.

y / max|y| = m + k t + sum of d_j (t - s_j)+ + Fourier terms + regressors + noise, with t from 0 to 1 over the history. The
changepoints s_j lie evenly among the first ``changepoint_range`` of the rows. Their bends d_j have a Laplace prior of
scale ``changepoint_prior_scale``, Fourier and regressor weights a normal one of ``seasonality_prior_scale``; level and
slope are free. For a given noise the most probable bends follow from the Gram matrix, in which the other columns are
eliminated first, by a search over the signs of the bends that ends at the exact solution; noise and bends are found in turn. Bounds come from seeded simulations of trends to
come, with bends as often and as large as those of the history, and of the noise. The most probable bends are mostly zero
and so too small to say how large bends are: their variance is estimated by expectation and maximisation instead.

A series is months long: each segment is one row with its months in an array, and a task works on whole Arrow batches of
segments. Simulations are seeded by the segment, so they don't depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StructField, StructType

from tidewell.functions.numbers import number
from tidewell.operators.features import Names, col, names
from tidewell.ship import ship

CHUNK = 256  # segments whose matrices are held at once


def changepoints(rows: int, n: int, share: float) -> np.ndarray:
    """Places (from 0) of the rows where the trend may bend."""
    reach = int(rows * share)
    n = max(0, min(n, reach - 1))
    return np.round(np.linspace(0, reach - 1, n + 1)).astype(int)[1:] if n else np.zeros(0, int)


def fourier(days: np.ndarray, yearly: int, weekly: int) -> np.ndarray:
    """Terms of the day number, last axis: sines and cosines of each order."""
    terms = [f(2 * np.pi * k * days / period) for period, order in ((365.25, yearly), (7.0, weekly)) for k in range(1, order + 1) for f in (np.sin, np.cos)]
    return np.stack(terms, -1) if terms else np.zeros((*days.shape, 0))


def _bend(gram: np.ndarray, moment: np.ndarray, penalty: float, d: np.ndarray) -> np.ndarray:
    """One segment's bends, from a start: those that are not zero are solved for with their signs held; where one would change
    its sign the best point on the way is taken, and a zero one joins while its slope is above the penalty."""
    d, sign = d.copy(), np.sign(d)
    ridge = 1e-13 * max(float(np.trace(gram)), 1e-300)
    value = lambda x: 0.5 * x @ gram @ x - moment @ x + penalty * np.abs(x).sum()
    near = 1e-6 * penalty + 1e-12 * float(np.abs(moment).max(initial=0.0))
    settled = False
    for _ in range(40 * len(d) + 40):
        slope = gram @ d - moment
        on = sign != 0
        settled = settled or not on.any() or np.abs(slope[on] + penalty * sign[on]).max() <= near
        if settled:
            idle = np.where(on, 0.0, np.abs(slope))
            i = int(idle.argmax())
            if idle[i] <= penalty + near or gram[i, i] <= 1e-14:
                break
            sign[i] = -np.sign(slope[i])
            on[i] = True
        at = np.flatnonzero(on)
        target = d.copy()
        target[at] = np.linalg.solve(gram[np.ix_(at, at)] + ridge * np.eye(len(at)), moment[at] - penalty * sign[at])
        move = target - d
        cross = at[(np.sign(target[at]) != sign[at]) & (d[at] != 0)]
        points = [target]
        for share in -d[cross] / move[cross]:
            x = d + share * move
            x[cross[np.isclose(-d[cross] / move[cross], share)]] = 0.0
            points.append(x)
        best = min(points, key=value)
        if value(best) >= value(d):  # no nearer than rounding allows: done with these signs, or with all
            if settled:
                break
            settled = True
            continue
        d, settled = best, False
        sign = np.where(np.abs(d) > 1e-15, np.sign(d), 0.0)
        d[sign == 0] = 0.0
    return d


def bends(gram: np.ndarray, moment: np.ndarray, penalty: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each segment the d that minimises d'Gd/2 - c'd + penalty |d|."""
    if not start.size:
        return start
    return np.array([_bend(*x) for x in zip(gram, moment, penalty, start, strict=True)])


def bend_size(gram: np.ndarray, moment: np.ndarray, noise: np.ndarray, used: np.ndarray, start: float) -> np.ndarray:
    """For each segment the Laplace scale whose variance (2 scale²) makes the data most likely, bends taken as normal."""
    values, vectors = np.linalg.eigh(gram)
    along = np.einsum("sij,si->sj", vectors, moment)
    n = np.maximum(used.sum(axis=1), 1)
    share = np.einsum("sij,si->sj", vectors**2, used.astype(float))  # how much of a direction lies in bends that there are
    variance = np.full(len(gram), 2 * start**2)
    for _ in range(100):
        precision = np.maximum(values, 0) / noise[:, None] + 1 / variance[:, None]
        mean = along / noise[:, None] / precision
        new = np.maximum(((mean**2 + 1 / precision) * share).sum(axis=1) / n, 1e-12)
        if (np.abs(new - variance) <= 1e-6 * variance).all():
            break
        variance = new
    return np.sqrt(variance / 2) * used.any(axis=1)


class Trend:
    """The fitted models of a batch of segments: arrays with the segment first. ``known`` marks rows with a target."""

    def __init__(
        self, days: np.ndarray, y: np.ndarray, known: np.ndarray, extra: np.ndarray, counts: np.ndarray, *, growth: str, yearly: int,
        weekly: int, n_changepoints: int, changepoint_range: float, prior: float, season_prior: float, penalty: float | None,
    ) -> None:
        s, t_max = y.shape
        last = days[np.arange(s), np.maximum(counts - 1, 0)]
        self.start, self.span = days[:, :1], np.maximum(last - days[:, 0], 1.0)[:, None]
        self.scale = np.abs(np.where(known, y, 0)).max(axis=1, keepdims=True)
        self.scale[self.scale == 0] = 1.0
        self.growth, self.yearly, self.weekly, self.rate = growth, yearly, weekly, n_changepoints
        at = [changepoints(int(n), n_changepoints if growth == "linear" else 0, changepoint_range) for n in known.sum(axis=1)]
        self.s = np.full((s, max(map(len, at), default=0)), np.inf)
        t = (days - self.start) / self.span
        for i, places in enumerate(at):
            self.s[i, : len(places)] = t[i][known[i]][places]
        self.mean = np.where(known[..., None], extra, 0).sum(1) / np.maximum(known.sum(1), 1)[:, None]
        spread = np.where(known[..., None], (extra - self.mean[:, None]) ** 2, 0).sum(1) / np.maximum(known.sum(1), 1)[:, None]
        self.spread = np.where(spread > 0, np.sqrt(spread), 1.0)
        u, h = self.columns(days, extra)
        u, h, z = (np.where(known.reshape(s, t_max, *[1] * (a.ndim - 2)), a, 0) for a in (u, h, y / self.scale))
        n = np.maximum(known.sum(axis=1), 1)
        gram = lambda a, b: np.einsum("sti,stj->sij", a, b)
        uu, uh, hh = gram(u, u), gram(u, h), gram(h, h)
        uz, hz = np.einsum("sti,st->si", u, z), np.einsum("sti,st->si", h, z)
        loose = np.full(u.shape[2], 0.0)
        loose[1 + (growth == "linear") :] = 1 / season_prior**2

        def solve(noise: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
            held = uu + np.eye(u.shape[2]) * (1e-10 + loose * noise[:, None])[:, None, :]
            inner = np.linalg.solve(held, np.concatenate([uh, uz[..., None]], axis=2))
            schur = hh - np.einsum("sij,sik->sjk", uh, inner[..., :-1])
            moment = hz - np.einsum("sij,si->sj", uh, inner[..., -1])
            d = bends(schur, moment, penalty * np.ones(s) if penalty is not None else noise / prior, d)
            w = inner[..., -1] - np.einsum("sij,sj->si", inner[..., :-1], d)
            return w, d, z - np.einsum("sti,si->st", u, w) - np.einsum("sti,si->st", h, d), (schur, moment)

        d, noise = np.zeros((s, self.s.shape[1])), np.maximum((z - z.sum(1, keepdims=True) / n[:, None] * known).var(axis=1), 1e-10)
        for _ in range(30):
            w, d, rest, normal = solve(noise, d)
            new = np.maximum((rest**2 * known).sum(axis=1) / n, 1e-10)
            done = bool((np.abs(new - noise) <= 1e-7 * noise).all())
            noise = new
            if done:
                break
        self.w, self.d, self.noise = w, d, noise
        self.size = bend_size(*normal, noise, np.isfinite(self.s), prior)

    def columns(self, days: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns of the level, slope, seasons and regressors; and those of the bends."""
        t = (days - self.start) / self.span
        trend = [np.ones_like(t), t] if self.growth == "linear" else [np.ones_like(t)]
        regressors = (extra - self.mean[:, None]) / self.spread[:, None]
        free = np.concatenate([np.stack(trend, -1), fourier(days, self.yearly, self.weekly), regressors], axis=-1)
        return free, np.where(np.isfinite(self.s)[:, None], np.maximum(t[..., None] - np.where(np.isfinite(self.s), self.s, 0)[:, None], 0), 0)

    def predict(self, days: np.ndarray, extra: np.ndarray, seeds: np.ndarray, width: float, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        free, h = self.columns(days, extra)
        mean = np.einsum("sti,si->st", free, self.w) + np.einsum("sti,si->st", h, self.d)
        t = (days - self.start) / self.span
        low, high = np.empty_like(mean), np.empty_like(mean)
        used = np.isfinite(self.s)
        for i, seed in enumerate(seeds):
            r = np.random.default_rng(int(seed) & (1 << 63) - 1)
            end = max(float(t[i].max(initial=1.0)), 1.0)
            n = r.poisson(used[i].sum() * (end - 1.0), samples)
            owner = np.repeat(np.arange(samples), n)
            where, bend = r.uniform(1.0, end, len(owner)), r.laplace(0.0, self.size[i] + 1e-8, len(owner))
            paths = np.zeros((samples, t.shape[1]))
            np.add.at(paths, owner, bend[:, None] * np.maximum(t[i] - where[:, None], 0))
            paths += r.normal(0.0, np.sqrt(self.noise[i]), paths.shape)
            low[i], high[i] = mean[i] + np.quantile(paths, [(1 - width) / 2, (1 + width) / 2], axis=0)
        return mean * self.scale, low * self.scale, high * self.scale


def prophet_forecast(
    df: DataFrame, date_column: str, target: str, periods: int, group_by: Names = None, growth: str = "linear",
    yearly_seasonality: bool | int = True, weekly_seasonality: bool | int = False, daily_seasonality: bool | int = False,
    additional_regressors: Sequence[str] = (), n_changepoints: int = 25, changepoint_range: float = 0.8, changepoint_prior_scale: float = 0.05,
    seasonality_prior_scale: float = 10.0, interval_width: float = 0.8, uncertainty_samples: int = 1000, seed: int = 42,
    changepoint_penalty: float | None = None,
) -> DataFrame:
    """[group,] date, prediction, prediction_lower and prediction_upper of the months after each group's last date.

    Rows without a target are left out; regressors that the frame lacks are too, null ones are 0, and in months to come they
    keep their last value. ``changepoint_penalty`` sets the weight of |d| itself, whatever the noise.
    """
    if growth not in ("linear", "flat"):
        raise ValueError(f"no growth {growth!r}; there are linear and flat")
    if daily_seasonality:
        raise ValueError("dates have no time of day: no daily seasonality")
    orders = [default if x is True else int(x or 0) for x, default in ((yearly_seasonality, 10), (weekly_seasonality, 3))]
    groups, regressors = names(group_by), [r for r in additional_regressors if r in df.columns]
    ship(df.sparkSession)
    how: dict[str, Any] = {
        "growth": growth, "yearly": orders[0], "weekly": orders[1], "n_changepoints": n_changepoints, "changepoint_range": changepoint_range,
        "prior": changepoint_prior_scale, "season_prior": seasonality_prior_scale, "penalty": changepoint_penalty,
    }
    point = F.struct(
        F.unix_date(col(date_column).cast("date")).alias("d"), number(col(target)).alias("y"),
        F.array(*(F.coalesce(number(col(r)), F.lit(0.0)) for r in regressors)).cast("array<double>").alias("x"),
    )
    keys = [col(g).alias(f"__g{i}") for i, g in enumerate(groups)]
    series = df.filter(col(date_column).cast("date").isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("p"))
    fields = [df.schema[g] for g in groups] + [StructField("date", DateType())] + [StructField(f"prediction{x}", DoubleType()) for x in ("", "_lower", "_upper")]
    seeded = series.withColumn("seed", F.xxhash64(F.lit(seed), *(f"__g{i}" for i in range(len(groups)))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                points = batch.column("p").to_pylist()
                s, counts = len(points), np.array([len(p) for p in points])
                if not counts.max(initial=0):
                    continue
                days, y = np.zeros((s, counts.max())), np.full((s, counts.max()), np.nan)
                extra = np.zeros((s, counts.max(), len(regressors)))
                for i, p in enumerate(points):
                    days[i, : len(p)], y[i, : len(p)] = [x["d"] for x in p], [np.nan if x["y"] is None else x["y"] for x in p]
                    extra[i, : len(p)] = np.array([x["x"] for x in p], float).reshape(len(p), len(regressors))
                model = Trend(days, np.nan_to_num(y), ~np.isnan(y), extra, counts, **how)
                last = days[np.arange(s), counts - 1].astype("datetime64[D]")
                months = last.astype("datetime64[M]")[:, None] + np.arange(1, periods + 1)
                ahead = months.astype("datetime64[D]").astype(float)
                held = np.repeat(extra[np.arange(s), counts - 1][:, None], periods, axis=1)
                found = model.predict(ahead, held, batch.column("seed").to_numpy(), interval_width, uncertainty_samples)
                owner = pa.array(np.repeat(np.arange(s), periods))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(f"__g{i}").take(owner) for i in range(len(groups))), pa.array(months.astype("datetime64[D]").ravel(), pa.date32()),
                        *(pa.array(x.ravel()) for x in found),
                    ],
                    [f.name for f in fields],
                )

    return seeded.mapInArrow(work, StructType(fields))
