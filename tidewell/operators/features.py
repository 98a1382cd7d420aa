"""Feature operators: each adds columns to a frame, and a pipeline folds them into one plan.

Ordered operators take explicit order columns; windows of one partitioning and order share one shuffle and sort. Where a
group (or the whole frame, without groups) has more than ``LONG`` rows, they work over ranges of the order instead, each
with the rows before it that they look back to, so that no task gets a group. Rows with a null group key have null features.
"""

from __future__ import annotations

import json
from abc import ABC, abstractmethod
from copy import copy
from itertools import groupby
from collections.abc import Callable, Sequence
from typing import Any
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from tidewell.functions.dates import calendar, seasonal
from tidewell.functions.numbers import number, ratio
from tidewell.operators.ordered import filled_forward, quantiles, with_halo

Names = str | Sequence[str] | None


LONG = 1_000_000  # rows of a group that one task sorts, at most


def names(keys: Names) -> list[str]:
    return [] if keys is None else [keys] if isinstance(keys, str) else list(keys)


def col(name: str) -> Column:
    return F.col(f"`{name}`")


class Feature(ABC):
    """fit() learns what an operator needs (most need nothing), transform() adds its columns."""

    def __init__(self, name: str | None = None, group_by: Names = None, order_by: Names = None) -> None:
        self.name, self.group_by, self.order_by, self.fitted = name or type(self).__name__, names(group_by), names(order_by), False

    def fit(self, df: DataFrame) -> Feature:
        self.fitted = True
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.fitted:
            raise ValueError(f"{self.name} must be fitted before transform")
        return over_ranges(df, [self]) if self.reach() is not None and is_long(df, self.group_by) else self.add(df)

    def reach(self) -> int | None:
        """How many rows back it looks; None if rows have no order for it."""
        return None

    def filled(self, df: DataFrame) -> dict[str, Column]:
        """Columns that it needs filled forward, whatever the distance."""
        return {}

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    @abstractmethod
    def add(self, df: DataFrame) -> DataFrame: ...

    def window(self) -> WindowSpec:
        if not self.order_by:
            raise ValueError(f"{self.name} needs order_by: rows have no order of their own")
        return Window.partitionBy(*map(col, self.group_by)).orderBy(*map(col, self.order_by))

    def grouped(self, value: Column) -> Column:
        for g in self.group_by:
            value = F.when(col(g).isNotNull(), value)
        return value


def is_long(df: DataFrame, groups: Sequence[str], most: int | None = None) -> bool:
    """Whether a group has more rows than one task should sort: one count by group."""
    counts = df.groupBy(*map(col, groups)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n"))
    return (counts.first().n or 0) > (LONG if most is None else most)


def over_ranges(df: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """The columns of ordered features of one grouping and order, each range with the rows before it that they need
    together: a feature may look back from what another one made."""
    f = features[0]
    if not f.order_by:
        f.window()  # an error
    keys = {c: f"__key_{i}" for i, c in enumerate([*f.group_by, *f.order_by])}
    given = df.withColumns({k: col(c) for c, k in keys.items()})
    groups, order = [keys[c] for c in f.group_by], [keys[c] for c in f.order_by]
    for one in features:
        if fill := one.filled(df):
            given = filled_forward(given, groups, order, fill)
    out = with_halo(given, groups, order, sum(x.reach() or 0 for x in features))
    for one in features:
        local = copy(one)
        local.group_by, local.order_by = ["_part", *one.group_by], ["_i"]
        out = local.add(out)
    return out.filter("not _halo").drop("_part", "_i", "_halo", *keys.values())


class Lag(Feature):
    """``{c}_lag_{k}``: the value k rows before."""

    def __init__(self, columns: Names, lags: Sequence[int] = (1,), **options: Any) -> None:
        super().__init__(**options)
        self.columns, self.lags = names(columns), list(lags)

    def reach(self) -> int:
        return max(map(abs, self.lags), default=0)

    def add(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {f"{c}_lag_{k}": self.grouped(F.lag(col(c), k).over(self.window())) for c in self.columns if c in df.columns for k in self.lags}
        )


_N = "count"
#: Aggregates over the last rows; skew and kurt are the bias-corrected ones.
AGGREGATES: dict[str, Callable[[Callable[[Callable[[Column], Column]], Column]], Column]] = {
    "mean": lambda over: over(F.avg),
    "sum": lambda over: over(F.sum),
    "min": lambda over: over(F.min),
    "max": lambda over: over(F.max),
    "std": lambda over: over(F.stddev_samp),
    "var": lambda over: over(F.var_samp),
    "median": lambda over: over(lambda x: F.percentile(x, 0.5)),
    "count": lambda over: over(F.count).cast("double"),
    "sem": lambda over: over(F.stddev_samp) / F.sqrt(over(F.count)),
    "first": lambda over: over(lambda x: F.first(x, ignorenulls=True)),
    "last": lambda over: over(lambda x: F.last(x, ignorenulls=True)),
    "nunique": lambda over: F.size(over(F.collect_set)).cast("double"),
    "prod": lambda over: over(F.product),
    "skew": lambda over: F.when(
        over(F.count) > 2,
        F.when(over(F.var_pop) == 0, 0.0).otherwise(over(F.skewness) * F.sqrt(over(F.count) * (over(F.count) - 1)) / (over(F.count) - 2)),
    ),
    "kurt": lambda over: F.when(
        over(F.count) > 3,
        F.when(over(F.var_pop) == 0, -3.0).otherwise(
            (over(F.count) - 1) / ((over(F.count) - 2) * (over(F.count) - 3)) * ((over(F.count) + 1) * over(F.kurtosis) + 6)
        ),
    ),
}


class Rolling(Feature):
    """``{c}_rolling_{aggregate}_{w}`` over the last w rows with this one; nulls are skipped, one value is enough."""

    def __init__(self, column: str, windows: Sequence[int] = (3,), aggregations: Sequence[str] = ("mean",), **options: Any) -> None:
        super().__init__(**options)
        self.column, self.windows, self.aggregations = column, list(windows), list(aggregations)

    def reach(self) -> int:
        return max(self.windows, default=1) - 1

    def add(self, df: DataFrame) -> DataFrame:
        if self.column not in df.columns:
            return df
        x, out = number(col(self.column)), {}
        for w in self.windows:
            frame = self.window().rowsBetween(-(w - 1), 0)
            for a in self.aggregations:
                if a not in AGGREGATES:
                    raise ValueError(f"{self.name}: no aggregate {a}; there are {', '.join(AGGREGATES)}")
                out[f"{self.column}_rolling_{a}_{w}"] = self.grouped(AGGREGATES[a](lambda f, frame=frame: f(x).over(frame)))
        return df.withColumns(out)


class Growth(Feature):
    """``{c}_pct_change_{p}`` (of values filled forward within the group) and ``{c}_diff_{p}`` (of values as they are).

    Growth from zero is null; with ``inf_on_zero`` it is infinite, or NaN from zero to zero.
    """

    def __init__(self, columns: Names, periods: Sequence[int] = (1,), inf_on_zero: bool = False, **options: Any) -> None:
        super().__init__(**options)
        self.columns, self.periods, self.inf_on_zero = names(columns), list(periods), inf_on_zero

    def reach(self) -> int:
        return max(self.periods, default=0)

    def filled(self, df: DataFrame) -> dict[str, Column]:
        return {f"__filled_{c}": number(col(c)) for c in self.columns if c in df.columns}

    def add(self, df: DataFrame) -> DataFrame:
        columns = [c for c in self.columns if c in df.columns]
        w = self.window()
        rest = {k: v for k, v in self.filled(df).items() if k not in df.columns}
        filled = df.withColumns({k: F.last(v, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)) for k, v in rest.items()})
        out = {}
        for c in columns:
            for p in self.periods:
                now, then = col(f"__filled_{c}"), F.lag(col(f"__filled_{c}"), p).over(w)
                change = ratio(now, then) - 1
                if self.inf_on_zero:
                    change = F.when(
                        then == 0, F.when(now == 0, float("nan")).when(now > 0, float("inf")).otherwise(float("-inf")),
                    ).otherwise(change)
                out[f"{c}_pct_change_{p}"] = self.grouped(change)
                out[f"{c}_diff_{p}"] = self.grouped(number(col(c)) - F.lag(number(col(c)), p).over(w))
        return filled.withColumns(out).drop(*(f"__filled_{c}" for c in columns))


class Seasonal(Feature):
    """Seasonal parts of a date and their places on the circle."""

    def __init__(self, date_column: str, features: Sequence[str] = ("month", "quarter", "year"), **options: Any) -> None:
        super().__init__(**options)
        self.date_column, self.features = date_column, list(features)

    def add(self, df: DataFrame) -> DataFrame:
        return df.withColumns(seasonal(self.date_column, self.features)) if self.date_column in df.columns else df


class Calendar(Feature):
    """Sixteen calendar columns of a date; ``holidays`` are numbers by month, or "federal" for those of the date's year."""

    def __init__(self, date_column: str, holidays: dict[int, int] | str | None = None, **options: Any) -> None:
        super().__init__(**options)
        self.date_column, self.holidays = date_column, holidays

    def add(self, df: DataFrame) -> DataFrame:
        return df.withColumns(calendar(self.date_column, self.holidays)) if self.date_column in df.columns else df


class Statistical(Feature):
    """Mean, standard deviation and median of the frame that was fitted, for each group or for all, and the z-score.

    Fitted statistics are one aggregation and, for the median, a range sort. They are joined by group; a single row of them is a cross join of one row.
    """

    def __init__(self, columns: Names, **options: Any) -> None:
        super().__init__(**options)
        self.columns = names(columns)

    def fit(self, df: DataFrame) -> Statistical:
        self.label = "group" if self.group_by else "global"
        self.used = [c for c in self.columns if c in df.columns]
        stats = {"mean": F.avg, "std": F.stddev_samp}
        made = [f(number(col(c))).alias(f"{c}_{self.label}_{n}") for c in self.used for n, f in stats.items()]
        self.stats = None
        if made:
            sums = df.groupBy(*map(col, self.group_by)).agg(*made)
            middle = quantiles(
                df, {c: number(col(c)) for c in self.used}, (0.5,), self.group_by,
            ).withColumnsRenamed({f"{c}_0": f"{c}_{self.label}_median" for c in self.used})
            self.stats = sums.join(middle, self.group_by, "left") if self.group_by else sums.crossJoin(F.broadcast(middle))  # one row
        return super().fit(df)

    def add(self, df: DataFrame) -> DataFrame:
        if self.stats is None:
            return df
        if self.group_by:
            keys = {g: f"__key_{i}" for i, g in enumerate(self.group_by)}
            right = self.stats.withColumnsRenamed(keys)
            on = [col(g) == F.col(k) for g, k in keys.items()]  # a null key finds nothing
            out = df.join(right, on, "left").drop(*keys.values())
        else:
            out = df.crossJoin(F.broadcast(self.stats))
        score = lambda c: ratio(number(col(c)) - col(f"{c}_{self.label}_mean"), col(f"{c}_{self.label}_std"))
        return out.withColumns({f"{c}_zscore": score(c) for c in self.used})


def from_config(config: dict[str, Any]) -> Feature | None:
    """The operator that a configuration entry describes; None for an unknown type."""
    kind, name = config.get("type"), config.get("name")
    make: dict[str, Callable[[], Feature]] = {
        "lag": lambda: Lag(config.get("columns", []), config.get("lags", [1]), name=name),
        "rolling_mean": lambda: Rolling(config["column"], config.get("windows", [3]), ["mean"], name=name),
        "rolling": lambda: Rolling(config["column"], config.get("windows", [3]), config.get("aggregations", ["mean"]), name=name),
        "seasonal": lambda: Seasonal(config["date_column"], config.get("features", ["month", "quarter"]), name=name),
        "calendar": lambda: Calendar(config["date_column"], config.get("holidays"), name=name),
        "growth": lambda: Growth(config.get("columns", []), config.get("periods", [1]), name=name),
        "statistical": lambda: Statistical(config.get("columns", []), name=name),
    }
    return make[kind]() if kind in make else None


class FeaturePipeline:
    """Operators fitted one after the other, each on the frame with the columns of those before; an empty one changes nothing."""

    def __init__(self, features: Sequence[Feature] = (), enabled: bool = True, order_by: Names = None) -> None:
        self.features, self.enabled, self.fitted, self.order_by = list(features), enabled, False, names(order_by)
        self.long: bool | None = None  # whether groups are long; counted where it isn't said

    @classmethod
    def from_config(cls, config: Any) -> FeaturePipeline:
        enabled = config.get("feature_engineering.enabled", True)
        made = [from_config(x) for x in config.get("feature_engineering.features", None) or []] if enabled else []
        order = [config.get("data_source.date_column", None), *(config.get("feature_engineering.order_by", None) or [])]
        return cls([x for x in made if x is not None], enabled, [c for c in order if c])

    def add_transformer(self, feature: Feature) -> FeaturePipeline:
        self.features.append(feature)
        return self

    def fit(self, df: DataFrame, group_by: Names = None, order_by: Names = None) -> FeaturePipeline:
        self.fit_transform(df, group_by, order_by)
        return self

    def fit_transform(self, df: DataFrame, group_by: Names = None, order_by: Names = None) -> DataFrame:
        """``order_by`` is the configuration's (the date column and ``feature_engineering.order_by``) unless given here."""
        if self.enabled:
            order = names(order_by) or [c for c in self.order_by if c in df.columns]
            for f in self.features:
                f.group_by, f.order_by = f.group_by or names(group_by), f.order_by or order
            df = self._fold(df, fit=True)
        self.fitted = True
        return df

    def _fold(self, df: DataFrame, fit: bool) -> DataFrame:
        """Ordered features in a row that share grouping and order are made together; a filled column ends such a run."""
        alike = lambda f: (f.reach() is None, f.group_by, f.order_by, id(f) if f.reach() is None or f.filled(df) else 0)
        for _, run in groupby(self.features, key=alike):
            run = list(run)
            if fit:
                for f in run:
                    f.fit(df)
            ordered = run[0].reach() is not None
            if ordered and (self.long if self.long is not None else is_long(df, run[0].group_by)):
                df = over_ranges(df, run)
            else:
                for f in run:
                    df = f.add(df)
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.enabled:
            return df
        if not self.fitted and self.features:
            raise ValueError("the pipeline must be fitted before transform")
        return self._fold(df, fit=False)

    def save(self, path: str, spark: SparkSession) -> None:
        """What makes the same pipeline again: its settings as JSON, and fitted statistics as Parquet tables beside them (a
        row for each group, written by tasks)."""
        kept = []
        for f in self.features:
            stats, name = getattr(f, "stats", None), None
            if stats is not None:
                name = f"statistics-{uuid4().hex}"  # a new table: the old one may be what is being saved
                stats.write.parquet(f"{path}/{name}")
            kept.append({"class": type(f).__name__, "values": {k: v for k, v in vars(f).items() if k != "stats"}, "stats": name})
        spark.createDataFrame([(json.dumps(kept, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> FeaturePipeline:
        kinds = {c.__name__: c for c in Feature.__subclasses__()}
        made = []
        for one in json.loads(spark.read.text(f"{path}/settings").first().value):
            f = kinds[one["class"]].__new__(kinds[one["class"]])
            values = dict(one["values"])
            if isinstance(values.get("holidays"), dict):
                values["holidays"] = {int(m): n for m, n in values["holidays"].items()}  # JSON has keys as strings
            vars(f).update(values)
            if one["class"] == "Statistical":
                f.stats = None if one["stats"] is None else spark.read.parquet(f"{path}/{one['stats']}")
            made.append(f)
        out = cls(made)
        out.fitted = True
        return out

    def get_feature_names(self, df: DataFrame) -> list[str]:
        """Columns after the transformation; nothing runs."""
        return self.transform(df.limit(0)).columns

    def get_feature_importance_info(self) -> dict[str, Any]:
        return {"transformer_count": len(self.features), "transformer_names": [f.name for f in self.features], "enabled": self.enabled}


def group_key(
    columns: Sequence[str], given: str | None = None, segment_level: str | None = None, key_columns: Sequence[str] = (),
) -> str | None:
    """The group column: the one given (which must be there), else a segment column where segments are asked for, else the first key column."""
    if given:
        if given not in columns:
            raise ValueError(f"group column {given} isn't one of {list(columns)}")
        return given
    if segment_level in ("rollup_shop", "pc", "profit_center"):
        for c in ("Roll Up Shop", "roll_up_shop", "Profit Center", "profit_center"):
            if c in columns:
                return c
    return key_columns[0] if key_columns and key_columns[0] in columns else None
