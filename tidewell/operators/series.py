"""Series operators: roll-ups to days, weeks and months, preparation of a target, outliers, log transform and splits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.dates import month_start, week_start, year_period
from tidewell.functions.numbers import clip, number
from tidewell.operators.features import Names, col, names
from tidewell.operators.ordered import filled_forward, numbered, quantiles


def build_daily_totals(
    raw: DataFrame, date_column: str = "TS", amount_column: str = "Actual", measure_column: str | None = "Measure",
    measure_value: str = "MTD",
) -> DataFrame:
    """(date, actual): amounts summed by day, of one measure where that column exists.

    Unreadable dates are dropped and unreadable amounts count as nothing; a day of nothing but those is 0.
    """
    for c in (date_column, amount_column):
        if c not in raw.columns:
            raise KeyError(f"Column {c} not found")
    rows = raw.filter(col(measure_column) == measure_value) if measure_column and measure_column in raw.columns else raw
    days = rows.select(
        col(date_column).try_cast("date").alias("date"), number(col(amount_column)).alias("amount"),
    ).filter("date is not null")
    return days.groupBy("date").agg(F.coalesce(F.sum("amount"), F.lit(0.0)).alias("actual"))


def daily_to_monthly(daily: DataFrame) -> DataFrame:
    """(month_start, actual_month_total)."""
    return daily.groupBy(month_start(F.col("date")).alias("month_start")).agg(
        F.coalesce(F.sum("actual"), F.lit(0.0)).alias("actual_month_total")
    )


def daily_to_weekly(
    daily: DataFrame, date_column: str = "date", value_column: str = "y_pred", week_first: str = "Mon",
    segment_columns: Sequence[str] | None = None,
) -> DataFrame:
    """[segments,] week_start, week_end, value: sums by week of seven days from ``week_first`` on.

    Without segments, weeks without a day between the first and last are there with 0; with segments they aren't.
    """
    segments = names(segment_columns)
    days = daily.withColumn("__d", col(date_column).cast("date")).filter("__d is not null")
    keyed = days.select(
        *map(col, segments), week_start(F.col("__d"), week_first).alias("week_start"),
        number(col(value_column)).alias("__v"),
    )
    for s in segments:
        keyed = keyed.filter(col(s).isNotNull())
    sums = keyed.groupBy(*map(col, segments), "week_start").agg(F.coalesce(F.sum("__v"), F.lit(0.0)).alias("__v"))
    if not segments:
        ends = sums.agg(F.min("week_start").alias("a"), F.max("week_start").alias("b")).filter("a is not null")
        spine = ends.select(F.explode(F.sequence("a", "b", F.expr("interval 7 days"))).alias("week_start"))
        sums = spine.join(sums, "week_start", "left").withColumn("__v", F.coalesce("__v", F.lit(0.0)))
    return sums.select(*map(col, segments), "week_start", F.date_add("week_start", 6).alias("week_end"), F.col("__v").alias(value_column))


def _numeric(df: DataFrame, skip: set[str]) -> list[str]:
    kinds = ("double", "float", "integer", "long", "short", "byte", "decimal")
    return [f.name for f in df.schema if f.name not in skip and f.dataType.typeName() in kinds]


def sum_by_date(df: DataFrame, date_column: str, exclude: Names = None) -> DataFrame:
    """A panel summed to one series: every numeric column but the date and ``exclude``."""
    numeric = _numeric(df, {date_column, *names(exclude)})
    return df.groupBy(col(date_column)).agg(*(F.coalesce(F.sum(col(c)), F.lit(0)).cast("double").alias(c) for c in numeric))


def sum_by_segment(df: DataFrame, date_column: str, group_by: Names = None) -> DataFrame:
    """One row for each segment and date: sums of the numeric columns, null where a date has only nulls, so that a hole in
    the series stays one."""
    keys = [*names(group_by), date_column]
    return df.groupBy(*map(col, keys)).agg(*(F.sum(col(c)).cast("double").alias(c) for c in _numeric(df, set(keys))))


def fill_target(df: DataFrame, target: str, order_by: Names, group_by: Names = None) -> DataFrame:
    """``target`` filled forward in order (within the group), and 0 before its first value. Over ranges of the order: no task
    gets a whole series."""
    keys = {c: f"__key_{i}" for i, c in enumerate([*names(group_by), *names(order_by)])}
    given = df.withColumns({k: col(c) for c, k in keys.items()})
    groups, order = [keys[c] for c in names(group_by)], [keys[c] for c in names(order_by)]
    found = filled_forward(given, groups, order, {"__filled": number(col(target))})
    return found.withColumn(target, F.coalesce("__filled", F.lit(0.0))).select(*map(col, df.columns))


def outlier_bounds(df: DataFrame, column: str, method: str = "iqr", factor: float = 1.5) -> DataFrame:
    """One row (low, high); nulls where nothing is to be clipped."""
    x = number(col(column))
    if method == "iqr":
        q = quantiles(df, {"q": x}, (0.25, 0.75)).withColumnsRenamed({"q_0": "a", "q_1": "b"})
        return q.select(
            (F.col("a") - factor * (F.col("b") - F.col("a"))).alias("low"),
            (F.col("b") + factor * (F.col("b") - F.col("a"))).alias("high"),
        )
    if method == "zscore":
        m = df.agg(F.avg(x).alias("m"), F.stddev_samp(x).alias("s"))
        reach = F.when(F.col("s") > 0, factor * F.col("s"))
        return m.select((F.col("m") - reach).alias("low"), (F.col("m") + reach).alias("high"))
    return df.sparkSession.createDataFrame([(None, None)], "low double, high double")


def handle_outliers(df: DataFrame, column: str, method: str = "iqr", factor: float = 1.5) -> DataFrame:
    """``column`` clipped to the bounds of the whole frame (one row, joined by broadcast)."""
    bounds = outlier_bounds(df, column, method, factor).select(F.col("low").alias("__low"), F.col("high").alias("__high"))
    return df.crossJoin(F.broadcast(bounds)).withColumn(
        column, clip(number(col(column)), F.col("__low"), F.col("__high")),
    ).drop("__low", "__high")


@dataclass(frozen=True)
class LogTransform:
    """log(1 + y + offset) and back; predictions are clipped at two above the largest value that was fitted."""

    offset: float = 0.0
    largest: float | None = None

    @classmethod
    def fit(cls, df: DataFrame, target: str, offset: float = 0.0) -> LogTransform:
        low, high = df.agg(F.min(number(col(target))), F.max(number(col(target)))).first()
        if low is not None and low <= -1 and -low + 1 > offset:
            offset = -low + 1
        import math

        return cls(offset, None if high is None else math.log1p(high + offset))

    def apply(self, y: Column) -> Column:
        return F.log1p(y + self.offset)

    def invert(self, z: Column) -> Column:
        return F.expm1(z if self.largest is None else F.when(z > self.largest + 2.0, self.largest + 2.0).otherwise(z)) - self.offset


def prepare(
    df: DataFrame, date_column: str, target: str, group_by: Names = None, date_format: str | None = None,
    outliers: dict[str, Any] | None = None, log: bool = False, log_offset: float = 0.0, summed: bool = False,
) -> tuple[DataFrame, LogTransform | None]:
    """Dates read, target filled (within groups), optionally without outliers and in logs; and the transform to invert.

    ``summed``: rows of one segment and date are added up first, so that what is filled are dates, not raw rows."""
    d = year_period(col(date_column)) if date_format == "year_period" else col(date_column).cast("date")
    dated = df.withColumn(date_column, d)
    if summed:
        dated = sum_by_segment(dated.withColumn(target, number(col(target))), date_column, group_by)
    out = fill_target(dated, target, date_column, group_by)
    if outliers and outliers.get("enabled", True):
        out = handle_outliers(out, target, outliers.get("method", "iqr"), outliers.get("factor", 1.5))
    if not log:
        return out, None
    transform = LogTransform.fit(out, target, log_offset)
    return out.withColumn(target, transform.apply(col(target))), transform


def split_by_months(
    df: DataFrame, date_column: str, backtest_months: int, validation_months: int = 0, cutoff: str | None = None,
) -> DataFrame:
    """``df`` with ``split``: test is the ``backtest_months`` before the cutoff (the month after the last date unless
    given), validation the months before those, train all before; rows from the cutoff on are left out."""
    last = F.trunc(F.lit(cutoff).cast("date"), "MM") if cutoff else F.add_months(F.trunc(F.max(col(date_column).cast("date")), "MM"), 1)
    marked = df.crossJoin(F.broadcast(df.agg(last.alias("__end"))))  # one row
    d, test = col(date_column).cast("date"), F.add_months("__end", -backtest_months)
    label = F.when(d < F.add_months(test, -validation_months), "train").when(d < test, "validation").when(d < F.col("__end"), "test")
    return marked.withColumn("split", label).filter("split is not null").drop("__end")


def split_by_ratio(df: DataFrame, order_by: Names, test_size: float = 0.2, validation_size: float = 0.1) -> DataFrame:
    """``df`` with ``split`` by place in the order: the last rows are test, those before validation, sizes rounded down."""
    placed = numbered(df, [f"`{c}`" for c in names(order_by)])
    sized = placed.crossJoin(F.broadcast(placed.agg(F.max("__i").alias("__n"))))  # one row
    n, i = F.col("__n"), F.col("__i")
    test, validation = F.floor(n * test_size), F.floor(n * validation_size)
    return sized.withColumn(
        "split", F.when(i <= n - test - validation, "train").when(i <= n - test, "validation").otherwise("test"),
    ).drop("__n", "__i")


def split(
    df: DataFrame, date_column: str, backtest_months: int = 0, validation_months: int = 0, cutoff: str | None = None,
    test_size: float = 0.2, validation_size: float = 0.1,
) -> tuple[DataFrame, dict[str, Any]]:
    """By months where that leaves rows to train and test on, else by ratio; and what was chosen."""
    if backtest_months > 0:
        out = split_by_months(df, date_column, backtest_months, validation_months, cutoff)
        counts = {
            r.split: r for r in out.groupBy("split").agg(
                F.count(F.lit(1)).alias("n"), F.min(col(date_column).cast("date")).alias("first"),
                F.max(col(date_column).cast("date")).alias("last"),
            ).collect()
        }
        if "train" in counts and "test" in counts:
            return out, {"method": "months"} | {f"{k}_rows": r.n for k, r in counts.items()} | {f"{k}_{e}": str(r[e]) for k, r in counts.items() for e in ("first", "last")}
    return split_by_ratio(df, date_column, test_size, validation_size), {"method": "ratio"}
