"""Daily allocation of monthly totals, as one set-based plan instead of loops over months and days.

History days are associated with the target months they may inform (the years before the month, never the month
itself) by an equi-join on the year and a residual range filter; shares, fallbacks, scores and weights are aggregates
and windows by target month. The as-of backtest is the same plan over months, offsets and strategies.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields, replace
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.dates import month_start
from tidewell.scratch import written

STRATEGIES = ("fixed", "mtd_ratio", "blend")


@dataclass(frozen=True)
class AllocationConfig:
    """Settings of the allocation; ``method``, ``weight_model`` and ``daily_enabled`` are accepted and change nothing."""

    daily_enabled: bool = False
    method: str = "shape"
    history_years: int = 3
    min_history_months: int = 18
    weight_model: str = "dom_dow"
    negative_handling: str = "clip_to_zero"
    smoothing_epsilon: float = 1e-6
    fallback: tuple[str, ...] = ("dow", "uniform")
    as_of_date: str = "auto"
    posting_lag_days: int = 1
    strategy: str = "fixed"
    blend_alpha: float = 0.7
    min_expected_share: float = 0.05
    max_multiplier: float | None = 2.0
    allow_negative_totals: bool = True
    early_cutoff_days: int = 5
    min_share_for_blend: float = 0.15

    @classmethod
    def from_config(cls, config: Any) -> AllocationConfig:
        """From a configuration with dotted keys below ``forecasting``."""
        get = lambda path, default: default if (v := config.get(f"forecasting.{path}", None)) is None else v
        base = {f.name: f.default for f in fields(cls)}
        where = {
            "daily_enabled": "daily_enabled", "as_of_date": "as_of_date", "posting_lag_days": "posting_lag_days",
            **{
                k: f"daily_allocation.{k}" for k in (
                    "method", "history_years", "min_history_months", "weight_model", "smoothing_epsilon", "fallback",
                )
            },
            "negative_handling": "daily_allocation.negative_handling_for_weights", "strategy": "current_month_total.strategy",
            **{
                k: f"current_month_total.{k}" for k in (
                    "blend_alpha", "min_expected_share", "max_multiplier", "allow_negative_totals",
                    "min_share_for_blend",
                )
            },
            "early_cutoff_days": "current_month_total.strategy_early_cutoff_days", "min_share_for_blend": "current_month_total.strategy_min_share_for_blend",
        }
        got = {k: get(path, base[k]) for k, path in where.items()}
        return cls(**(got | {"fallback": tuple(got["fallback"])}))

    def resolve_strategy(self, day: int, share: float) -> str:
        """The strategy that holds on a day of the month with an expected share: too early or too small means fixed."""
        return "fixed" if self.strategy == "fixed" or day <= self.early_cutoff_days or share < self.min_share_for_blend else self.strategy

    def resolve(self, day: Column, share: Column) -> Column:
        return F.when((day <= self.early_cutoff_days) | (share < self.min_share_for_blend), "fixed").otherwise(self.strategy)


def _fit(df: DataFrame, columns: dict[str, str], what: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} needs columns {missing}")
    return df.select(*(F.col(c).cast(t).alias(c) for c, t in columns.items()))


def month_history(months: DataFrame, daily: DataFrame, years: int) -> DataFrame:
    """(month_start, date, actual): for each target month the days of the ``years`` before it.

    A month is matched by the calendar years its window touches, so the join is an equi-join of bounded fan-out.
    """
    m = months.select("month_start").distinct().withColumn("from", F.add_months("month_start", -12 * years))
    keyed = m.withColumn("y", F.explode(F.sequence(F.year("from"), F.year("month_start"))))
    return daily.withColumn("y", F.year("date")).join(keyed, "y").filter(
        (F.col("date") >= F.col("from")) & (F.col("date") < F.col("month_start"))
    ).select("month_start", "date", "actual")


def shape_table(history: DataFrame, cfg: AllocationConfig) -> DataFrame:
    """(month_start, moy, dom, dow, share): mean share of its month's total by month, day of month and weekday.

    Target months with fewer than ``min_history_months`` months of history have no shape.
    """
    w = Window.partitionBy("month_start", "__m")
    amount = F.when(F.col("actual") < 0, 0.0).otherwise(F.col("actual")) if cfg.negative_handling == "clip_to_zero" else F.col("actual")
    shares = history.withColumn("__m", month_start(F.col("date"))).withColumn("__a", amount).withColumn("__t", F.sum("__a").over(w))
    enough = history.groupBy("month_start").agg(
        F.countDistinct(month_start(F.col("date"))).alias("n")
    ).filter(F.col("n") >= cfg.min_history_months).select("month_start")
    kept = shares.filter("__t > 0").join(enough, "month_start", "left_semi")
    return kept.groupBy(
        "month_start", F.month("date").alias("moy"), F.day("date").alias("dom"), F.weekday("date").alias("dow"),
    ).agg(F.avg(F.col("__a") / F.col("__t")).alias("share"))


def day_spine(months: DataFrame) -> DataFrame:
    """``months`` with a row for each day (``date``)."""
    return months.withColumn("date", F.explode(F.sequence("month_start", F.last_day("month_start"), F.expr("interval 1 day"))))


def raw_scores(months: DataFrame, daily: DataFrame, cfg: AllocationConfig) -> DataFrame:
    """(month_start, date, score) of every day of the months.

    A day's score is its exact share, else the first of the fallbacks there is: ``dow`` and ``dom`` are means over the
    shape's rows, ``uniform`` is 1; it is not below zero, and epsilon is added.
    """
    shape = shape_table(month_history(months, daily, cfg.history_years), cfg)
    days = day_spine(months.select("month_start").distinct()).withColumns(
        {"moy": F.month("date"), "dom": F.day("date"), "dow": F.weekday("date")}
    )
    out, choices = days.join(shape, ["month_start", "moy", "dom", "dow"], "left"), [F.col("share")]
    for level in cfg.fallback:
        if level == "uniform":
            choices.append(F.lit(1.0))
            break
        if level in ("dow", "dom"):
            out = out.join(shape.groupBy("month_start", level).agg(F.avg("share").alias(f"by_{level}")), ["month_start", level], "left")
            choices.append(F.col(f"by_{level}"))
    return out.select(
        "month_start", "date",
        (F.greatest(F.coalesce(*choices, F.lit(1.0)), F.lit(0.0)) + cfg.smoothing_epsilon).alias("score"),
    )


def weight(score: Column, *parts: Column) -> Column:
    """Score over the sum of scores of its part; a lone day has 1, and without a positive sum all days are equal."""
    w = Window.partitionBy(*parts)
    n, total = F.count(F.lit(1)).over(w), F.sum(score).over(w)
    return F.when(n == 1, 1.0).when(total > 0, score / F.when(total > 0, total)).otherwise(1.0 / n)


def daily_weights(months: DataFrame, daily: DataFrame, cfg: AllocationConfig) -> DataFrame:
    """(month_start, date, score, weight): weights of a month's days add up to 1."""
    return raw_scores(months, daily, cfg).withColumn("weight", weight(F.col("score"), F.col("month_start")))


def expected_share(observed: Column, total: Column, floor: float) -> Column:
    """Share of the month that is expected by now, not below the floor."""
    return F.when(total > 0, F.greatest(observed / F.when(total > 0, total), F.lit(floor))).otherwise(floor)


def mtd_estimate(mtd: Column, share: Column) -> Column:
    return F.when(share > 0, mtd / F.when(share > 0, share)).otherwise(F.lit(None).cast("double"))


def month_total_final(mtd: Column, model: Column, share: Column, strategy: Column, cfg: AllocationConfig) -> Column:
    """The month's total: the model's, month-to-date over expected share (capped), or a blend of both."""
    ratio = F.coalesce(mtd_estimate(mtd, share), model)
    if cfg.max_multiplier:
        cap = F.abs(model) * cfg.max_multiplier
        ratio = F.when(model != 0, F.greatest(F.least(ratio, cap), -cap)).otherwise(ratio)
    total = F.when(strategy == "mtd_ratio", ratio).when(
        strategy == "blend", cfg.blend_alpha * model + (1 - cfg.blend_alpha) * ratio,
    ).otherwise(model)
    return total if cfg.allow_negative_totals else F.greatest(total, F.lit(0.0))


class DailyAllocator:
    def __init__(self, config: AllocationConfig | None = None) -> None:
        self.cfg = config or AllocationConfig()
        self._daily: DataFrame | None = None
        self._monthly: DataFrame | None = None

    def set_daily_history(self, daily: DataFrame) -> DailyAllocator:
        """``daily`` (date, actual); of rows of one date the first by amount counts for the day."""
        self._daily = _fit(daily, {"date": "date", "actual": "double"}, "daily history")
        return self

    def set_monthly_forecasts(self, monthly: DataFrame) -> DailyAllocator:
        self._monthly = _fit(
            monthly, {"month_start": "date", "forecast_total": "double"}, "monthly forecasts",
        ).groupBy("month_start").agg(F.min("forecast_total").alias("forecast_total"))
        return self

    def _inputs(self) -> tuple[DataFrame, DataFrame]:
        if self._daily is None:
            raise RuntimeError("set_daily_history() comes first")
        if self._monthly is None:
            raise RuntimeError("set_monthly_forecasts() comes first")
        return self._daily, self._monthly

    def predict_daily(self, as_of_date: str | date | None = None, horizon_months: int = 12) -> DataFrame:
        """A row for each day of the current month and of the months to the horizon that have a forecast."""
        daily, monthly = self._inputs()
        cfg, given = self.cfg, as_of_date or self.cfg.as_of_date
        as_of = date.today() if given == "auto" else date.fromisoformat(str(given)[:10])
        aod = F.lit(as_of.isoformat()).cast("date")
        current = month_start(aod)
        months = monthly.filter((F.col("month_start") >= current) & (F.col("month_start") <= F.add_months(current, horizon_months)))
        by_day = daily.groupBy("date").agg(F.min("actual").alias("actual"))
        days = raw_scores(months, daily, cfg).join(months, "month_start").join(by_day, "date", "left")
        now, seen = F.col("month_start") == current, (F.col("month_start") == current) & (
            F.col("date") <= F.date_sub(aod, cfg.posting_lag_days)
        )
        m = Window.partitionBy("month_start")
        days = days.withColumns({
            "now": now, "seen": seen, "w_full": weight(F.col("score"), F.col("month_start")), "w_part": weight(
                F.col("score"), F.col("month_start"), seen,
            ),
            "mtd": F.sum(
                F.when(seen, F.coalesce("actual", F.lit(0.0))).otherwise(0.0)
            ).over(m), "open": F.sum(F.when(seen, 0).otherwise(1)).over(m),
            "raw_share": expected_share(
                F.sum(F.when(seen, F.col("score")).otherwise(0.0)).over(m), F.sum("score").over(m),
                cfg.min_expected_share,
            ),
        })
        over, share = F.col("open") == 0, F.when(F.col("open") == 0, 1.0).otherwise(F.col("raw_share"))
        effective = F.when(over, cfg.strategy).otherwise(
            cfg.resolve(F.lit(as_of.day), F.col("raw_share")) if cfg.strategy != "fixed" else F.lit("fixed")
        )
        model = F.col("forecast_total")
        final = F.when(~F.col("now"), model).when(over, F.col("mtd")).otherwise(
            month_total_final(F.col("mtd"), model, F.col("raw_share"), effective, cfg)
        )
        capped = F.lit(False)
        if cfg.max_multiplier:
            capped = effective.isin("mtd_ratio", "blend") & (model != 0) & (
                F.abs(mtd_estimate(F.col("mtd"), F.col("raw_share"))) > F.abs(model) * cfg.max_multiplier
            ) & ~over
        here = lambda c: F.when(F.col("now"), c)
        return days.withColumn("final", final).select(
            "date", "month_start", F.when(
                F.col("seen"), F.coalesce("actual", F.lit(0.0)),
            ).when(F.col("now"), F.col("actual")).alias("y_true"),
            F.when(F.col("seen"), F.coalesce("actual", F.lit(0.0))).otherwise(
                (F.col("final") - F.col("mtd")) * F.col("w_part")
            ).alias("y_pred"),
            (model * F.col("w_full")).alias("forecast_amount"), F.col("seen").alias("is_actual"), aod.alias("as_of_date"), model.alias("month_total_model"),
            here(F.lit(cfg.strategy)).alias("strategy"), here(effective).alias("effective_strategy"), here(share).alias("expected_mtd_share"),
            here(
                F.when(capped, F.lit(float(cfg.max_multiplier or 0)))
            ).alias("multiplier_applied"), F.datediff("date", aod).alias("horizon_day"),
            F.months_between("month_start", current).cast("int").alias("horizon_month"), F.col("final").alias("month_total_final"),
        )

    @staticmethod
    def coherence(predictions: DataFrame, tolerance: float = 0.01) -> DataFrame:
        """(month_start, total, expected, difference, coherent): do the days add up to the month's total?"""
        by = predictions.groupBy("month_start").agg(F.sum("y_pred").alias("total"), F.max("month_total_final").alias("expected"))
        return by.withColumn(
            "difference", F.abs(F.col("total") - F.col("expected")),
        ).withColumn("coherent", F.col("difference") <= tolerance)

    def backtest_intramonth_daily(
        self, as_of_day_offsets: Sequence[int] = (5, 10, 15, 20), strategies: Sequence[str] | None = None,
    ) -> DataFrame:
        """Errors of the rest of the month, for every month of history with a forecast, as-of day and strategy.

        ``scheduled`` is the configured strategy behind its guardrails; strategies that are named hold as they are.
        """
        daily, monthly = self._inputs()
        cfg, spark = self.cfg, daily.sparkSession
        totals = daily.groupBy(month_start(F.col("date")).alias("month_start")).agg(
            F.coalesce(F.sum("actual"), F.lit(0.0)).alias("month_actual_total")
        )
        months = totals.join(monthly, "month_start")
        by_day = daily.groupBy("date").agg(F.sum("actual").alias("actual"))
        days = raw_scores(months, daily, cfg).join(by_day, "date", "left").withColumn("actual", F.coalesce("actual", F.lit(0.0)))
        days = written(days, "days")  # read once for the sums and once for the errors of each as-of day
        offsets = spark.createDataFrame([(int(k),) for k in as_of_day_offsets], "as_of_day int")
        x = days.crossJoin(F.broadcast(offsets)).filter(F.col("as_of_day") <= F.day(F.last_day("month_start")))
        left = F.col("date") > F.date_sub(F.date_add("month_start", F.col("as_of_day") - 1), cfg.posting_lag_days)
        key = ["month_start", "as_of_day"]
        x = x.withColumn("left", left).withColumn("w", weight(F.col("score"), *map(F.col, key), F.col("left")))
        sums = x.groupBy(*key).agg(
            F.sum(
                F.when(F.col("left"), 0.0).otherwise(F.col("actual"))
            ).alias("mtd_actual"), F.sum(F.when(F.col("left"), F.col("actual")).otherwise(0.0)).alias("remaining_actual"),
            F.sum(F.when(F.col("left"), 0.0).otherwise(F.col("score"))).alias("seen"), F.sum("score").alias("all"),
        )
        names = spark.createDataFrame([(s,) for s in (strategies or [cfg.strategy])], "strategy string")
        share = expected_share(F.col("seen"), F.col("all"), cfg.min_expected_share)
        rows = sums.join(months, "month_start").withColumn("share", share).crossJoin(F.broadcast(names))
        scheduled = cfg.resolve(F.col("as_of_day"), F.col("share")) if cfg.strategy != "fixed" else F.lit("fixed")
        rows = rows.withColumn("effective_strategy", F.when(F.col("strategy") == "scheduled", scheduled).otherwise(F.col("strategy")))
        rows = rows.withColumn(
            "month_total_final",
            month_total_final(F.col("mtd_actual"), F.col("forecast_total"), F.col("share"), F.col("effective_strategy"), cfg),
        )
        rows = rows.withColumn("remaining_forecast", F.col("month_total_final") - F.col("mtd_actual"))
        each = x.filter("left").select(*key, "w", "actual").join(rows, key)
        error = F.abs(F.col("remaining_forecast") * F.col("w") - F.col("actual"))
        size = F.sum(F.abs("actual"))
        head = [
            "month_start", "as_of_day", "strategy", "effective_strategy", "mtd_actual", "remaining_actual",
            "month_actual_total", "forecast_total", "month_total_final", "remaining_forecast",
        ]
        found = each.groupBy(*head).agg(
            F.avg(error).alias("remainder_mae"),
            F.when(size > 0, F.sum(error) / F.when(size > 0, size) * 100).otherwise(F.sum(error)).alias("remainder_wape"),
        )
        gap, actual = F.col("month_total_final") - F.col("month_actual_total"), F.abs("month_actual_total")
        return found.select(
            *head[:4], F.lit(cfg.posting_lag_days).alias("posting_lag_days"), *head[4:7], F.col("forecast_total").alias("month_total_model"), *head[8:], "remainder_mae", "remainder_wape",
            gap.alias("full_month_error"), F.when(
                actual > 0, gap / F.when(actual > 0, actual) * 100,
            ).otherwise(0.0).alias("full_month_error_pct"),
        )

    def with_config(self, **changes: Any) -> DailyAllocator:
        other = DailyAllocator(replace(self.cfg, **changes))
        other._daily, other._monthly = self._daily, self._monthly
        return other
