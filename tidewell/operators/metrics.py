"""Accuracy of predictions: one aggregation for all metrics, and errors by horizon."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.dates import month_start
from tidewell.functions.numbers import finite, ratio
from tidewell.operators.features import Names, col, names
from tidewell.operators.ordered import with_halo

METRICS = ("mae", "mse", "rmse", "r2", "mape", "wape", "mase", "bias", "bias_pct", "tracking_signal")


def accuracy(df: DataFrame, actual: str, predicted: str, order_by: Names, group_by: Names = None, season: int = 12) -> DataFrame:
    """One row (for each group): METRICS, null where undefined. Pairs with null, NaN or infinite values don't count.

    The naive forecast of mase is the value ``season`` rows before, or one row before in a series no longer than that. It is
    found in ranges of the order, each with the ``season`` rows before it, so no task gets all pairs, nor all of a group.
    """
    keys = {g: f"__k{i}" for i, g in enumerate(names(group_by))}
    order = {c: f"__o{i}" for i, c in enumerate(names(order_by))}
    clean = df.select(
        *(col(c).alias(k) for c, k in (*keys.items(), *order.items())), finite(col(actual)).alias("__y"), finite(col(predicted)).alias("__p"),
    ).filter("__y is not null and __p is not null")
    w = Window.partitionBy("_part", *keys.values()).orderBy("_i")
    lagged = with_halo(clean, list(keys.values()), list(order.values()), season).select(
        *(F.col(k).alias(g) for g, k in keys.items()), "__y", "__p", "_halo", F.lag("__y", season).over(w).alias("__s"), F.lag("__y", 1).over(w).alias("__l"),
    ).filter("not _halo")
    groups = [col(g) for g in keys]
    y, p = F.col("__y"), F.col("__p")
    e, size = F.abs(y - p), F.sum(F.abs(y))
    naive = F.when(F.count(y) > season, F.avg(F.abs(y - F.col("__s")))).otherwise(F.avg(F.abs(y - F.col("__l"))))
    mae = F.avg(e)
    total = F.var_pop(y) * F.count(y)
    return lagged.groupBy(*groups).agg(
        F.count(y).alias("__rows"), mae.alias("mae"), F.avg((y - p) * (y - p)).alias("mse"), F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.when(
            F.count(y) > 1,
            F.when(total > 0, 1 - F.sum((y - p) * (y - p)) / total).when(F.sum((y - p) * (y - p)) == 0, 1.0).otherwise(0.0),
        ).alias("r2"),
        (
            F.avg(F.when(y != 0, F.abs((y - p) / F.when(y != 0, y)))) * 100
        ).alias("mape"), F.when(size > 0, F.sum(e) / size * 100).alias("wape"),
        F.when(naive > 0, mae / naive).alias("mase"), F.avg(p - y).alias("bias"), F.when(
            size > 0, F.sum(p - y) / size * 100,
        ).alias("bias_pct"),
        F.when(mae > 0, F.sum(p - y) / mae).alias("tracking_signal"),
    ).filter("__rows > 0").drop("__rows")


def horizon_errors(df: DataFrame, date_column: str, actual: str, predicted: str) -> DataFrame:
    """horizon (1 for the first date), month, actual_mean, pred_mean, mae, wape (null if nothing was actual) by date."""
    pairs = df.select(col(date_column).cast("date").alias("d"), finite(col(actual)).alias("y"), finite(col(predicted)).alias("p"))
    e = F.sum(F.abs(F.col("y") - F.col("p")))
    by = pairs.groupBy("d").agg(
        F.avg("y").alias("actual_mean"), F.avg("p").alias("pred_mean"),
        F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"),
        (ratio(e, F.when(F.sum(F.abs("y")) > 0, F.sum(F.abs("y")))) * 100).alias("wape"),
    )
    return by.select(
        F.row_number().over(Window.orderBy("d")).alias("horizon"),
        F.date_format(month_start(F.col("d")), "yyyy-MM").alias("month"), "actual_mean", "pred_mean", "mae", "wape",
    )
