"""Sums, fills and windows over ranges against the plain windows, with ranges shorter than what is looked back."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tidewell.operators import features as feats
from tidewell.operators.features import FeaturePipeline, Growth, Lag, Rolling
from tidewell.operators.ordered import filled_forward, group_running, with_halo
from tidewell.operators.series import fill_target, prepare


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(7)
    made = [("hot" if r.random() < 0.7 else r.choice(["a", "b", None]), i, None if r.random() < 0.3 else float(r.randrange(100))) for i in range(600)]
    made += [("none", 700 + i, None) for i in range(5)]
    return spark.createDataFrame(made, "g string, i long, x double").repartition(5).cache()


@pytest.fixture
def narrow(spark):
    """Many short ranges."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    c = sorted(a.columns)
    assert sorted(map(repr, a.select(c).collect())) == sorted(map(repr, b.select(c).collect()))


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_running_sums_and_fills(rows, narrow, groups):
    w = Window.partitionBy(*groups).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    whole = rows.withColumn("n", F.lit(1))
    same(group_running(whole, groups, ["i"], "n", "i"), whole.withColumns({"n_upto": F.sum("n").over(w), "i_upto": F.sum("i").over(w)}))
    same(filled_forward(rows, groups, ["i"], {"f": F.col("x")}), rows.withColumn("f", F.last("x", ignorenulls=True).over(w)))


@pytest.mark.parametrize("n", [0, 1, 30, 200])
def test_halos_hold_the_rows_before_a_range(rows, narrow, n):
    found = with_halo(rows, [], ["i"], n).collect()
    own = sorted((r._i, r._part) for r in found if not r._halo)
    assert [i for i, _ in own] == list(range(1, 606)) and len({p for _, p in own}) > 10
    for p in {p for _, p in own}:
        first = min(i for i, q in own if q == p)
        assert sorted(r._i for r in found if r._halo and r._part == p) == list(range(max(1, first - n), first))


@pytest.mark.parametrize("group_by", [None, "g"])
@pytest.mark.parametrize("kind", ["lag", "rolling", "growth", "chain"])
def test_features_over_ranges_equal_windows(rows, narrow, monkeypatch, kind, group_by):
    how = {"group_by": group_by, "order_by": "i"}
    make = {
        "lag": lambda: [Lag("x", [1, 40, 300], **how)],
        "rolling": lambda: [Rolling("x", [3, 120], ["mean", "count", "max"], **how)],
        "growth": lambda: [Growth("x", [1, 60], **how)],
        "chain": lambda: [Lag("x", [2], **how), Rolling("x_lag_2", [50], ["sum"], **how), Growth("x_lag_2", [5], **how)],
    }[kind]
    plain = FeaturePipeline(make())
    plain.long = False
    expect = plain.fit_transform(rows)
    monkeypatch.setattr(feats, "LONG", 100)
    pipeline = FeaturePipeline(make())
    found = pipeline.fit_transform(rows)
    numbers = [c for c in expect.columns if c not in rows.columns]
    same(*(x.select("g", "i", "x", *(F.round(c, 6).alias(c) for c in numbers)) for x in (found, expect)))
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()
    if len(make()) == 1:
        same(*(x.select("i", *(F.round(c, 6).alias(c) for c in numbers)) for x in (make()[0].fit(rows).transform(rows), expect)))


def test_lags_of_one_long_series_are_spread(spark, narrow, monkeypatch):
    """A table of one segment: no partition of the windows has more than a range and its halo."""
    monkeypatch.setattr(feats, "LONG", 100)
    df = spark.range(4000).select(F.lit("one").alias("g"), F.col("id").alias("i"), F.col("id").cast("double").alias("x"))
    halo = with_halo(df, ["g"], ["i"], 12)
    sizes = [r["count"] for r in halo.groupBy("_part").count().collect()]
    assert len(sizes) > 15 and max(sizes) < 600
    found = Lag("x", [12], group_by="g", order_by="i").fit(df).transform(df)
    assert found.filter("i >= 12 and x_lag_12 = i - 12").count() == 3988


def test_fill_of_raw_rows_has_no_single_task(spark, narrow):
    df = spark.createDataFrame([("2020-01-01", None), ("2020-02-01", 3.0), ("2020-03-01", None), ("2020-04-01", 5.0)] * 50, "d string, y double")
    plan = fill_target(df, "y", "d")._jdf.queryExecution().executedPlan().toString()
    for below in plan.split("Exchange SinglePartition")[1:]:  # only what is one row for each range by then
        assert "Aggregate(key=[_part#" in below.split("Exchange")[0]


def test_dates_are_summed_before_they_are_filled(spark):
    rows = [("a", "2020-01-01", 1.0), ("a", "2020-01-01", 2.0), ("a", "2020-02-01", None), ("a", "2020-02-01", None), ("a", "2020-03-01", 5.0), ("b", "2020-01-01", None), ("b", "2020-03-01", 7.0)]
    out, _ = prepare(spark.createDataFrame(rows, "s string, d string, y double"), "d", "y", "s", summed=True)
    assert sorted((r.s, str(r.d), r.y) for r in out.collect()) == [("a", "2020-01-01", 3.0), ("a", "2020-02-01", 3.0), ("a", "2020-03-01", 5.0), ("b", "2020-01-01", 0.0), ("b", "2020-03-01", 7.0)]


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, i long, x double")
    assert group_running(df, ["g"], ["i"], "x").count() == 0 and filled_forward(df, [], ["i"], {"f": F.col("x")}).count() == 0
    assert with_halo(df, ["g"], ["i"], 3).count() == 0
