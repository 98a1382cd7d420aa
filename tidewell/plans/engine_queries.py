"""Registered queries of loading, files, configuration, preparation and the command line, each with its SQL."""

from __future__ import annotations

import json
import os
import tempfile
from functools import reduce
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.config import ConfigManager
from tidewell.functions.dates import year_period
from tidewell.operators import quality
from tidewell.operators.features import Calendar, FeaturePipeline, Lag, Rolling, Statistical, group_key
from tidewell.operators.metrics import accuracy
from tidewell.operators.series import daily_to_weekly, prepare
from tidewell.plans.forecaster import date_features
from tidewell.plans.models import available_models, make_model
from tidewell.plans.queries import _PAIRS, MONTHLY, PANEL, _dates, _pairs, _rows, monthly, panel, query, rounded, table
from tidewell.scratch import scratch
from tidewell.sources.io import Checkpoint, Loader, quoted, quoted_columns, read_csv, write_csv
from tidewell.streaming.delta import daily_totals_stream, load_new_files

_ORDER = {"group_by": "segment", "order_by": "date"}

# ---------------------------------------------------------------- loading and files


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def full_scan(spark: SparkSession, d: str) -> DataFrame:
    return Loader(spark, table(spark, d, "supplier")).load_data().select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 250")
def delta_limited(spark: SparkSession, d: str) -> DataFrame:
    """A limited incremental scan takes the lowest rows beyond the checkpoint."""
    checkpoint = Checkpoint(f"{scratch(spark)}/last.json", spark)
    checkpoint.write(1000)
    return Loader(spark, table(spark, d, "orders")).load_delta("o_orderkey", checkpoint, 250).select(
        "o_orderkey", "o_custkey", "o_totalprice",
    )


@query("""SELECT l_orderkey, l_linenumber, l_quantity, row_number() OVER w AS place, lag(l_quantity, 1) OVER w AS l_quantity_lag_1
    FROM lineitem WINDOW w AS (ORDER BY l_orderkey, l_linenumber, l_quantity)""")
def csv_file_order(spark: SparkSession, d: str) -> DataFrame:
    """Order lines from files, one for each range of the order, lagged in the order in which they stand there."""
    path, columns = f"{scratch(spark)}/lines", ["l_orderkey", "l_linenumber", "l_quantity"]
    write_csv(table(spark, d, "lineitem").select(*columns).orderBy(*columns), path)
    rows = read_csv(spark, path, "l_orderkey long, l_linenumber int, l_quantity double", multi_line=False, place="place")
    return Lag("l_quantity", [1], order_by="place").fit_transform(rows)


def _database(spark: SparkSession, rows: DataFrame, name: str, **more: str) -> Loader:
    """``rows`` as a table of an embedded database that lives in this process while the session does."""
    options = {"url": f"jdbc:derby:memory:{uuid4().hex};create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows.write.format("jdbc").options(**options, **more).option("dbtable", quoted(name)).save()
    return Loader(spark, jdbc=options, name=quoted(name))


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


_TYPES = {"createTableColumnTypes": "o_orderstatus VARCHAR(20)"}


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def jdbc_ranges(spark: SparkSession, d: str) -> DataFrame:
    """A table of a database, read by four tasks side by side."""
    return _database(spark, _orders(spark, d), "orders", **_TYPES).load_ranges("o_orderkey", 4)


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders)")
def jdbc_newer_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Rows beyond a watermark, in ranges of about as many rows each."""
    rows = _orders(spark, d)
    checkpoint = Checkpoint(f"{scratch(spark)}/last.json", spark)
    checkpoint.write(rows.agg(F.max("o_orderkey")).first()[0] // 2)
    return _database(spark, rows, "orders", **_TYPES).load_ranges("o_orderkey", 4, checkpoint, even=False)


@query("SELECT o_orderstatus AS status, count(*)::INTEGER AS n, max(o_orderkey) AS last FROM orders GROUP BY 1")
def jdbc_statement(spark: SparkSession, d: str) -> DataFrame:
    """A statement that the database runs; only its result is read."""
    loader = _database(spark, _orders(spark, d), "orders", **_TYPES)
    return loader.execute('SELECT "o_orderstatus" AS "status", count(*) AS "n", max("o_orderkey") AS "last" FROM "orders" GROUP BY "o_orderstatus"')


@query("SELECT r_regionkey, r_name, true AS filled, false AS absent FROM region")
def connection_test(spark: SparkSession, d: str) -> DataFrame:
    """A table that a connection reads, and a connection without that table."""
    loader = _database(spark, table(spark, d, "region").select("r_regionkey", "r_name"), "region", createTableColumnTypes="r_name VARCHAR(30)")
    none = Loader(spark, jdbc=loader.jdbc, name=quoted("none"))
    return loader.load_data().withColumns({"filled": F.lit(loader.test_connection()), "absent": F.lit(none.test_connection())})


@query("""SELECT c_custkey, '"' || c_name || '"."t""' || c_nationkey || '"' AS name FROM customer""")
def table_names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer")
    second = F.concat(F.lit('t"'), F.col("c_nationkey").cast("string"))
    return rows.select("c_custkey", quoted_columns(F.col("c_name"), F.lit(None).cast("string"), second).alias("name"))


@query(
    "SELECT s_suppkey, CASE WHEN s_nationkey = 3 THEN NULL ELSE s_name END AS s_name, s_acctbal, DATE '2024-01-01' + s_nationkey::INTEGER AS day FROM supplier"
)
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Rows written as CSV and read again with their types; N/A is a missing value."""
    rows = table(spark, d, "supplier").select(
        "s_suppkey", F.when(F.col("s_nationkey") == 3, "N/A").otherwise(F.col("s_name")).alias("s_name"), "s_acctbal",
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("s_nationkey").cast("int")).alias("day"),
    )
    path = f"{scratch(spark)}/supplier.csv"
    write_csv(rows, path)
    return read_csv(spark, path, "s_suppkey long, s_name string, s_acctbal double, day date")


@query("SELECT r_regionkey, r_name FROM region")
def csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    path = f"{scratch(spark)}/region.csv"
    write_csv(table(spark, d, "region").select("r_regionkey", "r_name"), path, one_file=True)
    return read_csv(spark, path)


# ---------------------------------------------------------------- streams


@query("SELECT o_orderkey, o_totalprice FROM orders")
def stream_new_files(spark: SparkSession, d: str) -> DataFrame:
    """Files that come in two lots are loaded by two runs of a stream, each file once."""
    folder, orders = scratch(spark), table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    for lot in ("o_orderdate < date'1998-01-01'", "o_orderdate >= date'1998-01-01' or o_orderdate is null"):
        orders.filter(lot).drop("o_orderdate").write.mode("append").parquet(f"{folder}/in")
        load_new_files(spark, f"{folder}/in", f"{folder}/out", f"{folder}/seen", orders.drop("o_orderdate").schema)
    return spark.read.parquet(f"{folder}/out")


@query("""SELECT ts::DATE AS date, round(sum(value), 2) AS actual FROM events WHERE ts::DATE + 1 <= (SELECT max(ts) FROM events) - INTERVAL 3 DAY GROUP BY 1""")
def stream_daily_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals of the days that the watermark, three days behind the last event, has closed."""
    folder, events = scratch(spark), table(spark, d, "events").select("ts", "value")
    events.write.parquet(f"{folder}/in")
    load_new_files(spark, f"{folder}/in", f"{folder}/out", f"{folder}/seen", events.schema, lambda rows: daily_totals_stream(rows, "ts", "value"))
    return rounded(spark.read.parquet(f"{folder}/out"), 2)


# ---------------------------------------------------------------- features


@query(
    f"WITH {PANEL}, t AS (SELECT segment, date, actual / 1e6 AS actual FROM panel) SELECT segment, date, round(actual, 6) AS actual, round(skewness(actual) {_rows(6)}, 4) AS actual_rolling_skew_6, round(kurtosis(actual) {_rows(6)}, 4) AS actual_rolling_kurt_6 FROM t"
)
def rolling_shape(spark: SparkSession, d: str) -> DataFrame:
    made = Rolling("actual", [6], ["skew", "kurt"], **_ORDER).fit_transform(panel(spark, d).withColumn("actual", F.col("actual") / 1e6))
    return made.select(
        "segment", "date", F.round("actual", 6).alias("actual"),
        *(F.round(c, 4).alias(c) for c in ("actual_rolling_skew_6", "actual_rolling_kurt_6")),
    )


@query(
    f"WITH {PANEL}, t AS (SELECT segment, date, round(actual / 1e6, 1) AS actual FROM panel) SELECT segment, date, actual, first_value(actual) {_rows(4)} AS actual_rolling_first_4, last_value(actual) {_rows(4)} AS actual_rolling_last_4, (count(DISTINCT actual) {_rows(4)})::DOUBLE AS actual_rolling_nunique_4, round(product(actual) {_rows(4)}, 4) AS actual_rolling_prod_4 FROM t"
)
def rolling_others(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        Rolling("actual", [4], ["first", "last", "nunique", "prod"], **_ORDER).fit_transform(
            panel(spark, d).withColumn("actual", F.round(F.col("actual") / 1e6, 1))
        ),
        4,
    )


@query("""WITH s AS (SELECT c_mktsegment, avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS sd, quantile_cont(c_acctbal, 0.5) AS md FROM customer WHERE
    c_nationkey < 10 GROUP BY 1)
    SELECT c_custkey, c_mktsegment, c_acctbal, round(m, 4) AS c_acctbal_group_mean, round(sd, 4) AS c_acctbal_group_std, round(md, 4) AS
        c_acctbal_group_median, round((c_acctbal - m) / nullif(sd, 0), 4) AS c_acctbal_zscore
    FROM customer LEFT JOIN s USING (c_mktsegment)""")
def pipeline_on_other_rows(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of the nations below ten, fitted once, transform all customers."""
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    pipeline = FeaturePipeline().add_transformer(Statistical("c_acctbal", group_by="c_mktsegment")).fit(rows.filter("c_nationkey < 10"))
    return rounded(pipeline.transform(rows).drop("c_nationkey"), 4)


@query(f"""WITH {PANEL}, t AS (SELECT *, lag(actual, 1) OVER w AS l1, lag(actual, 2) OVER w AS l2 FROM panel WINDOW w AS (PARTITION BY segment ORDER BY date)),
    n AS (SELECT [count(segment), count(date), count(actual), count(l1), count(l2), count(actual)] AS n FROM t)
    SELECT unnest(['segment', 'date', 'actual', 'actual_lag_1', 'actual_lag_2', 'actual_rolling_mean_3']) AS name, unnest([false, false, false,
    true, true, true]) AS made, unnest(n) AS filled, 2 AS transformers, 'Lag,Rolling' AS names, true AS enabled FROM n""")
def feature_names(spark: SparkSession, d: str) -> DataFrame:
    """The columns that a pipeline makes, and in how many rows each has a value."""
    rows = panel(spark, d)
    pipeline = FeaturePipeline([Lag("actual", [1, 2]), Rolling("actual", [3])]).fit(rows, "segment", "date")
    info, made = pipeline.get_feature_importance_info(), pipeline.get_feature_names(rows)
    listed = F.array(*(F.struct(F.lit(c).alias("name"), F.lit(c not in rows.columns).alias("made"), F.count(c).alias("filled")) for c in made))
    return pipeline.transform(rows).agg(listed.alias("x")).select(F.explode("x").alias("x")).select(
        "x.*", F.lit(info["transformer_count"]).alias("transformers"), F.lit(",".join(info["transformer_names"])).alias("names"),
        F.lit(info["enabled"]).alias("enabled"),
    )


@query("""SELECT how, key, CASE key WHEN 'nation' THEN count(DISTINCT c_nationkey) WHEN 'Roll Up Shop' THEN count(DISTINCT c_mktsegment) ELSE 0 END AS groups,
    count(*) AS n FROM customer, (VALUES ('given', 'nation'), ('segment', 'Roll Up Shop'), ('key', 'nation'), ('none', NULL), ('absent', 'error')) t(how, key) GROUP BY how, key""")
def group_keys(spark: SparkSession, d: str) -> DataFrame:
    """The group column that each way of asking finds among the customers' columns, and how many groups it makes."""
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("Roll Up Shop"))
    found = [
        ("given", group_key(rows.columns, "nation")), ("segment", group_key(rows.columns, None, "rollup_shop", ["nation"])),
        ("key", group_key(rows.columns, None, None, ["nation"])), ("none", group_key(rows.columns)),
    ]
    try:
        found.append(("absent", group_key(rows.columns, "c")))
    except ValueError:
        found.append(("absent", "error"))
    groups = lambda key: F.count_distinct(F.col(f"`{key}`")) if key in rows.columns else F.lit(0).cast("long")
    listed = [
        F.struct(F.lit(how).alias("how"), F.lit(key).cast("string").alias("key"), groups(key).alias("groups"), F.count(F.lit(1)).alias("n")) for how, key in found
    ]
    return rows.agg(F.array(*listed).alias("x")).select(F.explode("x").alias("x")).select("x.*")


@query("""WITH t AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders), x AS (SELECT d, month(d) AS m, year(d) AS y FROM t),
    fixed(fm, fd, since) AS (VALUES (1, 1, 1), (6, 19, 2021), (7, 4, 1), (11, 11, 1), (12, 25, 1)),
    f AS (SELECT d, sum(CASE isodow(make_date(y, fm, fd)) WHEN 7 THEN 2 WHEN 6 THEN CASE WHEN fm = 1 THEN 1 ELSE 2 END ELSE 1 END) FILTER (y >= since)
        AS n FROM x JOIN fixed ON fm = m GROUP BY d)
    SELECT d, (coalesce(n, 0) + CASE WHEN m IN (1, 2, 5, 9, 10, 11) THEN 1 ELSE 0 END + CASE WHEN m = 12 AND isodow(make_date(y + 1, 1, 1)) = 6 THEN 1
        ELSE 0 END)::INTEGER AS holidays FROM x LEFT JOIN f USING (d)""")
def federal_holidays(spark: SparkSession, d: str) -> DataFrame:
    return Calendar("d", "federal").fit_transform(_dates(spark, d)).select("d", F.col("d_holidays").alias("holidays"))


@query(f"""WITH {MONTHLY}, o AS (SELECT min(date) AS o FROM monthly) SELECT date, actual, year(date)::INTEGER AS date_year, month(date)::INTEGER AS
    date_month, round(sin(2 * pi() * month(date) / 12), 6) + 0.0 AS date_month_sin,
    round(cos(2 * pi() * month(date) / 12), 6) + 0.0 AS date_month_cos, (date - o)::INTEGER AS date_time_index FROM monthly, o""")
def model_date_features(spark: SparkSession, d: str) -> DataFrame:
    return rounded(date_features(monthly(spark, d), "date"))


# ---------------------------------------------------------------- preparation, rules, accuracy


@query("SELECT DISTINCT o_orderdate::DATE AS d, date_trunc('month', o_orderdate)::DATE AS period FROM orders")
def year_period_strict(spark: SparkSession, d: str) -> DataFrame:
    return _dates(spark, d).select("d", year_period(F.date_format("d", "yyyy'0'MM"), strict=True).alias("period"))


@query(f"""WITH {MONTHLY}, h AS (SELECT date, CASE WHEN month(date) = 5 THEN NULL ELSE actual / 1e6 END AS y FROM monthly), f AS (SELECT date,
    coalesce(last_value(y IGNORE NULLS) OVER (ORDER BY date), 0) AS y FROM h),
    q AS (SELECT quantile_cont(y, 0.25) AS a, quantile_cont(y, 0.75) AS b FROM f) SELECT date, round(ln(1 + greatest(least(y, b + 0.5 * (b - a)), a -
        0.5 * (b - a))), 6) AS y FROM f, q""")
def prepared_series(spark: SparkSession, d: str) -> DataFrame:
    """Fiscal codes read, holes filled, outliers clipped, in logs."""
    rows = monthly(spark, d).select(
        F.date_format("date", "yyyy'0'MM").alias("date"),
        F.when(F.month("date") != 5, F.col("actual") / 1e6).alias("y"),
    )
    return rounded(prepare(rows, "date", "y", date_format="year_period", outliers={"method": "iqr", "factor": 0.5}, log=True)[0])


@query(
    "SELECT 'positive' AS rule_name, 'positive_value' AS rule_type, false AS passed FROM (SELECT min(c_acctbal) AS m FROM customer) WHERE m < 0 UNION ALL SELECT 'gone', 'date_range', false"
)
def failed_rules(spark: SparkSession, d: str) -> DataFrame:
    checks = quality.Validator(
        [quality.NullRule("nulls", ["c_name"]), quality.PositiveRule("positive", "c_acctbal"), quality.DateRangeRule("gone", "absent")]
    )
    report = checks.validate(table(spark, d, "customer"))
    return quality.report_frame(spark, {"results": quality.Validator.get_failed_validations(report)}).drop("details")


@query(f"""WITH {_PAIRS.replace("WHERE p IS NOT NULL", "WHERE p IS NOT NULL AND month(date) NOT IN (3, 7)")}
    SELECT round(avg(abs(actual - p)) / 1e3, 4) AS mae, round(avg(p - actual) / 1e3, 4) AS bias, round(sum(abs(actual - p)) / sum(abs(actual)) * 100,
        4) AS wape, round(avg(abs(actual - p)) / avg(abs(actual - CASE WHEN n > 12 THEN s ELSE l END)), 4) AS mase FROM c""")
def accuracy_without_nan(spark: SparkSession, d: str) -> DataFrame:
    """NaN predictions in March and infinite ones in July don't count."""
    rows = _pairs(spark, d).withColumn(
        "p", F.when(F.month("date") == 3, float("nan")).when(F.month("date") == 7, float("inf")).otherwise(F.col("p")),
    )
    found = accuracy(rows.filter("p is not null"), "actual", "p", "date")
    return rounded(found.select((F.col("mae") / 1e3).alias("mae"), (F.col("bias") / 1e3).alias("bias"), "wape", "mase"), 4)


@query(f"""WITH {PANEL}, c AS (SELECT *, lag(actual, 12) OVER (PARTITION BY segment ORDER BY date) AS p FROM panel), x AS (SELECT *, lag(actual, 12)
    OVER (PARTITION BY segment ORDER BY date) AS s, count(*) OVER (PARTITION BY segment) AS n FROM c WHERE p IS NOT NULL)
    SELECT segment, round(avg(abs(actual - p)) / 1e3, 4) AS mae, round(avg(abs(actual - p)) / avg(abs(actual - s)), 4) AS mase, round(sum(p - actual)
        / avg(abs(actual - p)), 4) AS tracking_signal FROM x GROUP BY segment HAVING any_value(n) > 12""")
def accuracy_by_segment(spark: SparkSession, d: str) -> DataFrame:
    rows = Lag("actual", [12], **_ORDER).fit_transform(panel(spark, d))
    found = accuracy(rows, "actual", "actual_lag_12", "date", "segment")
    return rounded(found.select("segment", (F.col("mae") / 1e3).alias("mae"), "mase", "tracking_signal"), 4)


_KNOWN = ("bayesian_ridge", "catboost", "elastic_net", "gbt", "lasso", "lightgbm", "linear", "random_forest", "ridge", "xgboost")  # others may register more


@query(f"WITH {MONTHLY} SELECT model, count(*) AS n, true AS whole FROM monthly, (SELECT unnest({list(_KNOWN)}) AS model) GROUP BY model")
def model_registry(spark: SparkSession, d: str) -> DataFrame:
    """Every model of the registry, fitted to the months and asked for each of them."""
    rows = monthly(spark, d).select(F.month("date").alias("x"), (F.col("actual") / 1e6).alias("y"))
    few = {"gbt": {"n_estimators": 2}, "random_forest": {"n_estimators": 2}} | {k: {"n_estimators": 3} for k in ("xgboost", "lightgbm", "catboost")}
    found = [make_model(m, **few.get(m, {})).fit(rows, ["x"], "y").predict(rows, ["x"]).select(F.lit(m).alias("model"), "prediction") for m in available_models() if m in _KNOWN]
    sound = F.bool_and(F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("whole")
    return reduce(DataFrame.unionByName, found).groupBy("model").agg(F.count(F.lit(1)).alias("n"), sound)


@query("""SELECT path, value, count(o_orderkey) AS n FROM (SELECT unnest(['a.b', 'a.c', 'd', 'e', 'f.g']) AS path, unnest(['1', '3', 'absent', '5', '4']) AS value)
    LEFT JOIN orders ON left(o_orderpriority, 1) = value GROUP BY ALL""")
def configuration(spark: SparkSession, d: str) -> DataFrame:
    """Values from a file, set, merged and taken from the environment, and how many orders have the priority that each names; a
    missing path gives the default."""
    with tempfile.TemporaryDirectory() as folder:  # the driver's own file, read at once
        path = Path(folder, "c.yml")
        path.write_text("a:\n  b: 1\n  c: 2\nsnowflake:\n  role: '2'\n")
        os.environ["TIDEWELL_QUERY_ROLE"] = "4"
        try:
            config = ConfigManager(str(path), environment={"snowflake.role": "TIDEWELL_QUERY_ROLE"})
        finally:
            del os.environ["TIDEWELL_QUERY_ROLE"]
    config.update({"a": {"c": 3}})
    config.set("e", 5)
    config.set("f.g", config.get("snowflake.role"))
    wanted = F.array(*(F.struct(F.lit(p).alias("path"), F.lit(str(config.get(p, "absent"))).alias("value")) for p in ("a.b", "a.c", "d", "e", "f.g")))
    orders = table(spark, d, "orders").groupBy(F.substring("o_orderpriority", 1, 1).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return spark.range(1).select(F.explode(wanted).alias("x")).select("x.*").join(orders, "value", "left").select("path", "value", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


# ---------------------------------------------------------------- command line


def _cli(spark: SparkSession, config: dict, *arguments: str) -> int:
    from tidewell import cli

    with tempfile.TemporaryDirectory() as folder:  # the configuration is the driver's own file
        path = Path(folder, "c.yml")
        path.write_text(json.dumps(config))
        return cli.main([arguments[0], "--config", str(path), *arguments[1:]])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def cli_load(spark: SparkSession, d: str) -> DataFrame:
    """``load`` in delta mode, twice: the second run finds nothing and writes nothing."""
    folder = scratch(spark)
    table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").write.parquet(f"{folder}/orders.parquet")
    with tempfile.TemporaryDirectory() as own:  # the checkpoint is the driver's own file here
        config = {
            "data_source": {"table": f"{folder}/orders.parquet"},
            "delta_loading": {"checkpoint_column": "o_orderkey", "checkpoint_file": str(Path(own, "c.json"))},
        }
        assert _cli(spark, config, "load", "--output", f"{folder}/raw") == 0
        assert _cli(spark, config, "load", "--output", f"{folder}/none") == 0
    return read_csv(spark, f"{folder}/raw", "o_orderkey long, o_custkey long, o_totalprice double", multi_line=False)


@query(
    f"WITH {PANEL} SELECT segment, date, actual, lag(actual, 1) OVER w AS actual_lag_1, round(avg(actual) OVER (w ROWS 2 PRECEDING), 4) AS actual_rolling_mean_3 FROM panel WINDOW w AS (PARTITION BY segment ORDER BY date)"
)
def cli_features(spark: SparkSession, d: str) -> DataFrame:
    folder = scratch(spark)
    panel(spark, d).write.parquet(f"{folder}/panel.parquet")
    config = {
        "data_source": {"date_column": "date"}, "feature_engineering": {
            "features": [{"type": "lag", "columns": ["actual"]}, {"type": "rolling_mean", "column": "actual"}]
        },
        "validation": {"rules": [{"type": "positive", "name": "p", "column": "actual"}]},
    }
    assert _cli(
        spark, config, "features", "--input", f"{folder}/panel.parquet", "--output", f"{folder}/out", "--group-by",
        "segment", "--fail-on-validation",
    ) == 0
    return rounded(
        read_csv(
            spark, f"{folder}/out",
            "segment string, date date, actual double, actual_lag_1 double, actual_rolling_mean_3 double",
            multi_line=False,
        ),
        4,
    )


@query(f"WITH {PANEL} SELECT segment, count(*) AS months FROM panel GROUP BY 1")
def segment_counts(spark: SparkSession, d: str) -> DataFrame:
    return panel(spark, d).groupBy("segment").agg(F.count(F.lit(1)).alias("months"))


@query("""WITH e AS (SELECT event_type, (ts::DATE - ((isodow(ts) % 7))::INTEGER)::DATE AS week_start, value FROM events WHERE ts IS NOT NULL AND
    event_type IS NOT NULL)
    SELECT event_type, week_start, (week_start + 6)::DATE AS week_end, round(coalesce(sum(value), 0), 2) AS value FROM e GROUP BY ALL""")
def weekly_totals_segmented_sun(spark: SparkSession, d: str) -> DataFrame:
    return rounded(daily_to_weekly(table(spark, d, "events"), "ts", "value", "Sun", ["event_type"]), 2)
