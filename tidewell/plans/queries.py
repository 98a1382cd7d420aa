"""The registered queries of the series engine, each with SQL that says the same.

Money is rounded to cents after it is summed and ratios to six digits, in both, so that the order of a sum can't show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.config import ConfigManager
from tidewell.functions.dates import year_period
from tidewell.operators import quality
from tidewell.operators.allocation import AllocationConfig, DailyAllocator, daily_weights, expected_share, month_history, month_total_final, raw_scores, shape_table
from tidewell.operators.features import Calendar, FeaturePipeline, Growth, Lag, Rolling, Seasonal, Statistical
from tidewell.operators.metrics import accuracy, horizon_errors
from tidewell.operators.series import LogTransform, build_daily_totals, daily_to_monthly, daily_to_weekly, fill_target, handle_outliers, split_by_months, split_by_ratio, sum_by_date
from tidewell.plans.forecaster import fold_forecast
from tidewell.plans.models import Linear
from tidewell.scratch import scratch
from tidewell.ship import ship
from tidewell.sources.io import Checkpoint, Loader

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

AS_OF, HORIZON = "2000-09-12", 5


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in df.schema))


def cents(column: str, name: str) -> F.Column:
    return F.round(F.sum(column), 2).alias(name)


def panel(spark: SparkSession, d: str) -> DataFrame:
    """(segment, date, actual): orders by market segment and month."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    joined = o.select("o_custkey", F.trunc("o_orderdate", "MM").alias("date"), "o_totalprice").join(
        c.select("c_custkey", F.col("c_mktsegment").alias("segment")), F.col("o_custkey") == F.col("c_custkey"),
    )
    return joined.groupBy("segment", "date").agg(cents("o_totalprice", "actual"))


PANEL = """panel AS (SELECT c_mktsegment AS segment, date_trunc('month', o_orderdate)::DATE AS date, round(sum(o_totalprice), 2) AS actual FROM orders
    JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


def monthly(spark: SparkSession, d: str) -> DataFrame:
    """(date, actual): orders by month."""
    return table(spark, d, "orders").groupBy(F.trunc("o_orderdate", "MM").alias("date")).agg(cents("o_totalprice", "actual"))


MONTHLY = "monthly AS (SELECT date_trunc('month', o_orderdate)::DATE AS date, round(sum(o_totalprice), 2) AS actual FROM orders GROUP BY ALL)"


def daily(spark: SparkSession, d: str) -> DataFrame:
    """(date, actual): revenue by day of shipping."""
    return table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("actual")
    )


DAILY = "daily AS (SELECT l_shipdate::DATE AS date, round(sum(l_extendedprice), 2) AS actual FROM lineitem GROUP BY ALL)"


def naive_forecast(days: DataFrame) -> DataFrame:
    """(month_start, forecast_total): the total of twelve months before."""
    return daily_to_monthly(days).select(
        F.add_months("month_start", 12).alias("month_start"), F.round("actual_month_total", 2).alias("forecast_total"),
    )


NAIVE = """naive AS (SELECT (date_trunc('month', date) + INTERVAL 12 MONTH)::DATE AS month_start, round(sum(actual), 2) AS forecast_total FROM daily
    GROUP BY ALL)"""

# ---------------------------------------------------------------- roll-ups


@query(
    "SELECT o_orderdate::DATE AS date, round(sum(o_totalprice), 2) AS actual FROM orders WHERE o_orderstatus = 'F' AND o_orderdate IS NOT NULL GROUP BY ALL"
)
def daily_totals(spark: SparkSession, d: str) -> DataFrame:
    return rounded(build_daily_totals(table(spark, d, "orders"), "o_orderdate", "o_totalprice", "o_orderstatus", "F"), 2)


@query(
    "SELECT date_trunc('month', o_orderdate)::DATE AS month_start, round(sum(o_totalprice), 2) AS actual_month_total FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL"
)
def monthly_totals(spark: SparkSession, d: str) -> DataFrame:
    return rounded(daily_to_monthly(build_daily_totals(table(spark, d, "orders"), "o_orderdate", "o_totalprice", "o_orderstatus", "F")), 2)


def _weekly_sql(first: int) -> str:
    return f"""WITH w AS (SELECT (o_orderdate::DATE - ((isodow(o_orderdate) - 1 - {first} + 7) % 7)::INTEGER)::DATE AS week_start, sum(o_totalprice)
        AS v FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL),
        s AS (SELECT unnest(generate_series((SELECT min(week_start) FROM w)::TIMESTAMP, (SELECT max(week_start) FROM w)::TIMESTAMP, INTERVAL 7
            DAY))::DATE AS week_start)
        SELECT week_start, (week_start + 6)::DATE AS week_end, round(coalesce(v, 0), 2) AS y_pred FROM s LEFT JOIN w USING (week_start)"""


def _order_days(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("y_pred"))


@query(_weekly_sql(0))
def weekly_totals_mon(spark: SparkSession, d: str) -> DataFrame:
    return rounded(daily_to_weekly(_order_days(spark, d)), 2)


@query(_weekly_sql(6))
def weekly_totals_sun(spark: SparkSession, d: str) -> DataFrame:
    return rounded(daily_to_weekly(_order_days(spark, d), week_first="Sun"), 2)


@query("""SELECT event_type, (ts::DATE - (isodow(ts) - 1)::INTEGER)::DATE AS week_start, (ts::DATE - (isodow(ts) - 1)::INTEGER + 6)::DATE AS week_end,
    round(coalesce(sum(value), 0), 2) AS value
    FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL GROUP BY ALL""")
def weekly_totals_segmented(spark: SparkSession, d: str) -> DataFrame:
    return rounded(daily_to_weekly(table(spark, d, "events"), "ts", "value", segment_columns=["event_type"]), 2)


@query(f"WITH {PANEL} SELECT date, round(sum(actual), 2) AS actual FROM panel GROUP BY ALL")
def panel_sum(spark: SparkSession, d: str) -> DataFrame:
    return rounded(sum_by_date(panel(spark, d), "date", "segment"), 2)


# ---------------------------------------------------------------- features

_W = "OVER (PARTITION BY segment ORDER BY date)"


def _rows(n: int) -> str:
    return f"OVER (PARTITION BY segment ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


_ORDER = {"group_by": "segment", "order_by": "date"}


@query(
    f"WITH {PANEL} SELECT segment, date, actual, lag(actual, 1) {_W} AS actual_lag_1, lag(actual, 3) {_W} AS actual_lag_3, lag(actual, 12) {_W} AS actual_lag_12 FROM panel"
)
def lag_features(spark: SparkSession, d: str) -> DataFrame:
    return Lag("actual", [1, 3, 12], **_ORDER).fit_transform(panel(spark, d))


_AGGREGATES = {
    "mean": "avg(actual)", "sum": "sum(actual)", "min": "min(actual)", "max": "max(actual)",
    "std": "stddev_samp(actual)", "var": "var_samp(actual / 1000)", "count": "count(actual)",
}


@query("WITH " + PANEL + " SELECT segment, date, actual, " + ", ".join(f"round({x} {_rows(w)}, 4) AS actual_rolling_{a}_{w}" if a != "count" else f"({x} {_rows(w)})::DOUBLE AS actual_rolling_{a}_{w}" for w in (3, 6) for a, x in _AGGREGATES.items() if a != "var") + " FROM panel")
def rolling_features(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Rolling("actual", [3, 6], ["mean", "sum", "min", "max", "std", "count"], **_ORDER).fit_transform(panel(spark, d)), 4)


@query(
    f"WITH {PANEL} SELECT segment, date, actual, round(quantile_cont(actual, 0.5) {_rows(3)}, 4) AS actual_rolling_median_3, round(quantile_cont(actual, 0.5) {_rows(4)}, 4) AS actual_rolling_median_4 FROM panel"
)
def rolling_median(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Rolling("actual", [3, 4], ["median"], **_ORDER).fit_transform(panel(spark, d)), 4)


@query(f"""WITH {PANEL}, s AS (SELECT segment, date, actual, sum((actual - m) / 1e6) {_rows(6)} AS unused, var_samp(actual / 1e6) {_rows(6)} AS v,
    stddev_samp(actual / 1e6) {_rows(6)} AS sd, count(actual) {_rows(6)} AS n
        FROM panel, (SELECT avg(actual) AS m FROM panel))
    SELECT segment, date, round(actual / 1e6, 6) AS actual, round(v, 6) AS actual_rolling_var_6, round(sd / sqrt(n), 6) AS actual_rolling_sem_6 FROM
        s""")
def rolling_spread(spark: SparkSession, d: str) -> DataFrame:
    scaled = panel(spark, d).withColumn("actual", F.col("actual") / 1e6)
    return rounded(Rolling("actual", [6], ["var", "sem"], **_ORDER).fit_transform(scaled))


_HOLES = "holes AS (SELECT segment, date, CASE WHEN month(date) = 5 THEN NULL WHEN month(date) = 8 THEN 0 ELSE actual END AS actual FROM panel)"


def holes(spark: SparkSession, d: str) -> DataFrame:
    """The panel with nulls in May and zeros in August."""
    return panel(spark, d).withColumn(
        "actual", F.when(F.month("date") == 5, None).when(F.month("date") == 8, 0.0).otherwise(F.col("actual")),
    )


@query(f"""WITH {PANEL}, {_HOLES}, f AS (SELECT *, last_value(actual IGNORE NULLS) {_rows(1000000)} AS p FROM holes)
    SELECT segment, date, actual, round(p / nullif(lag(p, 1) {_W}, 0) - 1, 6) AS actual_pct_change_1, round(actual - lag(actual, 1) {_W}, 6) AS
        actual_diff_1,
           round(p / nullif(lag(p, 12) {_W}, 0) - 1, 6) AS actual_pct_change_12, round(actual - lag(actual, 12) {_W}, 6) AS actual_diff_12 FROM f""")
def growth_features(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Growth("actual", [1, 12], **_ORDER).fit_transform(holes(spark, d)))


def _dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()


_CIRCLE = lambda x, n, s: f"round(sin(2 * pi() * {x} / {n}), 6) + 0.0 AS d_{s}_sin, round(cos(2 * pi() * {x} / {n}), 6) + 0.0 AS d_{s}_cos"


@query(f"""WITH t AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders)
    SELECT d, month(d)::INTEGER AS d_month, {_CIRCLE('month(d)', 12, 'month')}, quarter(d)::INTEGER AS d_quarter,
        {_CIRCLE('quarter(d)', 4, 'quarter')}, year(d)::INTEGER AS d_year,
           (isodow(d) - 1)::INTEGER AS d_day_of_week, {_CIRCLE('(isodow(d) - 1)', 7, 'dow')}, day(d)::INTEGER AS d_day_of_month, week(d)::INTEGER AS
               d_week_of_year FROM t""")
def seasonal_features(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        Seasonal("d", ["month", "quarter", "year", "day_of_week", "day_of_month", "week_of_year"]).fit_transform(_dates(spark, d))
    )


@query("""WITH t AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders),
    x AS (SELECT d, date_trunc('month', d)::DATE AS m0, last_day(d) AS m1, (date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS q1,
        month(d) AS m FROM t),
    b AS (SELECT x.*, (SELECT count(*) FROM generate_series(m0::TIMESTAMP, m1::TIMESTAMP, INTERVAL 1 DAY) g(v) WHERE isodow(v) < 6)::INTEGER AS b, [2,
        1, 0, 0, 1, 1, 1, 0, 1, 1, 2, 1][m] AS h FROM x)
    SELECT d, b AS d_business_days, day(m1)::INTEGER AS d_days_in_month, h AS d_holidays, greatest(b - h, 1)::INTEGER AS d_net_working_days, ((m - 1)
        % 3 + 1)::INTEGER AS d_month_in_quarter,
           (d = q1)::INTEGER AS d_is_quarter_end, (d = date_trunc('quarter', d)::DATE)::INTEGER AS d_is_quarter_start, (m = 12)::INTEGER AS
               d_is_year_end, (m = 1)::INTEGER AS d_is_year_start,
           (m IN (3, 9, 12))::INTEGER AS d_is_high_season, [0.92, 0.95, 1.12, 0.98, 0.96, 1.05, 0.97, 0.98, 1.15, 1.00, 0.95, 1.18][m]::DOUBLE AS
               d_seasonal_intensity,
           (m = 9)::INTEGER AS d_is_q3_close, (m = 3)::INTEGER AS d_is_q1_close, (q1 - d)::INTEGER AS d_days_to_quarter_end, (make_date(year(d), 12,
               31) - d)::INTEGER AS d_days_to_year_end,
           round(least(1.0::DOUBLE / (q1 - d + 1), 1.0), 6) AS d_quarter_end_urgency FROM b""")
def calendar_features(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Calendar("d").fit_transform(_dates(spark, d)))


@query("""WITH s AS (SELECT c_mktsegment, avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS sd, quantile_cont(c_acctbal, 0.5) AS md FROM customer GROUP
    BY 1)
    SELECT c_custkey, c_mktsegment, c_acctbal, round(m, 4) AS c_acctbal_group_mean, round(sd, 4) AS c_acctbal_group_std, round(md, 4) AS
        c_acctbal_group_median, round((c_acctbal - m) / nullif(sd, 0), 4) AS c_acctbal_zscore
    FROM customer LEFT JOIN s USING (c_mktsegment)""")
def statistical_grouped(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        Statistical("c_acctbal", group_by="c_mktsegment").fit_transform(
            table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
        ),
        4,
    )


@query("""WITH s AS (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS sd, quantile_cont(c_acctbal, 0.5) AS md FROM customer)
    SELECT c_custkey, c_acctbal, round(m, 4) AS c_acctbal_global_mean, round(sd, 4) AS c_acctbal_global_std, round(md, 4) AS c_acctbal_global_median,
        round((c_acctbal - m) / nullif(sd, 0), 4) AS c_acctbal_zscore FROM customer, s""")
def statistical_global(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Statistical("c_acctbal").fit_transform(table(spark, d, "customer").select("c_custkey", "c_acctbal")), 4)


@query(f"""WITH {PANEL} SELECT segment, date, actual, lag(actual, 1) {_W} AS actual_lag_1, round(avg(actual) {_rows(3)}, 4) AS actual_rolling_mean_3,
    month(date)::INTEGER AS date_month,
    round(sin(2 * pi() * month(date) / 12), 4) + 0.0 AS date_month_sin, round(cos(2 * pi() * month(date) / 12), 4) + 0.0 AS date_month_cos,
        quarter(date)::INTEGER AS date_quarter,
    round(sin(2 * pi() * quarter(date) / 4), 4) + 0.0 AS date_quarter_sin, round(cos(2 * pi() * quarter(date) / 4), 4) + 0.0 AS date_quarter_cos FROM
        panel""")
def feature_pipeline(spark: SparkSession, d: str) -> DataFrame:
    config = ConfigManager(
        values={
            "feature_engineering": {
                "features": [
                    {"type": "lag", "columns": ["actual"]}, {"type": "rolling_mean", "column": "actual"},
                    {"type": "seasonal", "date_column": "date"}, {"type": "nonsense"},
                ]
            }
        }
    )
    return rounded(FeaturePipeline.from_config(config).fit_transform(panel(spark, d), "segment", "date"), 4)


# ---------------------------------------------------------------- series


@query(
    """SELECT DISTINCT o_orderdate::DATE AS d, date_trunc('month', o_orderdate)::DATE AS slash, date_trunc('month', o_orderdate)::DATE AS dash, date_trunc('month', o_orderdate)::DATE AS seven, o_orderdate::DATE AS eight, NULL::DATE AS bad FROM orders"""
)
def year_period_parse(spark: SparkSession, d: str) -> DataFrame:
    p = lambda f: year_period(F.date_format("d", f))
    return _dates(spark, d).select(
        "d", p("yyyy/MM").alias("slash"), p("yyyy-MM").alias("dash"), p("yyyy'0'MM").alias("seven"),
        p("yyyyMMdd").alias("eight"), year_period(F.concat(F.date_format("d", "yyyy"), F.lit("013"))).alias("bad"),
    )


@query("""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b FROM lineitem)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(greatest(least(l_extendedprice, b + 0.5 * (b - a)), a - 0.5 * (b - a)), 4) AS
        l_extendedprice FROM lineitem, q""")
def outlier_iqr(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    return rounded(handle_outliers(rows, "l_extendedprice", "iqr", 0.5), 4)


@query(
    f"WITH {MONTHLY}, s AS (SELECT avg(actual) AS m, stddev_samp(actual) AS sd FROM monthly) SELECT date, round(greatest(least(actual, m + sd), m - sd), 2) AS actual FROM monthly, s"
)
def outlier_zscore(spark: SparkSession, d: str) -> DataFrame:
    return rounded(handle_outliers(monthly(spark, d), "actual", "zscore", 1.0), 2)


@query("""WITH o AS (SELECT greatest(0, CASE WHEN min(c_acctbal) <= -1 THEN -min(c_acctbal) + 1 ELSE 0 END) AS off FROM customer)
    SELECT c_custkey, round(ln(1 + c_acctbal + off), 6) AS z, round(c_acctbal, 4) AS back FROM customer, o""")
def log_transform_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    t = LogTransform.fit(rows, "c_acctbal")
    z = t.apply(F.col("c_acctbal"))
    return rows.select("c_custkey", F.round(z, 6).alias("z"), F.round(t.invert(z), 4).alias("back"))


@query(f"WITH {PANEL}, {_HOLES} SELECT segment, date, coalesce(last_value(actual IGNORE NULLS) {_rows(1000000)}, 0) AS actual FROM holes")
def ffill_target(spark: SparkSession, d: str) -> DataFrame:
    return fill_target(holes(spark, d), "actual", "date", "segment")


@query(f"""WITH {MONTHLY}, e AS (SELECT (max(date) + INTERVAL 1 MONTH)::DATE AS e FROM monthly)
    SELECT date, actual, CASE WHEN date < e - INTERVAL 18 MONTH THEN 'train' WHEN date < e - INTERVAL 12 MONTH THEN 'validation' ELSE 'test' END AS
        split FROM monthly, e""")
def split_backtest(spark: SparkSession, d: str) -> DataFrame:
    return split_by_months(monthly(spark, d), "date", 12, 6)


@query(f"""WITH {MONTHLY}, r AS (SELECT *, row_number() OVER (ORDER BY date) AS i, count(*) OVER () AS n FROM monthly)
    SELECT date, actual, CASE WHEN i <= n - floor(n * 0.2) - floor(n * 0.1) THEN 'train' WHEN i <= n - floor(n * 0.2) THEN 'validation' ELSE 'test'
        END AS split FROM r""")
def split_ratio(spark: SparkSession, d: str) -> DataFrame:
    return split_by_ratio(monthly(spark, d), "date")


# ---------------------------------------------------------------- quality


def _details(spark: SparkSession, df: DataFrame, rule: quality.Rule, *keys: str) -> DataFrame:
    r = rule.check(df)
    row = (r["rule_name"], r["rule_type"], r["passed"], *(r["details"][k] for k in keys))
    kinds = {int: "long", float: "double", bool: "boolean", str: "string"}
    return spark.createDataFrame(
        [row],
        "rule_name string, rule_type string, passed boolean, " + ", ".join(f"{k} {kinds[type(r['details'][k])]}" for k in keys),
    )


@query(
    "SELECT 'nulls' AS rule_name, 'null_check' AS rule_type, count(*) = count(nullif(o_orderpriority, '1-URGENT')) AS passed, count(*) - count(nullif(o_orderpriority, '1-URGENT')) AS p_null_count, (count(*) - count(nullif(o_orderpriority, '1-URGENT'))) / count(*) * 100 AS p_null_percentage FROM orders"
)
def quality_null(spark: SparkSession, d: str) -> DataFrame:
    return _details(
        spark, table(spark, d, "orders").select(F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("p")),
        quality.NullRule("nulls", ["p"]), "p_null_count", "p_null_percentage",
    )


@query("""SELECT 'dates' AS rule_name, 'date_range' AS rule_type, false AS passed, count(*) FILTER (o_orderdate < DATE '1996-01-01') AS
    below_min_date, count(*) FILTER (o_orderdate > DATE '2000-12-31') AS above_max_date,
    strftime(min(o_orderdate), '%Y-%m-%d') AS data_min_date, strftime(max(o_orderdate), '%Y-%m-%d') AS data_max_date FROM orders""")
def quality_date_range(spark: SparkSession, d: str) -> DataFrame:
    return _details(
        spark, table(spark, d, "orders"), quality.DateRangeRule("dates", "o_orderdate", "1996-01-01", "2000-12-31"),
        "below_min_date", "above_max_date", "data_min_date", "data_max_date",
    )


@query(
    "SELECT 'positive' AS rule_name, 'positive_value' AS rule_type, count(*) FILTER (c_acctbal < 0) = 0 AS passed, count(*) FILTER (c_acctbal < 0) AS negative_values, count(*) FILTER (c_acctbal = 0) AS zero_values, min(c_acctbal) AS min_value, max(c_acctbal) AS max_value FROM customer"
)
def quality_positive(spark: SparkSession, d: str) -> DataFrame:
    return _details(
        spark, table(spark, d, "customer"), quality.PositiveRule("positive", "c_acctbal"), "negative_values",
        "zero_values", "min_value", "max_value",
    )


@query(
    "SELECT 'duplicates' AS rule_name, 'duplicate_check' AS rule_type, count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS passed, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_count, count(*) AS total_records FROM lineitem"
)
def quality_duplicate(spark: SparkSession, d: str) -> DataFrame:
    return _details(
        spark, table(spark, d, "lineitem"), quality.DuplicateRule("duplicates", ["l_orderkey", "l_linenumber"]),
        "duplicate_count", "total_records",
    )


@query("""SELECT 'nulls' AS rule_name, 'null_check' AS rule_type, true AS passed UNION ALL SELECT 'positive', 'positive_value', count(*) FILTER
    (c_acctbal < 0) = 0 FROM customer
    UNION ALL SELECT 'unique', 'duplicate_check', count(*) = count(DISTINCT c_custkey) FROM customer UNION ALL SELECT 'some', 'custom', count(*) > 10
        FROM customer UNION ALL SELECT 'broken', 'custom', false""")
def quality_report(spark: SparkSession, d: str) -> DataFrame:
    config = ConfigManager(
        values={
            "validation": {
                "rules": [
                    {"type": "null", "name": "nulls", "columns": ["c_acctbal", "absent"]},
                    {"type": "positive", "name": "positive", "column": "c_acctbal"},
                    {"type": "duplicate", "name": "unique", "columns": ["c_custkey"]},
                ]
            }
        }
    )
    checks = quality.Validator.from_config(config).add_custom_rule("some", lambda df: df.count() > 10).add_custom_rule(
        "broken", lambda df: df.select("absent").count(),
    )
    return quality.report_frame(spark, checks.validate(table(spark, d, "customer"))).drop("details")


# ---------------------------------------------------------------- accuracy

_PAIRS = f"""{MONTHLY}, pairs AS (SELECT date, actual, lag(actual, 12) OVER (ORDER BY date) AS p FROM monthly), c AS (SELECT *, lag(actual, 12) OVER
    (ORDER BY date) AS s, lag(actual, 1) OVER (ORDER BY date) AS l, count(*) OVER () AS n FROM pairs WHERE p IS NOT NULL)"""


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return monthly(spark, d).withColumn("p", F.lag("actual", 12).over(Window.orderBy("date")))


@query(f"""WITH {_PAIRS} SELECT round(avg(abs(actual - p)) / 1e3, 4) AS mae, round(avg(power(actual - p, 2)) / 1e6, 4) AS mse,
    round(sqrt(avg(power(actual - p, 2))) / 1e3, 4) AS rmse, round(1 - sum(power(actual - p, 2)) / (var_pop(actual) * count(*)), 4) AS r2,
    round(avg(abs((actual - p) / nullif(actual, 0))) * 100, 4) AS mape, round(sum(abs(actual - p)) / sum(abs(actual)) * 100, 4) AS wape,
    round(avg(abs(actual - p)) / avg(abs(actual - CASE WHEN n > 12 THEN s ELSE l END)), 4) AS mase, round(avg(p - actual) / 1e3, 4) AS bias,
        round(sum(p - actual) / sum(abs(actual)) * 100, 4) AS bias_pct,
    round(sum(p - actual) / avg(abs(actual - p)), 4) AS tracking_signal FROM c""")
def accuracy_metrics(spark: SparkSession, d: str) -> DataFrame:
    found = accuracy(_pairs(spark, d), "actual", "p", "date")
    return rounded(found.withColumns({c: F.col(c) / 1e3 for c in ("mae", "rmse", "bias")} | {"mse": F.col("mse") / 1e6}), 4)


@query(
    f"""WITH {_PAIRS} SELECT (row_number() OVER (ORDER BY date))::INTEGER AS horizon, strftime(date, '%Y-%m') AS month, round(actual, 2) AS actual_mean, round(p, 2) AS pred_mean, round(abs(actual - p), 2) AS mae, round(abs(actual - p) / abs(actual) * 100, 2) AS wape FROM c"""
)
def horizon_error_rows(spark: SparkSession, d: str) -> DataFrame:
    return rounded(horizon_errors(_pairs(spark, d).filter("p is not null"), "date", "actual", "p"), 2)


# ---------------------------------------------------------------- incremental load


@query("""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate::DATE AS o_orderdate, 0::BIGINT AS left_over FROM orders
    WHERE o_orderdate::DATE > (SELECT max(o_orderdate)::DATE FROM orders WHERE o_orderdate < DATE '2000-07-01')""")
def delta_load(spark: SparkSession, d: str) -> DataFrame:
    """A first load of what was there in June 2000, a second one of what came since, and a third that finds nothing left."""
    orders = table(spark, d, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    checkpoint = Checkpoint(f"{scratch(spark)}/last.json", spark)
    Loader.commit(
        Loader(spark, orders.filter("o_orderdate < date'2000-07-01'")).load_delta("o_orderdate", checkpoint),
        "o_orderdate", checkpoint,
    )
    new = Loader(spark, orders).load_delta("o_orderdate", checkpoint)
    Loader.commit(new, "o_orderdate", checkpoint)
    left = Loader(spark, orders).load_delta("o_orderdate", checkpoint).count()
    return new.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", F.lit(left).cast("long").alias("left_over"))


# ---------------------------------------------------------------- allocation


def _scores_sql(years: int, months: str, least: int = 18) -> str:
    """CTEs to ``scores`` (month_start, date, score) for the months of a query."""
    return f"""{DAILY}, {NAIVE}, months AS ({months}),
    hist AS (SELECT m.month_start, h.date, h.actual, date_trunc('month', h.date) AS hm FROM months m JOIN daily h ON h.date >= m.month_start -
        INTERVAL {years} YEAR AND h.date < m.month_start),
    ok AS (SELECT month_start FROM hist GROUP BY 1 HAVING count(DISTINCT hm) >= {least}),
    sh AS (SELECT *, greatest(actual, 0) AS a, sum(greatest(actual, 0)) OVER (PARTITION BY month_start, hm) AS t FROM hist),
    shape AS (SELECT month_start, month(date) AS moy, day(date) AS dom, isodow(date) - 1 AS dow, avg(a / t) AS share FROM sh SEMI JOIN ok USING
        (month_start) WHERE t > 0 GROUP BY ALL),
    dows AS (SELECT month_start, dow, avg(share) AS share FROM shape GROUP BY ALL),
    days AS (SELECT month_start, unnest(generate_series(month_start::TIMESTAMP, last_day(month_start)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date FROM
        (SELECT DISTINCT month_start FROM months)),
    scores AS (SELECT d.month_start, d.date, greatest(coalesce(s.share, w.share, 1.0), 0) + 1e-6 AS score FROM days d
        LEFT JOIN shape s ON s.month_start = d.month_start AND s.moy = month(d.date) AND s.dom = day(d.date) AND s.dow = isodow(d.date) - 1
        LEFT JOIN dows w ON w.month_start = d.month_start AND w.dow = isodow(d.date) - 1)"""


_TARGETS = f"SELECT month_start, forecast_total FROM naive WHERE month_start >= date_trunc('month', DATE '{AS_OF}') AND month_start <= date_trunc('month', DATE '{AS_OF}') + INTERVAL {HORIZON} MONTH"


def _targets(days: DataFrame) -> DataFrame:
    start = F.trunc(F.lit(AS_OF).cast("date"), "MM")
    return naive_forecast(days).filter((F.col("month_start") >= start) & (F.col("month_start") <= F.add_months(start, HORIZON)))


@query(
    f"WITH {_scores_sql(5, _TARGETS)} SELECT month_start, moy::INTEGER AS moy, dom::INTEGER AS dom, dow::INTEGER AS dow, round(share, 8) AS share FROM shape"
)
def shape_rows(spark: SparkSession, d: str) -> DataFrame:
    days = daily(spark, d)
    return rounded(shape_table(month_history(_targets(days), days, 5), AllocationConfig(history_years=5)), 8)


@query(f"WITH {_scores_sql(5, _TARGETS)} SELECT month_start, date, round(score, 8) AS score FROM scores")
def raw_score_rows(spark: SparkSession, d: str) -> DataFrame:
    days = daily(spark, d)
    return rounded(raw_scores(_targets(days), days, AllocationConfig(history_years=5)), 8)


@query(
    f"WITH {_scores_sql(3, _TARGETS)} SELECT month_start, date, round(score, 8) AS score, round(score / sum(score) OVER (PARTITION BY month_start), 8) AS weight FROM scores"
)
def daily_weight_rows(spark: SparkSession, d: str) -> DataFrame:
    days = daily(spark, d)
    return rounded(daily_weights(_targets(days), days, AllocationConfig()), 8)


def _nowcast_sql(years: int, strategy: str) -> str:
    final = {
        "fixed": "model",
        "blend": "CASE WHEN day(aod) <= 5 OR share < 0.15 THEN model ELSE 0.7 * model + 0.3 * CASE WHEN model <> 0 THEN greatest(least(mtd / share, abs(model) * 2), -abs(model) * 2) ELSE mtd / share END END",
    }[strategy]
    effective = {"fixed": "'fixed'", "blend": "CASE WHEN day(aod) <= 5 OR share < 0.15 THEN 'fixed' ELSE 'blend' END"}[strategy]
    return f"""WITH {_scores_sql(years, _TARGETS)},
    x AS (SELECT s.*, DATE '{AS_OF}' AS aod, m.forecast_total AS model, h.actual, s.month_start = date_trunc('month', DATE '{AS_OF}')::DATE AS now,
        now AND s.date <= DATE '{AS_OF}' - 1 AS seen FROM scores s JOIN months m USING (month_start) LEFT JOIN daily h USING (date)),
    y AS (SELECT *, score / sum(score) OVER (PARTITION BY month_start) AS w_full, score / sum(score) OVER (PARTITION BY month_start, seen) AS w_part,
        sum(CASE WHEN seen THEN coalesce(actual, 0) ELSE 0 END) OVER (PARTITION BY month_start) AS mtd,
        greatest(sum(CASE WHEN seen THEN score ELSE 0 END) OVER (PARTITION BY month_start) / sum(score) OVER (PARTITION BY month_start), 0.05) AS
            share FROM x),
    z AS (SELECT *, CASE WHEN now THEN {final} ELSE model END AS final, CASE WHEN now THEN {effective} END AS effective FROM y)"""


def _predict_sql(years: int, strategy: str) -> str:
    return f"""{_nowcast_sql(years, strategy)}
    SELECT date, month_start, round(CASE WHEN seen THEN coalesce(actual, 0) WHEN now THEN actual END, 4) AS y_true, round(CASE WHEN seen THEN
        coalesce(actual, 0) ELSE (final - mtd) * w_part END, 4) AS y_pred,
        round(model * w_full, 4) AS forecast_amount, seen AS is_actual, aod AS as_of_date, round(model, 4) AS month_total_model, CASE WHEN now THEN
            '{strategy}' END AS strategy, effective AS effective_strategy,
        round(CASE WHEN now THEN share END, 4) AS expected_mtd_share, CASE WHEN now AND effective IN ('mtd_ratio', 'blend') AND model <> 0 AND abs(mtd
            / share) > abs(model) * 2 THEN 2.0::DOUBLE END AS multiplier_applied,
        (date - aod)::INTEGER AS horizon_day, datediff('month', aod, month_start)::INTEGER AS horizon_month, round(final, 4) AS month_total_final FROM
            z"""


def _allocator(days: DataFrame, **config: object) -> DailyAllocator:
    return DailyAllocator(AllocationConfig(**config)).set_daily_history(days).set_monthly_forecasts(naive_forecast(days))


@query(_predict_sql(5, "blend"))
def predict_daily(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_allocator(daily(spark, d), history_years=5, strategy="blend").predict_daily(AS_OF, HORIZON), 4)


@query(_predict_sql(3, "fixed"))
def predict_daily_defaults(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_allocator(daily(spark, d)).predict_daily(AS_OF, HORIZON), 4)


@query(f"""WITH {DAILY}, {NAIVE}, m AS (SELECT round(sum(actual), 4) AS mtd FROM daily WHERE date_trunc('month', date) = DATE '2000-09-01')
    SELECT s::DATE AS date, round(coalesce(actual, 0), 4) AS y_pred, true AS is_actual, 1.0::DOUBLE AS expected_mtd_share, round(mtd, 2) AS month_total_final
    FROM m, generate_series(DATE '2000-09-01', DATE '2000-09-30', INTERVAL 1 DAY) g(s) LEFT JOIN daily ON date = s::DATE, naive WHERE month_start = DATE '2000-09-01'""")
def predict_daily_observed(spark: SparkSession, d: str) -> DataFrame:
    """A month of which every day is known: nothing is left to forecast, and its total is what was seen."""
    found = _allocator(daily(spark, d), posting_lag_days=0, strategy="blend").predict_daily("2000-09-30", 0)
    return rounded(found.select("date", "y_pred", "is_actual", "expected_mtd_share", F.round("month_total_final", 2).alias("month_total_final")), 4)


def returned(spark: SparkSession, d: str) -> DataFrame:
    """(date, actual): the measure "returned" of shipped items; there are days without any."""
    return rounded(build_daily_totals(table(spark, d, "lineitem"), "l_shipdate", "l_extendedprice", "l_returnflag", "R"), 2)


RETURNED = DAILY.replace("GROUP BY ALL", "WHERE l_returnflag = 'R' GROUP BY ALL")


@query(_predict_sql(5, "blend").replace(DAILY, RETURNED))
def predict_daily_sparse(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_allocator(returned(spark, d), history_years=5, strategy="blend").predict_daily(AS_OF, HORIZON), 4)


@query(f"""{_nowcast_sql(5, 'blend')}, w AS (SELECT month_start, final, CASE WHEN seen THEN coalesce(actual, 0) ELSE (final - mtd) * w_part END AS y
    FROM z), t AS (SELECT month_start, max(final) AS expected, sum(y) AS total FROM w GROUP BY 1)
    SELECT month_start, round(expected, 4) AS expected, round(total, 4) AS total, round(abs(total - expected), 4) + 0.0 AS difference, abs(total -
        expected) <= 0.01 AS coherent FROM t""")
def coherence_check(spark: SparkSession, d: str) -> DataFrame:
    found = DailyAllocator.coherence(_allocator(daily(spark, d), history_years=5, strategy="blend").predict_daily(AS_OF, HORIZON))
    return rounded(found.select("month_start", "expected", "total", F.abs("difference").alias("difference"), "coherent"), 4)


@query(
    f"{_nowcast_sql(5, 'blend')}, w AS (SELECT date, CASE WHEN seen THEN coalesce(actual, 0) ELSE (final - mtd) * w_part END AS y FROM z) SELECT (date - (isodow(date) - 1)::INTEGER)::DATE AS week_start, (date - (isodow(date) - 1)::INTEGER + 6)::DATE AS week_end, round(sum(y), 4) AS y_pred FROM w GROUP BY ALL"
)
def weekly_forecast(spark: SparkSession, d: str) -> DataFrame:
    return rounded(daily_to_weekly(_allocator(daily(spark, d), history_years=5, strategy="blend").predict_daily(AS_OF, HORIZON)), 4)


_GRID = "SELECT month_start, k AS day, (0.05 * k)::DOUBLE AS share, forecast_total AS model FROM naive, generate_series(1, 20) g(k)"


def _grid(days: DataFrame) -> DataFrame:
    return naive_forecast(days).select(
        "month_start", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("day"), F.col("forecast_total").alias("model"),
    ).withColumn("share", F.lit(0.05) * F.col("day"))


@query(
    f"WITH {DAILY}, {NAIVE}, g AS ({_GRID}) SELECT month_start, day::INTEGER AS day, CASE WHEN day <= 5 OR share < 0.15 THEN 'fixed' ELSE 'blend' END AS effective FROM g"
)
def strategy_resolution(spark: SparkSession, d: str) -> DataFrame:
    return _grid(daily(spark, d)).select(
        "month_start", "day",
        AllocationConfig(strategy="blend").resolve(F.col("day"), F.col("share")).alias("effective"),
    )


@query(f"""WITH {DAILY}, {NAIVE}, g AS ({_GRID}), r AS (SELECT *, model * 0.4 AS mtd, greatest(least(model * 0.4 / share, abs(model) * 2), -abs(model)
    * 2) AS ratio FROM g)
    SELECT month_start, day::INTEGER AS day, round(model, 4) AS fixed, round(ratio, 4) AS mtd_ratio, round(0.7 * model + 0.3 * ratio, 4) AS blend FROM
        r""")
def month_total_rows(spark: SparkSession, d: str) -> DataFrame:
    cfg = AllocationConfig()
    final = lambda s: month_total_final(F.col("model") * 0.4, F.col("model"), F.col("share"), F.lit(s), cfg).alias(s)
    return rounded(_grid(daily(spark, d)).select("month_start", "day", final("fixed"), final("mtd_ratio"), final("blend")), 4)


@query(
    f"WITH {_scores_sql(5, _TARGETS)} SELECT month_start, round(greatest(sum(CASE WHEN day(date) <= 11 THEN score ELSE 0 END) / sum(score), 0.05), 6) AS share FROM scores GROUP BY 1"
)
def mtd_share(spark: SparkSession, d: str) -> DataFrame:
    days = daily(spark, d)
    sums = raw_scores(_targets(days), days, AllocationConfig(history_years=5)).groupBy("month_start").agg(
        F.sum(F.when(F.day("date") <= 11, F.col("score")).otherwise(0.0)).alias("seen"), F.sum("score").alias("all"),
    )
    return rounded(sums.select("month_start", expected_share(F.col("seen"), F.col("all"), 0.05).alias("share")))


@query(f"""WITH {_scores_sql(5, "SELECT n.month_start, n.forecast_total FROM naive n SEMI JOIN (SELECT DISTINCT date_trunc('month', date)::DATE AS month_start FROM daily) USING (month_start)")},
    x AS (SELECT s.*, k, coalesce(h.actual, 0) AS actual, s.date > s.month_start + k::INTEGER - 2 AS rest FROM scores s CROSS JOIN (SELECT unnest([5,
        10, 15, 20]) AS k) LEFT JOIN daily h USING (date)),
    y AS (SELECT *, score / sum(score) OVER (PARTITION BY month_start, k, rest) AS w FROM x),
    t AS (SELECT month_start, k, sum(CASE WHEN rest THEN 0 ELSE actual END) AS mtd, sum(CASE WHEN rest THEN actual ELSE 0 END) AS remaining,
        sum(actual) AS total, greatest(sum(CASE WHEN rest THEN 0 ELSE score END) / sum(score), 0.05) AS share FROM y GROUP BY ALL),
    r AS (SELECT t.*, s AS strategy, CASE s WHEN 'scheduled' THEN CASE WHEN k <= 5 OR share < 0.15 THEN 'fixed' ELSE 'blend' END ELSE s END AS
        effective, forecast_total AS model, greatest(least(mtd / share, abs(forecast_total) * 2), -abs(forecast_total) * 2) AS ratio
        FROM t JOIN months USING (month_start) CROSS JOIN (SELECT unnest(['fixed', 'mtd_ratio', 'blend', 'scheduled']) AS s)),
    f AS (SELECT *, CASE effective WHEN 'fixed' THEN model WHEN 'mtd_ratio' THEN ratio ELSE 0.7 * model + 0.3 * ratio END AS final FROM r)
    SELECT f.month_start, f.k::INTEGER AS as_of_day, strategy, any_value(effective) AS effective_strategy, 1 AS posting_lag_days,
        round(any_value(mtd), 4) AS mtd_actual, round(any_value(remaining), 4) AS remaining_actual, round(any_value(total), 4) AS month_actual_total,
        round(any_value(model), 4) AS month_total_model, round(any_value(final), 4) AS month_total_final, round(any_value(final - mtd), 4) AS
            remaining_forecast, round(avg(abs((final - mtd) * w - actual)), 4) AS remainder_mae,
        round(CASE WHEN sum(abs(actual)) > 0 THEN sum(abs((final - mtd) * w - actual)) / sum(abs(actual)) * 100 ELSE sum(abs((final - mtd) * w -
            actual)) END, 4) AS remainder_wape,
        round(any_value(final - total), 4) AS full_month_error, round(any_value(CASE WHEN abs(total) > 0 THEN (final - total) / abs(total) * 100 ELSE
            0 END), 4) AS full_month_error_pct
    FROM f JOIN y ON y.month_start = f.month_start AND y.k = f.k AND y.rest GROUP BY f.month_start, f.k, strategy""")
def intramonth_backtest(spark: SparkSession, d: str) -> DataFrame:
    found = _allocator(daily(spark, d), history_years=5, strategy="blend").backtest_intramonth_daily(
        strategies=["fixed", "mtd_ratio", "blend", "scheduled"]
    )
    return rounded(found, 4)


# ---------------------------------------------------------------- forecasts


@query(f"""WITH {MONTHLY}, t AS (SELECT row_number() OVER (ORDER BY date) AS x, actual / 1e6 AS y FROM monthly), m AS (SELECT avg(x) AS mx, avg(y) AS
    my FROM t),
    c AS (SELECT sum((x - mx) * (y - my)) / (sum((x - mx) * (x - mx)) + 50.0) AS b, any_value(mx) AS mx, any_value(my) AS my FROM t, m)
    SELECT x::INTEGER AS x, round(my + b * (x - mx), 4) AS prediction FROM t, c""")
def ridge_trend_forecast(spark: SparkSession, d: str) -> DataFrame:
    rows = monthly(spark, d).select(F.row_number().over(Window.orderBy("date")).alias("x"), (F.col("actual") / 1e6).alias("y"))
    return rounded(Linear("ridge", alpha=50.0).fit(rows, ["x"], "y").predict(rows, ["x"]).select("x", "prediction"), 4)


@query(f"""WITH RECURSIVE {PANEL}, h AS (SELECT segment, list(actual / 1e6 ORDER BY date) AS y, max(date) AS last FROM panel GROUP BY 1),
    f AS (SELECT segment, last, 0 AS horizon, y FROM h UNION ALL
        SELECT segment, last, horizon + 1, list_append(y, 0.5 + 0.4 * y[len(y)] + 0.3 * y[len(y) - 11] + 0.2 * (y[len(y)] + y[len(y) - 1] + y[len(y) -
            2]) / 3 + 0.1 * sin(2 * pi() * month(last + to_months(horizon + 1)) / 12)) FROM f WHERE horizon < 12)
    SELECT segment, horizon::INTEGER AS horizon, (last + to_months(horizon))::DATE AS date, round(y[len(y)], 4) AS prediction FROM f WHERE horizon >
        0""")
def recursive_forecast(spark: SparkSession, d: str) -> DataFrame:
    rows = panel(spark, d).withColumn("actual", F.col("actual") / 1e6)
    return rounded(
        fold_forecast(rows, {"lag_1": 0.4, "lag_12": 0.3, "rolling_mean_3": 0.2, "month_sin": 0.1}, 0.5, 12, "date", "actual", "segment"),
        4,
    )


from tidewell.plans import boosting_queries, engine_queries, forecast_queries  # noqa: E402, F401  they register theirs with the decorator above
