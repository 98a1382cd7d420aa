"""Command line: load, features and forecast."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.config import ConfigManager
from tidewell.functions.dates import month_start
from tidewell.operators.allocation import AllocationConfig, DailyAllocator
from tidewell.operators.features import FeaturePipeline, col, group_key
from tidewell.operators.quality import Validator, report_frame
from tidewell.operators.series import build_daily_totals, daily_to_weekly
from tidewell.plans.forecaster import TimeSeriesForecaster
from tidewell.ship import ship
from tidewell.sources.io import Checkpoint, Loader, engineered_name, jdbc_options, quoted, read_csv, stamped, write_csv


def _session(name: str) -> SparkSession:
    spark = SparkSession.builder.appName(f"tidewell {name}").getOrCreate()
    ship(spark)
    return spark


def _read(spark: SparkSession, path: str, place: str | None = None) -> DataFrame:
    """A Parquet table or CSV files; of these the column ``place`` gets each row's number in the order of the file."""
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else read_csv(spark, path, place=place)


def load(args: argparse.Namespace) -> int:
    config = ConfigManager(args.config)
    spark = _session("load")
    name, section = str(config.get("data_source.table", "")), config.get("data_source.connection", "snowflake")
    loader = Loader(spark, spark.read.parquet(name)) if name.endswith(".parquet") else Loader(
        spark, jdbc=jdbc_options(config, section),
        name=quoted(config.get(f"{section}.database"), config.get(f"{section}.schema"), name),
    )
    if args.test_connection:
        return 0 if loader.test_connection() else 1
    column, checkpoint = config.get("delta_loading.checkpoint_column"), Checkpoint(
        config.get("delta_loading.checkpoint_file", "checkpoint.json")
    )
    rows = loader.load_delta(column, checkpoint, args.limit) if args.mode == "delta" else loader.load_data(args.limit)
    rows = rows.persist()
    n = rows.count()
    if not n:
        rows.unpersist()
        print("no new rows")
        return 0
    target = args.output or stamped(config.get("output.raw_data_file", "raw_data"), ".csv")
    write_csv(rows, target)
    if args.mode == "delta":
        Loader.commit(rows, column, checkpoint)
    rows.unpersist()
    print(f"{n} rows in {target}")
    return 0


def features(args: argparse.Namespace) -> int:
    config = ConfigManager(args.config)
    spark = _session("features")
    rows = _read(spark, args.input, config.get("data_source.file_order"))
    key = group_key(rows.columns, args.group_by, config.get("forecasting.segment_level"), config.get("data_source.key_columns", []))
    made = FeaturePipeline.from_config(config).fit_transform(rows, key)
    new = [c for c in made.columns if c not in rows.columns]
    print(f"{len(new)} new columns" + (": " + ", ".join(new) if args.show_features else ""))
    failed = False
    target = args.output or engineered_name(args.input)
    if not args.skip_validation:
        report = Validator.from_config(config).validate(made, "features")
        failed = not report["passed"]
        if report["results"]:
            report_frame(spark, report).write.mode("overwrite").json(f"{target}.report")
    write_csv(made, target)
    return int(failed and args.fail_on_validation)


def forecast(args: argparse.Namespace) -> int:
    config = ConfigManager(args.config)
    spark = _session("forecast")
    rows = _read(spark, args.input)
    date_column, target = args.date_column or config.get("data_source.date_column"), args.target_column or config.get("data_source.amount_column")
    if args.model:
        config.set("forecasting.model_type", args.model)
    key = group_key(rows.columns, args.group_by, config.get("forecasting.segment_level"), config.get("data_source.key_columns", []))
    if args.dry_run:
        print(
            f"{rows.count()} rows, {len(rows.columns)} columns, date {date_column}, target {target}, group {key}" + (
                f" ({rows.select(col(key)).distinct().count()} segments)" if key else ""
            )
        )
        return 0
    folder = args.output_dir.rstrip("/")
    model = TimeSeriesForecaster(config).fit(rows, target, date_column, key)
    ahead = model.predict(args.periods).persist()
    write_csv(ahead, f"{folder}/{stamped('forecast', '.csv')}", one_file=True)
    model.evaluate().show(truncate=False)
    if args.daily or config.get("forecasting.daily_enabled", False):
        days = build_daily_totals(rows, config.get("data_source.daily_date_column", "TS"), target)
        months = ahead.groupBy(month_start(F.col("date")).alias("month_start")).agg(F.sum("prediction").alias("forecast_total"))
        allocator = DailyAllocator(AllocationConfig.from_config(config)).set_daily_history(days).set_monthly_forecasts(months)
        daily = allocator.predict_daily(
            horizon_months=args.periods if args.periods is not None else int(config.get("forecasting.forecast_horizon", 12))
        ).persist()
        for r in DailyAllocator.coherence(daily).filter("not coherent").collect():  # a row for each month
            print(f"warning: {r.month_start} adds up to {r.total}, not {r.expected}", file=sys.stderr)
        write_csv(daily, f"{folder}/{stamped('daily_forecast', '.csv')}", one_file=True)
        write_csv(daily_to_weekly(daily), f"{folder}/{stamped('weekly_forecast', '.csv')}", one_file=True)
        daily.unpersist()
    ahead.unpersist()
    model.release()
    return 0


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidewell", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    a = sub.add_parser("load")
    a.add_argument("--config", required=True)
    a.add_argument("--mode", choices=["full", "delta"], default="delta")
    a.add_argument("--output")
    a.add_argument("--test-connection", action="store_true")
    a.add_argument("--limit", type=int)
    b = sub.add_parser("features")
    b.add_argument("--config", required=True)
    b.add_argument("--input", required=True)
    b.add_argument("--output")
    b.add_argument("--group-by")
    b.add_argument("--skip-validation", action="store_true")
    b.add_argument("--show-features", action="store_true")
    b.add_argument("--fail-on-validation", action="store_true")
    c = sub.add_parser("forecast")
    c.add_argument("--config", required=True)
    c.add_argument("--input", required=True)
    c.add_argument("--output-dir", default="output")
    c.add_argument("--model")
    c.add_argument("--periods", type=int)
    c.add_argument("--group-by")
    c.add_argument("--target-column")
    c.add_argument("--date-column")
    c.add_argument("--daily", action="store_true")
    c.add_argument("--dry-run", action="store_true")
    args = parser.parse_args(argv)
    return {"load": load, "features": features, "forecast": forecast}[args.command](args)


if __name__ == "__main__":
    sys.exit(main())
