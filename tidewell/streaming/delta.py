"""The incremental scan as a stream: new files of a folder, each exactly once, then stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def load_new_files(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: StructType,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Append what came to ``source`` since the last run to ``target``; the checkpoint folder remembers what was read."""
    rows = spark.readStream.schema(schema).parquet(source)
    out = transform(rows) if transform else rows
    query = out.writeStream.format("parquet").option("path", target).option(
        "checkpointLocation", checkpoint,
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def daily_totals_stream(rows: DataFrame, time_column: str, amount_column: str, late: str = "3 days") -> DataFrame:
    """Totals by day of a stream; a day is final once the watermark (late postings) has passed it.

    Days are those of the clock that the times show, whatever the session's time zone: windows begin at UTC's midnight,
    so the times are read as UTC's.
    """
    t = F.col(time_column).cast("timestamp_ntz")
    parts = (F.year(t), F.month(t), F.day(t), F.hour(t), F.minute(t), F.expr(f"extract(second from cast(`{time_column}` as timestamp_ntz))"))
    marked = rows.select(F.when(t.isNotNull(), F.make_timestamp(*parts, F.lit("UTC"))).alias("__t"), F.col(amount_column).alias("__v")).withWatermark("__t", late)
    totals = marked.groupBy(F.window("__t", "1 day").alias("w")).agg(F.sum("__v").alias("actual"))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_seconds("w.start") / 86400).cast("int"))
    return totals.select(day.alias("date"), "actual")
