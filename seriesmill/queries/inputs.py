"""The given tables seen as time series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions.timeframe import bucket_start
from seriesmill.operators.align import whole_second
from seriesmill.operators.bars import bars_from_events
from seriesmill.schemas import utc
from seriesmill.session import prepare

# 2024-01-31T00:00:00Z, the fixed "now" of every query.
NOW_MS = 1_706_659_200_000
FEEDS = ["click", "error", "purchase", "signup", "view"]
ALL_FEEDS = [*FEEDS, "funding"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, time, seq, feed, value, props): one series per user."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id")).alias("symbol"),
        utc("ts").alias("time"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("feed"),
        "value",
        "props",
    )


def rounded_volume(bars: DataFrame) -> DataFrame:
    """Sums of doubles differ in their last digits with the order of adding; queries show six."""
    return bars.withColumn("volume", F.round("volume", 6))


def event_bars(spark: SparkSession, sf_dir: str, timeframe: str) -> DataFrame:
    return rounded_volume(bars_from_events(event_rows(spark, sf_dir), ["symbol"], timeframe))


def hourly(rows: DataFrame) -> DataFrame:
    """Times cut down to the hour, so that keys repeat."""
    return rows.withColumn(
        "time", F.timestamp_millis(bucket_start(F.unix_millis("time"), "1h"))
    )


def prop_k(column: str = "props"):
    return F.get_json_object(column, "$.k")


def feed_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six feeds in long form: five hourly ones, and funding at whole seconds."""
    rows = event_rows(spark, sf_dir)
    kinds = F.array(
        F.struct(
            F.timestamp_millis(bucket_start(F.unix_millis("time"), "1h")).alias("time"),
            F.col("feed").alias("feed"),
            F.col("value").alias("value"),
        ),
        F.struct(
            whole_second(F.col("time")).alias("time"),
            F.when(F.col("feed") == "purchase", F.lit("funding")).alias("feed"),
            prop_k().cast("double").alias("value"),
        ),
    )
    return (
        rows.select("symbol", "seq", F.inline(kinds))
        .filter(F.col("feed").isNotNull())
        .select("symbol", "time", "feed", "value", "seq")
    )


def as_table(rows: DataFrame, source: str, timeframe: str) -> DataFrame:
    """Rows with the keys of the series table."""
    return rows.withColumn("source", F.lit(source)).withColumn("timeframe", F.lit(timeframe))
