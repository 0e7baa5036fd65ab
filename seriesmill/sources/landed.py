"""Readers for landed source files, one declared schema per source.

Each reader is ``(spark, path) -> DataFrame`` and returns (symbol, timeframe,
columns of the source).  A folder of page files is read as one frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.fixed_values import (
    DERIVATIVES_FEEDS,
    MACRO_TIME_ZONE,
    SENTIMENT_SHIFT_SECONDS,
    SENTIMENT_SYMBOL,
    SENTIMENT_TIMEFRAME,
)
from seriesmill.operators.align import align_and_fill, long_form, whole_second
from seriesmill.plans.skew import ROWS_PER_TASK
from seriesmill.schemas import MACRO_WIRE, OHLCV, OHLCV_WIRE, SENTIMENT_WIRE, columns, utc


# -- price bars --------------------------------------------------------------
def bars_from_arrays(wire: DataFrame) -> DataFrame:
    """``data`` holding ``[time_ms, open, high, low, close, volume]`` lists as bar rows."""
    bar = F.col("_bar")
    fields = [
        F.timestamp_millis(F.get(bar, F.lit(0)).cast("bigint")).alias("time"),
        *[F.get(bar, F.lit(i)).alias(n) for i, n in enumerate(OHLCV.fieldNames()) if i],
    ]
    return wire.select("symbol", "timeframe", F.explode("data").alias("_bar")).select(
        "symbol", "timeframe", *fields
    )


def read_spot(spark: SparkSession, path: str) -> DataFrame:
    return bars_from_arrays(spark.read.schema(OHLCV_WIRE).json(path))


# -- market files ------------------------------------------------------------
def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names stripped and lower-cased."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def read_market(spark: SparkSession, path: str, timeframe: str = "1d") -> DataFrame:
    """CSV with a header in any case; the ticker is a column, not a header level."""
    raw = normalize_columns(spark.read.option("header", True).csv(path))
    # The naming of the time column differs by bar length.
    named = next(c for c in ("time", "datetime", "date") if c in raw.columns)
    return raw.select(
        F.col("symbol"),
        F.lit(timeframe).alias("timeframe"),
        utc(F.col(named).try_cast("timestamp")).alias("time"),
        *[
            F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in OHLCV.fields
            if f.name != "time"
        ],
    )


# -- macro series ------------------------------------------------------------
def central_midnight(day: Column) -> Column:
    """A calendar day as the UTC time at which it starts in the publisher's zone."""
    return F.to_utc_timestamp(day.cast("timestamp"), MACRO_TIME_ZONE)


def central_day(time: Column) -> Column:
    """The publisher's calendar day of a UTC time, as ``yyyy-MM-dd``."""
    return F.date_format(F.from_utc_timestamp(time, MACRO_TIME_ZONE), "yyyy-MM-dd")


def macro_rows(wire: DataFrame, timeframe: str = "1d") -> DataFrame:
    """(symbol, date, value) observations; the value is named ``volume``."""
    day = F.col("date").try_cast("date")
    return wire.select(
        "symbol",
        F.lit(timeframe).alias("timeframe"),
        central_midnight(day).alias("time"),
        F.col("value").alias("volume"),
    )


def read_macro(
    spark: SparkSession, path: str, start_ms: int | None = None, end_ms: int | None = None
) -> DataFrame:
    """JSON observations; the range is taken in whole calendar days of the publisher."""
    wire = spark.read.schema(MACRO_WIRE).json(path)
    if start_ms is not None:
        wire = wire.filter(F.col("date") >= central_day(F.timestamp_millis(F.lit(start_ms))))
    if end_ms is not None:
        wire = wire.filter(F.col("date") <= central_day(F.timestamp_millis(F.lit(end_ms))))
    return macro_rows(wire)


# -- sentiment index ---------------------------------------------------------
def sentiment_rows(wire: DataFrame) -> DataFrame:
    """Index records; each is stamped one day back, at the day it describes."""
    seconds = F.col("timestamp").try_cast("bigint") - SENTIMENT_SHIFT_SECONDS
    return wire.select(F.inline("data")).select(
        F.lit(SENTIMENT_SYMBOL).alias("symbol"),
        F.lit(SENTIMENT_TIMEFRAME).alias("timeframe"),
        F.timestamp_seconds(seconds).alias("time"),
        "value",
        "value_classification",
        F.col("value").try_cast("int").alias("value_int"),
    )


def read_sentiment(spark: SparkSession, path: str) -> DataFrame:
    return sentiment_rows(spark.read.schema(SENTIMENT_WIRE).json(path))


# -- derivatives feeds -------------------------------------------------------
def feed_schema(feed: str) -> T.StructType:
    """Wire schema of one feed; numbers arrive as text, times as epoch milliseconds."""
    value, time, _ = DERIVATIVES_FEEDS[feed]
    return columns(**{name: T.StringType() for name in ("symbol", value, time)})


def feed_rows(wire: DataFrame, feed: str) -> DataFrame:
    """One feed as (symbol, time, value[, seq]); funding times lose their fraction of a second."""
    value, time, _ = DERIVATIVES_FEEDS[feed]
    at = F.timestamp_millis(F.col(time).try_cast("bigint"))
    return wire.select(
        "symbol",
        (whole_second(at) if feed == "funding" else at).alias("time"),
        F.col(value).try_cast("double").alias("value"),
        *(["seq"] if "seq" in wire.columns else []),
    )


def landed_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON pages with ``seq``: their order by file name, then by position in the file.

    Pages overlap; of two rows with one key the one of the later page counts.
    """
    pages = spark.read.schema(schema).option("recursiveFileLookup", True).json(path)
    return pages.select(
        "*",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("seq"),
    )


def read_derivatives(
    spark: SparkSession,
    path: str,
    timeframe: str,
    *,
    backward: bool = True,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Six feeds, each in its own folder of JSON files, as one aligned and filled frame."""
    feeds = {
        feed: feed_rows(landed_pages(spark, f"{path}/{feed}", feed_schema(feed)), feed)
        for feed in DERIVATIVES_FEEDS
    }
    long = long_form({DERIVATIVES_FEEDS[f][2]: df for f, df in feeds.items()}, ["symbol"])
    names = [column for _, _, column in DERIVATIVES_FEEDS.values()]
    filled = align_and_fill(
        long, ["symbol"], names, backward=backward, rows_per_task=rows_per_task
    )
    return filled.select("symbol", F.lit(timeframe).alias("timeframe"), "time", *names)


# -- payloads ----------------------------------------------------------------
def explode_keyed(payload: Column, value_ddl: str, *, key: str = "key") -> list[Column]:
    """A JSON object keyed by id as generator columns (id, struct)."""
    return [
        F.explode(F.from_json(payload, f"map<string,struct<{value_ddl}>>")).alias(key, "entry")
    ]


def extract_paths(payload: Column, paths: dict[str, tuple[str, str]]) -> list[Column]:
    """``name: (JSON path, type)`` as typed columns; null where the document has no value."""
    return [
        F.get_json_object(payload, path).try_cast(kind).alias(name)
        for name, (path, kind) in paths.items()
    ]


# -- coercion on load --------------------------------------------------------
def coerce_loaded(df: DataFrame) -> DataFrame:
    """A ``timestamp`` time column becomes epoch ms, a whole-number ``value`` a double."""
    changed = {}
    for field in df.schema.fields:
        if field.name == "timestamp" and isinstance(
            field.dataType, (T.TimestampType, T.TimestampNTZType)
        ):
            changed["timestamp"] = F.unix_millis(utc("timestamp"))
        if field.name == "value" and isinstance(field.dataType, T.IntegralType):
            changed["value"] = F.col("value").cast("double")
    return df.withColumns(changed) if changed else df
