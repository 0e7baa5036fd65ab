"""Price bars: building them from single events and dropping unfinished ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.exact import exact_sum
from seriesmill.functions.timeframe import bucket_start, tf_ms


# What is added to a long so that it is not negative, and a number beyond all such sums.
_OFFSET, _BEYOND = "9223372036854775808", "20000000000000000000"


def order_key(df: DataFrame, order: list[str]) -> Column:
    """One value that sorts like the columns (time, tie break).

    A time and a whole number become one decimal, a fixed-width value that Spark
    aggregates by hash; any other tie break needs a struct, and sorting.
    """
    time, tie = order
    if not isinstance(df.schema[tie].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.struct(*order)
    micros = F.unix_micros(F.col(time).cast("timestamp")).cast("decimal(19,0)")
    offset, beyond = (F.lit(x).cast("decimal(20,0)") for x in (_OFFSET, _BEYOND))
    shifted = F.coalesce(F.col(tie).cast("decimal(20,0)") + offset, F.lit(0).cast("decimal(20,0)"))
    return (micros * beyond + shifted).cast("decimal(38,0)")


def bar_columns(value: str, at: Column, kind: T.DataType) -> list[Column]:
    """Aggregates of one bar; first and last follow ``at``, which must break ties.

    The volume is exact: doubles are added up without rounding on the way, so it does
    not depend on the order of rows, and other types are summed in their own type.
    """
    volume = exact_sum(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.sum(value).cast("double")
    return [
        F.min_by(value, at).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, at).alias("close"),
        volume.alias("volume"),
    ]


def bars_from_events(
    events: DataFrame,
    series: list[str],
    timeframe: str,
    *,
    time: str = "time",
    value: str = "value",
    tie_break: str = "seq",
) -> DataFrame:
    """Events as one open/high/low/close/volume bar per series and time frame."""
    start = F.timestamp_millis(bucket_start(F.unix_millis(time), timeframe))
    return (
        events.withColumn("_bar", start)
        .groupBy(*series, "_bar")
        .agg(*bar_columns(value, order_key(events, [time, tie_break]), events.schema[value].dataType))
        .withColumnRenamed("_bar", "time")
    )


def finished_bars(
    bars: DataFrame, timeframe: Column | str, until_ms: int, now_ms: int, *, time: str = "time"
) -> DataFrame:
    """Bars that end before ``until_ms`` and not after ``now_ms``."""
    end = F.unix_millis(time) + tf_ms(timeframe)
    return bars.filter((end < until_ms) & (end <= now_ms))
