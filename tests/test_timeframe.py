from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from seriesmill.functions import timeframe as tf

HOUR, DAY = 3_600_000, 86_400_000


def ms(*parts):
    return int(datetime(*parts, tzinfo=UTC).timestamp() * 1000)


MINUTES = {
    "1m": 1, "3m": 3, "5m": 5, "15m": 15, "30m": 30, "1h": 60, "2h": 120, "4h": 240,
    "6h": 360, "8h": 480, "12h": 720, "1d": 1440, "3d": 4320, "1w": 10080, "1M": 43200,
    "1y": 525600, "2M": 2, "5mins": 5, "15": 15, "1ms": 1, "2 h": None, "3HOURS": 180,
    "2weeks": 20160, "1month": 43200, "2Y": 1051200, "10minute": 10, "30s": None,
    "invalid": None, "": None, "+7": 7, "-5": -5, "1_000": 1000, "0": 0, "1minutess": None,
}


def test_minutes_of_literals():
    for text, expected in MINUTES.items():
        if expected is None:
            with pytest.raises(ValueError):
                tf.minutes_of(text)
        else:
            assert tf.minutes_of(text) == expected, text


def test_minutes_of_columns(spark):
    df = spark.createDataFrame([(t,) for t in MINUTES], "t STRING")
    rows = df.select("t", tf.tf_minutes(F.col("t")).alias("m"), tf.tf_ms(F.col("t")).alias("ms"))
    for row in rows.collect():
        assert row.m == MINUTES[row.t], row.t
        assert row.ms == (None if row.m is None else row.m * 60_000)


def evaluate(spark, value, *expressions):
    df = spark.createDataFrame([(value,)], "ms BIGINT").withColumn("one", F.lit(1))
    return tuple(df.select(*expressions).first())


def test_rounding(spark):
    t = F.col("ms")
    assert evaluate(
        spark, 1640995500000, tf.round_down(t, "1h"), tf.round_up(t, "1h")
    ) == (1640995200000, 1640998800000)
    # A boundary rounds up to the next one.
    assert evaluate(spark, 1640995200000, tf.round_up(t, "1h")) == (1640998800000,)


def test_alignment(spark):
    t = F.col("ms")
    assert evaluate(
        spark, 1640995200000, tf.align(t, "1d", "prev"), tf.align(t, "1d", "next")
    ) == (1640908800000, 1640995200000)
    assert evaluate(
        spark, 1640995200001, tf.align(t, "1d", "prev"), tf.align(t, "1d", "next")
    ) == (1640995200000, 1640995200000 + DAY)
    assert evaluate(spark, 0, tf.align(t, "1d", "prev"), tf.align(t, "1d", "next")) == (0, 0)
    assert evaluate(spark, 77, tf.align(t, "nonsense", "prev")) == (77,)
    assert evaluate(spark, 77, tf.align(t, F.lit("nonsense"), "next")) == (77,)
    with pytest.raises(ValueError):
        tf.align(t, "1d", "up")


def test_weeks_start_on_monday_only_as_1w(spark):
    t = F.col("ms")
    at = ms(2024, 1, 3, 5)
    frames = [F.lit("1w"), "1w", "7d", "1W", "2w"]
    got = evaluate(spark, at, *[tf.bucket_start(t, f) for f in frames])
    monday, thursday = ms(2024, 1, 1), ms(2023, 12, 28)
    assert got[:4] == (monday, monday, thursday, thursday)
    assert evaluate(spark, at, tf.bucket_end(t, "1w"), tf.round_down(t, "1w")) == (
        ms(2024, 1, 8), thursday
    )


@pytest.mark.parametrize("frame", ["1h", "4h", "1d", "1w", "7d"])
def test_bucket_holds_its_time(spark, frame):
    base = ms(2023, 12, 25)
    values = [base + d * DAY + e for d in range(10) for e in (-1, 0, 1, 5 * HOUR)]
    df = spark.createDataFrame([(v, frame) for v in values], "ms BIGINT, tf STRING")
    t, column = F.col("ms"), F.col("tf")
    rows = df.select(
        t,
        tf.bucket_start(t, frame).alias("a"), tf.bucket_end(t, frame).alias("b"),
        tf.bucket_start(t, column).alias("ca"), tf.bucket_end(t, column).alias("cb"),
    ).collect()
    for row in rows:
        assert row.a <= row.ms < row.b
        assert (row.a, row.b) == (row.ca, row.cb)
        assert row.b - row.a == tf.milliseconds_of(frame)


def test_near_boundary(spark):
    t = F.col("ms")
    end = ms(2024, 1, 1, 4)
    assert evaluate(
        spark, end - 5000, tf.near_end(t, "4h", 5), tf.near_end(t, "4h", 4),
        tf.near_start(t, "4h", 5),
    ) == (True, False, False)
    assert evaluate(spark, end + 5000, tf.near_start(t, "4h", 5), tf.near_start(t, "4h", 4)) == (
        True, False
    )


def test_zero_means_open(spark):
    df = spark.createDataFrame([(0,), (None,), (1000,)], "ms BIGINT")
    got = [r[0] for r in df.select(tf.to_time(F.col("ms"))).collect()]
    assert got[:2] == [None, None] and got[2] is not None


def test_non_positive_frames_give_null(spark):
    df = spark.createDataFrame([("0",), ("-5",)], "tf STRING").withColumn("ms", F.lit(10**12))
    rows = df.select(tf.bucket_start(F.col("ms"), F.col("tf")).alias("a")).collect()
    assert [r.a for r in rows] == [None, None]
