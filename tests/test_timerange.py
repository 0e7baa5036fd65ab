from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from seriesmill.functions import timerange as tr
from seriesmill.functions.slots import in_slot

NOW = 1_706_659_200_000


def ms(*parts):
    return int(datetime(*parts, tzinfo=UTC).timestamp() * 1000)


def parsed(spark, texts, now=None):
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    rows = tr.read_ranges(df, "t", now).collect()
    assert all(r.valid or r.start_ms is None and r.end_ms is None for r in rows)
    return [(r.start_ms, r.end_ms) if r.valid else None for r in rows]


def test_ranges(spark):
    assert parsed(
        spark,
        [
            "20240101-20240131", "20240101-", "-20240131", "-",
            "20240101_101112-20240131_131415", "20240101_101112-", "-20240131_131415",
            "20240101", "", "x-y", "20241301-", "20240101-20240230", "20240101-2024013",
        ],
    ) == [
        (1704067200000, 1706745599000),
        (1704067200000, None),
        (ms(2024, 1, 1), ms(2024, 1, 31, 23, 59, 59)),
        (ms(2024, 1, 1), None),
        (ms(2024, 1, 1, 10, 11, 12), ms(2024, 1, 31, 13, 14, 15)),
        (ms(2024, 1, 1, 10, 11, 12), None),
        (ms(2024, 1, 1), ms(2024, 1, 31, 13, 14, 15)),
        None, None, None, None, None, None,
    ]


def test_cleaning(spark):
    assert parsed(
        spark, ["19980101-", "20240101-19980101", "20240201-20240101", "20990101-21000101"], NOW
    ) == [
        (1640995200000, None),
        (ms(2024, 1, 1), NOW),
        (ms(2024, 1, 1, 23, 59, 59), ms(2024, 2, 1)),
        (1640995200000, NOW),
    ]


def test_cleaning_limits_are_inside(spark):
    df = spark.createDataFrame([(10**12, 3 * 10**12)], "a BIGINT, b BIGINT")
    row = df.select(tr.clean_range(F.col("a"), F.col("b"), NOW).alias("r")).first().r
    assert (row.start_ms, row.end_ms) == (10**12, 3 * 10**12)


def test_contains(spark):
    df = spark.createDataFrame(
        [(5, 5, 5), (4, 5, 9), (10, 5, 9), (7, None, None), (7, 0, 0), (7, None, 6)],
        "t BIGINT, a BIGINT, b BIGINT",
    )
    got = [r[0] for r in df.select(tr.contains(F.col("t"), F.col("a"), F.col("b"))).collect()]
    assert got == [True, False, False, True, True, False]


def test_times(spark):
    cases = {
        "2024-01-02": ms(2024, 1, 2),
        "20240102": ms(2024, 1, 2),
        "2024-01-02T03:04:05": ms(2024, 1, 2, 3, 4, 5),
        "2024-01-02 03:04": ms(2024, 1, 2, 3, 4),
        "2024-01-02T03:04:05.678901": ms(2024, 1, 2, 3, 4, 5) + 678,
        "2024-01-02T03:04:05Z": ms(2024, 1, 2, 3, 4, 5),
        "2024-01-02T03:04:05+01:00": ms(2024, 1, 2, 2, 4, 5),
        "-2h": NOW - 7_200_000,
        "2h": NOW + 7_200_000,
        "+3d": NOW + 3 * 86_400_000,
        "-1M": NOW - 60_000,
        "1y": NOW + 365 * 86_400_000,
        "10s": NOW + 10_000,
        "1w": NOW + 7 * 86_400_000,
        "2024": None,
        "yesterday": None,
        "2024-13-01": None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t STRING")
    for row in df.select("t", tr.parse_time(F.col("t"), NOW).alias("ms")).collect():
        assert row.ms == cases[row.t], row.t


def test_epoch_numbers(spark):
    df = spark.createDataFrame([(1.7e9,), (1.7e12,)], "x DOUBLE")
    got = {r[0] for r in df.select(F.unix_millis(tr.epoch_to_time(F.col("x")))).collect()}
    assert got == {1_700_000_000_000}


def test_filter_reaches_the_scan(spark, plan_of):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    cut = events.withColumn("time", F.col("ts").cast("timestamp")).filter(
        tr.between(F.col("time"), "2024-01-05", "2024-01-06")
    )
    plan = plan_of(cut.select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


@pytest.mark.parametrize(
    "clock, expected",
    [("09:30:00", False), ("09:30:00.000001", True), ("15:59:59.999999", True),
     ("16:00:00", False)],
)
def test_daily_slot_is_strict(spark, clock, expected):
    df = spark.sql(f"SELECT TIMESTAMP '2024-03-05 {clock}' AS t")
    assert df.select(in_slot(F.col("t"), "09:30:00", "16:00:00")).first()[0] is expected


def test_hourly_slot(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-03-05 17:20:00' AS t")
    got = df.select(
        in_slot(F.col("t"), "15:00", "45:30"), in_slot(F.col("t"), "20:00", "45:30"),
        in_slot(F.col("t"), "45:30", "15:00"),
    ).first()
    assert tuple(got) == (True, False, False)


@pytest.mark.parametrize(
    "ends",
    [("0:00", "59:59"), ("00:00", "00:08:00"), ("24:00:00", "25:00:00"), ("60:00", "61:00")],
)
def test_bad_slots(ends):
    with pytest.raises(ValueError):
        in_slot(F.col("t"), *ends)


def test_whole_days(spark):
    df = spark.createDataFrame(
        [(NOW,), (NOW - 1,), (NOW - 86_400_000,), (NOW - 86_400_001,)], "ms BIGINT"
    )
    got = [r[0] for r in df.select(tr.whole_days(F.col("ms"), NOW)).collect()]
    assert got == [0, 1, 1, 2]
