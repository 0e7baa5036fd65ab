"""Fetch plans against a simulated venue, and checks of requests."""

import pytest
from pyspark.sql import functions as F

from seriesmill.functions.timeframe import milliseconds_of
from seriesmill.plans.incremental import (
    bar_pages,
    high_water,
    incremental_plan,
    page_bars,
    window_pages,
)
from seriesmill.plans.requests import validate_requests

DAY = 86_400_000
T = 1_704_067_200_000
NOW = T + 10 * DAY
REQUEST = "symbol STRING, timeframe STRING, start_ms BIGINT, end_ms BIGINT"


def planned(spark, end_ms, max_ms, now=NOW, timeframe="1d"):
    requests = spark.createDataFrame([("x", timeframe, T - DAY, end_ms)], REQUEST)
    marks = spark.createDataFrame(
        [("x", timeframe, 0, max_ms)] if max_ms is not None else [],
        "symbol STRING, timeframe STRING, min_ms BIGINT, max_ms BIGINT",
    )
    row = incremental_plan(requests, marks, ["symbol", "timeframe"], now).first()
    return row.action, row.fetch_start_ms, row.fetch_end_ms


def test_two_frames_behind_is_not_enough(spark):
    assert planned(spark, T + 2 * DAY, T) == ("none", None, None)
    assert planned(spark, T + 2 * DAY + 1, T) == ("extend", T + DAY, T + 2 * DAY + 1)


def test_plan_without_end_runs_to_now(spark):
    assert planned(spark, None, T) == ("extend", T + DAY, NOW)
    assert planned(spark, 0, T) == ("extend", T + DAY, NOW)
    assert planned(spark, None, NOW) == ("none", None, None)


def test_nothing_stored_keeps_the_request(spark):
    assert planned(spark, T + DAY, None) == ("initial", T - DAY, T + DAY)
    assert planned(spark, None, None) == ("initial", T - DAY, None)


def test_high_water(spark):
    df = spark.createDataFrame([("a", T), ("a", T + 5), ("b", T)], "symbol STRING, ms BIGINT")
    rows = high_water(df.withColumn("time", F.timestamp_millis("ms")), ["symbol"]).collect()
    assert {(r.symbol, r.min_ms, r.max_ms) for r in rows} == {("a", T, T + 5), ("b", T, T)}


def spot_requests(start, until, step, cap):
    """Requests made to a venue that has every bar, one after the other."""
    since, made = start, []
    while True:
        limit = min((until - since) // step, cap)
        if limit <= 0:
            return made
        made.append((since, limit))
        first = -(-since // step) * step
        last = first + (limit - 1) * step
        if last + step >= until:
            return made
        since = last + 1


@pytest.mark.parametrize("cap", [1, 7, 10, 1000])
@pytest.mark.parametrize("frame", ["1h", "1d"])
def test_bar_pages_equal_one_by_one_requests(spark, cap, frame):
    step = milliseconds_of(frame)
    spans = [0, 1, step - 1, step, step + 1, 6 * step, 7 * step, 7 * step + 1, 8 * step - 1,
             20 * step, 20 * step + 5, 70 * step, 70 * step + step // 2]
    plan = spark.createDataFrame(
        [(f"s{i}", frame, T, T + span) for i, span in enumerate(spans)],
        "symbol STRING, timeframe STRING, fetch_start_ms BIGINT, fetch_end_ms BIGINT",
    )
    got = {}
    for r in bar_pages(plan, ["symbol"], cap).orderBy("symbol", "page_no").collect():
        got.setdefault(r.symbol, []).append((r.page_start_ms, r.page_limit))
    for i, span in enumerate(spans):
        assert got.get(f"s{i}", []) == spot_requests(T, T + span, step, cap), span


def window_requests(start, end, step, cap):
    at, made = start, []
    while True:
        stop = at + cap * step
        if end <= stop:
            until = end + 1000
            limit = (until - at) // step
        else:
            until, limit = stop + 1000, cap
        if limit == 0:
            return made
        made.append((at, until, min(limit, cap)))
        # Bars at, at + step, ...; the venue returns as many as asked for.
        last = at + (min(limit, cap) - 1) * step
        at = last + step
        if at >= end:
            return made


@pytest.mark.parametrize("bars", [0, 1, 5, 499, 500, 501, 1000, 1250])
def test_window_pages_equal_one_by_one_requests(spark, bars):
    step = milliseconds_of("1h")
    plan = spark.createDataFrame(
        [("x", "1h", T, T + bars * step)],
        "symbol STRING, timeframe STRING, fetch_start_ms BIGINT, fetch_end_ms BIGINT",
    )
    got = [
        (r.page_start_ms, r.page_end_ms, r.page_limit)
        for r in window_pages(plan, ["symbol"]).orderBy("page_no").collect()
    ]
    assert got == window_requests(T, T + bars * step, step, 500)


def test_very_many_pages(spark):
    plan = spark.createDataFrame(
        [("x", "1m", 0, 60_000 * 50_000)],
        "symbol STRING, timeframe STRING, fetch_start_ms BIGINT, fetch_end_ms BIGINT",
    )
    pages = bar_pages(plan, ["symbol"], 2)
    row = pages.agg(F.count("*"), F.countDistinct("page_no"), F.sum("page_limit")).first()
    assert tuple(row) == (25_000, 25_000, 50_000)


def test_page_size_by_venue(spark):
    df = spark.createDataFrame([("okx",), ("binance",)], "venue STRING")
    assert [r[0] for r in df.select(page_bars(F.col("venue"))).collect()] == [300, 1000]


def test_requests(spark):
    rows = [
        ("BTC/USDT", "1d", NOW - DAY, None),
        ("BTC/USDT", "5m", NOW - DAY, None),
        ("BTC/USDT", "1d", NOW - 31 * DAY, None),
        ("BTC/USDT", "1d", NOW - DAY, NOW - DAY),
        ("XYZ", "1d", NOW - 30 * DAY, None),
        ("bitcoin_fgi", "1h", NOW - 31 * DAY, NOW - 40 * DAY),
    ]
    universe = spark.createDataFrame([("BTCUSDT",), ("bitcoin_fgi",)], "symbol STRING")
    checked = validate_requests(spark.createDataFrame(rows, REQUEST), NOW, universe).collect()
    reasons = {(r.symbol, r.timeframe, r.start_ms, r.end_ms): r.reason for r in checked}
    assert [reasons[r] for r in rows] == [
        "",
        "timeframe not allowed",
        "start too old",
        "end not after start",
        "symbol not supported",
        "start too old; end not after start; sentiment is daily only",
    ]
    assert all(r.valid == (r.reason == "") for r in checked)


def test_sentiment_source_has_one_symbol(spark):
    df = spark.createDataFrame(
        [("sentiment", "eth", "1d", NOW - DAY, None)], "source STRING, " + REQUEST
    )
    assert validate_requests(df, NOW).first().reason == "sentiment has one symbol"
