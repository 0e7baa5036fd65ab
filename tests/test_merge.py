from pyspark.sql import functions as F

from seriesmill.operators import dedupe, gaps, merge, quality, read
from seriesmill.operators.bars import bars_from_events, finished_bars
from seriesmill.operators.membership import exists, rejected, supported

import pytest

SCHEMA = "symbol STRING, t BIGINT, value DOUBLE, seq BIGINT"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("time", F.timestamp_seconds("t"))


def values(df):
    return sorted((r.symbol, r.t, r.value) for r in df.collect())


def test_keep_first_and_last(spark):
    df = frame(spark, [("a", 1, 10.0, 1), ("a", 1, 11.0, 2), ("a", 2, 12.0, 3)])
    keys = ["symbol", "time"]
    assert values(dedupe.keep_first(df, keys, ["seq"])) == [("a", 1, 10.0), ("a", 2, 12.0)]
    assert values(dedupe.keep_last(df, keys, ["seq"])) == [("a", 1, 11.0), ("a", 2, 12.0)]


def test_dedupe_cuts_before_the_shuffle(spark, plan_of):
    df = frame(spark, [("a", 1, 10.0, 1)])
    plan = plan_of(dedupe.keep_first(df, ["symbol", "time"], ["seq"]))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_stored_keys_are_not_broadcast(spark, plan_of):
    """However small the stored files look, a task holds its share of their keys, not all of them."""
    stored, new = frame(spark, [("a", 1, 1.0, 1)]), frame(spark, [("a", 2, 9.0, 3)])
    plan = plan_of(merge.rows_to_add(stored, new, ["symbol", "time"], ["seq"]))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_stored_rows_win(spark):
    stored = frame(spark, [("a", 1, 1.0, 1), ("a", 2, 2.0, 2)])
    new = frame(spark, [("a", 2, 9.0, 3), ("a", 3, 3.0, 4), ("a", 3, 4.0, 5), ("b", 1, 5.0, 6)])
    merged = merge.merge_upsert(stored, new, ["symbol", "time"], ["seq"])
    assert values(merged) == [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 3.0), ("b", 1, 5.0)]
    again = merge.merge_upsert(merged.drop("is_new"), new, ["symbol", "time"], ["seq"])
    assert values(again) == values(merged)
    assert values(merge.merge_unsettled(stored, new, ["symbol", "time"], ["seq"])) == values(merged)
    summary = {r.symbol: (r.total, r.added) for r in
               merge.upsert_summary(merged, ["symbol"]).collect()}
    assert summary == {"a": (3, 1), "b": (1, 1)}


def test_unsettled_store_is_settled(spark):
    stored = frame(spark, [("a", 1, 1.0, 1), ("a", 1, 2.0, 2)])
    new = frame(spark, [("a", 1, 9.0, 0)])
    merged = merge.merge_unsettled(stored, new, ["symbol", "time"], ["seq"])
    assert values(merged) == [("a", 1, 1.0)]


def test_union_of_pages(spark):
    a = spark.createDataFrame([(1, "x")], "id INT, only_a STRING")
    b = spark.createDataFrame([(2,)], "id INT")
    assert sorted(map(tuple, merge.union_pages([a, b]).collect())) == [(1, "x"), (2, None)]


# -- bars and holes ----------------------------------------------------------
def test_bars_and_unfinished_ones(spark):
    hour = 3600
    df = frame(
        spark,
        [("a", 10, 5.0, 1), ("a", 20, 9.0, 2), ("a", 20, 1.0, 3), ("a", hour + 1, 7.25, 4)],
    )
    bars = bars_from_events(df, ["symbol"], "1h").orderBy("time").collect()
    assert [(b.open, b.high, b.low, b.close, b.volume) for b in bars] == [
        (5.0, 9.0, 1.0, 1.0, 15.0), (7.25, 7.25, 7.25, 7.25, 7.25)
    ]
    both = bars_from_events(df, ["symbol"], "1h")
    assert finished_bars(both, "1h", 7_200_001, 7_200_000).count() == 2
    assert finished_bars(both, "1h", 7_200_000, 7_200_000).count() == 1
    assert finished_bars(both, "1h", 10**10, 7_199_999).count() == 1


@pytest.mark.parametrize("limit", [None, 5])
def test_holes(spark, limit):
    present = [0, 1, 2, 5, 6, 9, 30_000]
    df = frame(spark, [("a", h * 3600, 1.0, h) for h in present] + [("b", 0, 1.0, 1)])
    holes = gaps.gap_ranges(df, ["symbol"], "1h", rows_per_task=limit).collect()
    hour = 3_600_000
    assert sorted((g.gap_start_ms // hour, g.gap_end_ms // hour, g.missing) for g in holes) == [
        (3, 4, 2), (7, 8, 2), (10, 29_999, 29_990)
    ]
    missing = gaps.missing_bars(df, ["symbol"], "1h", rows_per_task=limit)
    hours = [r.h for r in missing.select((F.unix_seconds("time") / 3600).cast("int").alias("h"))
             .orderBy("h").collect()]
    assert hours == [h for h in range(30_000) if h not in present]


# -- reads -------------------------------------------------------------------
def test_tail(spark):
    df = frame(spark, [("a", t, 1.0, t) for t in range(10)])
    assert [r.t for r in read.tail(df, 3, tie_break=["seq"]).collect()] == [7, 8, 9]
    assert read.tail(df, 0).count() == 0
    assert read.tail(df, 99).count() == 10


@pytest.mark.parametrize("n", [1, 4, 1200])
def test_tail_per_series(spark, n):
    rows = [("hot", t, 1.0, t) for t in range(3000)] + [("cold", t, 1.0, t) for t in range(3)]
    got = read.tail_per_series(frame(spark, rows), ["symbol"], n, tie_break=["seq"]).collect()
    assert sorted(r.t for r in got if r.symbol == "hot") == list(range(3000 - n, 3000))
    assert sorted(r.t for r in got if r.symbol == "cold") == list(range(3))[-n:]


def test_read_range(spark):
    df = frame(spark, [("a_b", 0, 1.0, 1), ("a_b", 60, 2.0, 2), ("c", 60, 3.0, 3)])
    df = df.withColumn("timeframe", F.lit("1h"))
    start, end = "1970-01-01 00:00:00", "1970-01-01 00:00:59"
    assert values(read.read_range(df, start=start, end=end)) == [("a_b", 0, 1.0)]
    assert values(read.read_range(df, end="1970-01-01 00:01:00", symbols=["c"])) == [
        ("c", 60, 3.0)
    ]
    assert values(read.read_range(df, dataset="a_b_1h", symbols=["c"])) == [
        ("a_b", 0, 1.0), ("a_b", 60, 2.0)
    ]
    assert values(read.read_range(df, dataset="a_b_1d")) == []
    assert read.formatted(df).first().time == "1970-01-01 00:00:00"


# -- membership and quality --------------------------------------------------
def test_membership(spark):
    df = spark.createDataFrame([("BTC/USDT",), ("XYZ",)], "symbol STRING")
    universe = spark.createDataFrame([("BTCUSDT",), ("ETHUSDT",)], "symbol STRING")
    assert [r.symbol for r in supported(df, universe).collect()] == ["BTC/USDT"]
    assert [r.symbol for r in rejected(df, universe).collect()] == ["XYZ"]
    found = exists(df, spark.createDataFrame([("XYZ",), ("XYZ",)], "symbol STRING"), ["symbol"])
    assert {(r.symbol, r.present) for r in found.collect()} == {("BTC/USDT", False), ("XYZ", True)}


@pytest.mark.parametrize("limit", [None, 3])
def test_quality(spark, limit):
    df = spark.createDataFrame(
        [("a", 1, 1.0, 1), ("a", 3, 2.0, 2), ("a", 2, 9.0, 3), ("a", 2, 1.0, 4),
         ("a", None, 1.0, 5), ("a", None, 1.0, 6), ("b", 1, 1.0, 1)],
        SCHEMA,
    ).withColumn("time", F.timestamp_seconds("t"))
    got = quality.series_quality(
        df, ["symbol"], checks={"large": F.col("value") > 5}, rows_per_task=limit
    ).collect()
    assert {
        r.symbol: (r.n_rows, r.n_null_time, r.n_duplicate_time, r.n_out_of_order, r.large)
        for r in got
    } == {"a": (6, 2, 1, 1, 1), "b": (1, 0, 0, 0, 0)}
