"""Fills and previous values against plain pandas, with and without long series."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import align, ordered
from seriesmill.plans import skew

SCHEMA = "symbol STRING, t BIGINT, a DOUBLE, b STRING"


def rows(seed, n=600):
    """One symbol holds most rows; a third of values are null or NaN."""
    chosen = random.Random(seed)
    out = []
    for t in range(n):
        symbol = "hot" if chosen.random() < 0.7 else f"s{chosen.randrange(8)}"
        a = chosen.choice([None, float("nan"), round(chosen.random(), 3)])
        b = chosen.choice([None, None, f"v{t}"])
        # The hot symbol starts with a long run of missing values.
        if t < 80 or 200 < t < 400:
            a, b = None, None
        out.append((symbol, t, a, b))
    chosen.shuffle(out)
    return out


def expected_fill(data, backward):
    frame = pd.DataFrame(data, columns=["symbol", "t", "a", "b"]).sort_values(["symbol", "t"])
    grouped = frame.groupby("symbol")[["a", "b"]]
    filled = grouped.ffill()
    if backward:
        filled = filled.groupby(frame["symbol"])[["a", "b"]].bfill()
    frame[["a", "b"]] = filled
    return comparable(frame)


def comparable(frame):
    frame = frame.sort_values(["symbol", "t"]).reset_index(drop=True)
    return [
        tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False)
    ]


@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("limit", [None, 40, 100_000])
def test_fill(spark, backward, limit):
    data = rows(1)
    df = spark.createDataFrame(data, SCHEMA)
    got = ordered.fill(
        df, ["symbol"], ["t"], ["a", "b"], backward=backward, rows_per_task=limit
    )
    assert comparable(got.toPandas()) == expected_fill(data, backward)


def test_fill_leaves_values_alone(spark):
    df = spark.createDataFrame([("x", 1, 1.0, "p"), ("x", 2, 2.0, None)], SCHEMA)
    got = ordered.fill(df, ["symbol"], ["t"], ["a"], rows_per_task=None).orderBy("t").collect()
    assert [(r.a, r.b) for r in got] == [(1.0, "p"), (2.0, None)]


@pytest.mark.parametrize("limit", [None, 40])
def test_previous(spark, limit):
    data = rows(2)
    df = spark.createDataFrame(data, SCHEMA)
    got = ordered.previous(df, ["symbol"], ["t"], {"old_b": "b", "old_t": "t"},
                           rows_per_task=limit)
    frame = pd.DataFrame(data, columns=["symbol", "t", "a", "b"]).sort_values(["symbol", "t"])
    frame["old_b"] = frame.groupby("symbol")["b"].shift()
    frame["old_t"] = frame.groupby("symbol")["t"].shift()
    columns = ["symbol", "t", "old_b", "old_t"]
    assert comparable(got.select(columns).toPandas()) == comparable(frame[columns])


def test_long_series_are_cut_evenly(spark):
    """A series with most rows is spread over several pieces, none of them dominant."""
    data = [("hot", t, float(t), "x") for t in range(4000)] + [("cold", 1, 1.0, "x")]
    df = spark.createDataFrame(data, SCHEMA)
    split = skew.split_series(df, ["symbol"], 500)
    assert split.long_rows == 4000 and split.ordinary.count() == 1
    pieces = skew.cut_pieces(split.long, ["symbol"], ["t"], split.long_rows, 500)
    sizes = [r["count"] for r in pieces.groupBy(skew.PIECE).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) >= 8 and max(sizes) < 1200


def test_small_pieces_share_a_task(spark):
    """Many pieces don't make many tasks; they are contiguous, whole, and no longer than asked for."""
    data = [(s, t, float(t), "x") for s in ("a", "b", None) for t in range(2000)]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    pieces = skew.cut_pieces(df, ["symbol"], ["t"], 6000, 20)
    assert pieces.rdd.getNumPartitions() <= 4 and len(pieces.inputFiles()) <= 4
    cut = pieces.toPandas()
    assert len(cut) == 6000 and cut.groupby(skew.PIECE).size().max() <= 20
    cut["symbol"] = cut["symbol"].fillna("")
    assert cut.sort_values(["symbol", "t"])[skew.PIECE].is_monotonic_increasing


def test_null_series_keys_are_kept(spark):
    data = [(None, t, 1.0 if t == 0 else None, "x") for t in range(60)]
    data += [("a", t, 2.0 if t == 0 else None, "x") for t in range(5)]
    df = spark.createDataFrame(data, SCHEMA)
    got = ordered.fill(df, ["symbol"], ["t"], ["a"], rows_per_task=20)
    assert got.count() == 65
    assert {(r.symbol, r.a) for r in got.collect()} == {(None, 1.0), ("a", 2.0)}


@pytest.mark.parametrize("limit", [None, 10])
def test_rising_edge(spark, limit):
    df = spark.createDataFrame(
        [("x", t, None, None) for t in range(40)], SCHEMA
    ).withColumn("on", (F.col("t") % 10).between(3, 6))
    got = ordered.rising_edge(df, ["symbol"], ["t"], F.col("on"), rows_per_task=limit)
    assert sorted(r.t for r in got.filter("fires").collect()) == [3, 13, 23, 33]


@pytest.mark.parametrize("limit", [None, 10])
def test_changes(spark, limit):
    df = spark.createDataFrame(
        [("x", t, None, "up" if t // 15 % 2 else "down") for t in range(45)], SCHEMA
    )
    got = ordered.changes(df, ["symbol"], ["t"], "b", rows_per_task=limit).orderBy("t").collect()
    assert [(r.t, r.old_b, r.new_b) for r in got] == [(15, "down", "up"), (30, "up", "down")]


# -- feeds -------------------------------------------------------------------
def feed_rows(seed):
    chosen = random.Random(seed)
    out, seq = [], 0
    for _ in range(900):
        seq += 1
        symbol = "hot" if chosen.random() < 0.6 else f"s{chosen.randrange(5)}"
        value = chosen.choice([float("nan"), chosen.random(), chosen.random()])
        out.append((symbol, f"2024-01-01 {chosen.randrange(24):02d}:{chosen.randrange(60):02d}:00",
                    chosen.choice("pqr"), value, seq))
    return out


@pytest.fixture(scope="module")
def long_feeds(spark):
    return spark.createDataFrame(
        feed_rows(5), "symbol STRING, t STRING, feed STRING, value DOUBLE, seq BIGINT"
    ).select("symbol", F.col("t").cast("timestamp").alias("time"), "feed", "value", "seq")


def by_key(df):
    frame = df.toPandas()
    return {
        (r.symbol, r.time): tuple(None if pd.isna(v) else v for v in (r.p, r.q, r.r))
        for r in frame.itertuples()
    }


def test_grouping_equals_the_join_chain(long_feeds):
    from seriesmill.operators.dedupe import keep_last

    frames = [
        keep_last(long_feeds.filter(F.col("feed") == f), ["symbol", "time"], ["seq"]).select(
            "symbol", "time", F.col("value").alias(f)
        )
        for f in "pqr"
    ]
    chain = align.full_outer(frames, ["symbol", "time"])
    wide = align.align_feeds(long_feeds, ["symbol"], list("pqr"))
    assert by_key(chain) == by_key(wide)


@pytest.mark.parametrize("backward", [False, True])
def test_align_and_fill_with_long_series(long_feeds, backward):
    plain, cut = (
        align.align_and_fill(
            long_feeds, ["symbol"], list("pqr"), backward=backward, rows_per_task=limit
        )
        for limit in (None, 60)
    )
    assert by_key(plain) == by_key(cut)


def test_ordinary_series_shuffle_once(long_feeds, plan_of):
    """Grouping and filling share one partitioning by symbol."""
    plan = plan_of(
        align.align_and_fill(long_feeds, ["symbol"], list("pqr"), rows_per_task=None)
    )
    assert plan.count("Exchange hashpartitioning") == 1
