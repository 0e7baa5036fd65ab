"""One run over many series: what is added, set aside and reported."""

import pytest
from pyspark.sql import functions as F

from seriesmill.plans import runs
from seriesmill.schemas import OHLCV
from seriesmill.sources.store import SeriesTable

DAY = 86_400_000
NOW = 20 * DAY
KEYED = "source string, symbol string, timeframe string, day int, open double, high double, low double, close double, volume double, seq long"


def bars(spark, rows):
    made = spark.createDataFrame(rows, KEYED)
    at = F.timestamp_millis(F.col("day").cast("long") * DAY)
    return made.withColumn("time", at).drop("day")


def bar(symbol, day, seq=0, price=1.0, high=2.0, source="s"):
    return (source, symbol, "1d", day, price, high, 0.5, 1.0, 9.0, seq)


def requests(spark, *rows):
    return spark.createDataFrame(
        [("s", symbol, "1d", start * DAY, end and end * DAY) for symbol, start, end in rows],
        "source string, symbol string, timeframe string, start_ms long, end_ms long",
    )


@pytest.fixture
def table(spark, tmp_path):
    made = SeriesTable(spark, str(tmp_path / "bars"), OHLCV)
    made.append(bars(spark, [bar("old", d) for d in range(1, 11)] + [bar("fresh", d) for d in range(1, 20)]).drop("seq"))
    return made


def go(spark, table, tmp_path, landed, run_id="r1"):
    asked = requests(spark, ("old", 0, None), ("fresh", 0, None), ("new", 5, 8), ("silent", 0, None), ("bad", 0, None))
    return runs.incremental_run(
        table, asked, bars(spark, landed), NOW, run_id=run_id, folder=str(tmp_path / "log"), arrival=["seq"]
    )


LANDED = [
    bar("old", 11, 1), bar("old", 11, 0, price=7.0), bar("old", 5, 0), bar("old", 12, 0, high=0.1), bar("old", 20, 0),
    bar("new", 4), bar("new", 5), bar("new", 8), bar("new", 9),
    bar("fresh", 19, price=5.0), bar("bad", 3, price=None), bar("bad", None), bar("stranger", 3), bar("bad", 4, price=float("nan")),
]


def report(run):
    return {
        r.symbol: (r.action, r.rows_in, r.rows_new, r.rows_known, r.rows_skipped, r.rows_set_aside, r.status)
        for r in run.summary.collect()
    }


def test_one_run(spark, table, tmp_path):
    run = go(spark, table, tmp_path, LANDED)
    assert report(run) == {
        "old": ("extend", 5, 1, 1, 1, 2, "partial"),
        "new": ("initial", 4, 2, 0, 2, 0, "completed"),
        "fresh": ("none", 1, 0, 0, 1, 0, "idle"),
        "silent": ("initial", 0, 0, 0, 0, 0, "no data"),
        "bad": ("initial", 3, 0, 0, 0, 3, "failed"),
        "stranger": (None, 1, 0, 0, 0, 1, "unknown"),
    }
    aside = {(r.symbol, r.seq, tuple(r.reasons)) for r in run.set_aside.collect()}
    assert ("old", 0, ("high below low",)) in aside and ("old", 0, ("unfinished",)) in aside
    assert ("bad", 0, ("no time",)) in aside and ("bad", 0, ("open is missing",)) in aside
    assert ("stranger", 0, ("not requested",)) in aside and len(aside) == 5 and run.set_aside.count() == 6
    # The first arrival of a bar wins.
    assert [r.open for r in table.read(symbols=["old"], start="1970-01-12").collect()] == [7.0]
    assert table.read(symbols=["new"]).count() == 2


def test_a_run_again_adds_nothing_and_replaces_its_rows(spark, table, tmp_path):
    go(spark, table, tmp_path, LANDED)
    before = table.read().count()
    again = go(spark, table, tmp_path, LANDED)
    assert again.added.count() == 0 and table.read().count() == before
    assert again.set_aside.count() == 6
    assert report(again)["bad"][-1] == "failed"
    go(spark, table, tmp_path, [], "r2")
    kept = spark.read.parquet(str(tmp_path / "log" / "runs")).groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in kept} == {"r1": 6, "r2": 5}


def test_a_plan_too_large_to_broadcast_gives_the_same(spark, table, tmp_path):
    plan = runs.incremental_plan(requests(spark, ("old", 0, None), ("new", 5, 8)), table.high_water(), runs.SERIES_KEYS, NOW)
    rules = runs.payload_checks(OHLCV)
    landed = bars(spark, LANDED)
    few = runs.checked(landed, plan, NOW, rules)
    many = runs.checked(landed, plan, NOW, rules, broadcast_series=0)
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))
