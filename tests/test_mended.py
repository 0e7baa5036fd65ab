"""Cases that the first round's queries could not reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators import membership
from seriesmill.operators.bars import bars_from_events
from seriesmill.plans import incremental
from seriesmill.queries.inputs import NOW_MS
from seriesmill.schemas import columns
from seriesmill.sources import documents, files, landed
from seriesmill.sources.store import SeriesTable

PAYLOAD = columns(time=T.TimestampType(), value=T.DoubleType())
ROWS = "source string, symbol string, timeframe string, time timestamp, value double, seq long"


def rows(spark, data):
    made = spark.createDataFrame(data, ROWS.replace("time timestamp", "time string"))
    return made.withColumn("time", F.col("time").cast("timestamp"))


def test_volume_keeps_small_and_large_values(spark):
    made = spark.range(1000).selectExpr("'a' symbol", "timestamp'2024-01-01' time", "id seq", "0.004D value")
    assert bars_from_events(made, ["symbol"], "1d").first()["volume"] == pytest.approx(4.0)
    assert bars_from_events(made.withColumn("value", F.lit(1e17)), ["symbol"], "1d").first()["volume"] == pytest.approx(1e20)
    exact = made.withColumn("value", F.lit("0.00000001").cast("decimal(38,8)"))
    assert bars_from_events(exact, ["symbol"], "1d").first()["volume"] == 1e-5


@pytest.mark.parametrize("fmt", list(files.EXTENSIONS))
def test_times_before_1970(spark, tmp_path, fmt):
    schema = T.StructType([T.StructField("time", T.TimestampType())])
    times = ["1954-07-01", "1970-01-10", "1970-04-26", "2024-01-01"]
    made = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("time"))
    files.save_files(made, str(tmp_path / "x"), fmt)
    back = files.load_files(spark, str(tmp_path / "x"), schema, fmt)
    assert sorted(r[0] for r in back.select(F.date_format("time", "yyyy-MM-dd")).collect()) == sorted(times)


def test_feather_is_not_partitioned(spark, tmp_path):
    with pytest.raises(ValueError):
        files.save_files(spark.range(3), str(tmp_path / "x"), "feather", partition_by=["id"])


def test_documents_are_the_same_with_and_without_cutting(spark):
    made = spark.range(100).selectExpr("'a' symbol", "timestamp_seconds(id) time", "id value")
    made = made.unionByName(spark.range(7).selectExpr("cast(null as string) symbol", "timestamp_seconds(id) time", "id value"))
    shown = []
    for limit in (None, 13):
        docs = documents.to_documents(made, ["symbol"], ["time", "value"], ["time"], rows_per_document=30, rows_per_task=limit)
        shown.append(sorted((str(r["symbol"]), r["doc_no"], r["n_rows"], r["payload"]) for r in docs.collect()))
    assert shown[0] == shown[1]
    assert [x[1:3] for x in shown[0] if x[0] == "a"] == [(0, 30), (1, 30), (2, 30), (3, 10)]


def test_old_series_are_extended_from_their_end(spark):
    wanted = spark.createDataFrame([("a", "1d", 0, None)], "symbol string, timeframe string, start_ms long, end_ms long")
    end = 883_612_800_000  # 1998-01-01
    marks = spark.createDataFrame([("a", end)], "symbol string, max_ms long")
    row = incremental.incremental_plan(wanted, marks, ["symbol"], NOW_MS).first()
    assert (row["action"], row["fetch_start_ms"], row["fetch_end_ms"]) == ("extend", end + 86_400_000, NOW_MS)
    cleaned = incremental.incremental_plan(wanted, marks, ["symbol"], NOW_MS, clean=True).first()
    assert cleaned["fetch_start_ms"] > row["fetch_start_ms"]


def test_other_zones_are_refused(spark, tmp_path):
    table = SeriesTable(spark, str(tmp_path / "t"), PAYLOAD)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(RuntimeError):
            SeriesTable(spark, str(tmp_path / "t"), PAYLOAD)
        with pytest.raises(RuntimeError):
            table.read()
        with pytest.raises(RuntimeError):
            table.append(rows(spark, [("s", "a", "1d", "2024-01-01", 1.0, 0)]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_the_least_row_wins_without_an_order(spark, tmp_path):
    table = SeriesTable(spark, str(tmp_path / "t"), PAYLOAD)
    data = [("s", "a", "1d", "2024-01-01", float(v), -v) for v in range(50)]
    table.upsert(rows(spark, data).repartition(7))
    assert [r["value"] for r in table.read().collect()] == [0.0]
    other = SeriesTable(spark, str(tmp_path / "o"), PAYLOAD)
    other.upsert(rows(spark, data).repartition(7), ["seq"])
    assert [r["value"] for r in other.read().collect()] == [49.0]
    other.append(rows(spark, data).drop("seq"))
    other.compact(source="s", timeframe="1d", month="2024-01")
    assert [r["value"] for r in other.read().collect()] == [0.0]


def test_upsert_checks_its_input(spark, tmp_path):
    table = SeriesTable(spark, str(tmp_path / "t"), PAYLOAD)
    with pytest.raises(Exception):
        table.upsert(rows(spark, [("s", "a", "1d", "2024-01-01", 1.0, 0)]).drop("value"))


def test_null_keys_exist_and_go(spark, tmp_path):
    table = SeriesTable(spark, str(tmp_path / "t"), PAYLOAD)
    table.append(rows(spark, [("s", None, "1d", "2024-01-01", 1.0, 0), ("s", "b", "1d", "2024-02-01", 1.0, 0)]).drop("seq"))
    keys = spark.createDataFrame([("s", None, "1d"), ("s", "c", "1d")], "source string, symbol string, timeframe string")
    assert {r["symbol"]: r["present"] for r in table.exists(keys).collect()} == {None: True, "c": False}
    assert {r["symbol"]: r["deleted"] for r in table.delete(keys).collect()} == {None: True, "c": False}
    assert [r["symbol"] for r in table.read().collect()] == ["b"]
    import os

    assert not os.path.exists(str(tmp_path / "t" / "source=s" / "timeframe=1d" / "month=2024-01"))


def test_existence_reads_the_asked_folders_alone(spark, tmp_path, plan_of):
    table = SeriesTable(spark, str(tmp_path / "t"), PAYLOAD)
    table.append(rows(spark, [(s, "a", "1d", "2024-01-01", 1.0, 0) for s in ("s", "t")]).drop("seq"))
    keys = spark.createDataFrame([("s", "a", "1d")], "source string, symbol string, timeframe string")
    plan = plan_of(table.exists(keys))
    assert "PartitionFilters" in plan and "source#" in plan and " = s)" in plan


def test_many_partitions_are_pruned_by_spans(spark, tmp_path, monkeypatch):
    from seriesmill.sources import store

    monkeypatch.setattr(store, "_LISTED", 1)
    table = SeriesTable(spark, str(tmp_path / "t"), PAYLOAD)
    data = [(s, "a", "1d", f"2024-{m:02d}-01", 1.0, 0) for s in ("s", "t") for m in range(1, 7)]
    assert table.upsert(rows(spark, data)).count() == 12
    assert table.upsert(rows(spark, data)).count() == 0
    keys = spark.createDataFrame([("s", "a", "1d")], "source string, symbol string, timeframe string")
    assert [r["deleted"] for r in table.delete(keys).collect()] == [True]
    assert table.read().count() == 6


def test_tail_reads_the_last_months(spark, tmp_path):
    table = SeriesTable(spark, str(tmp_path / "t"), PAYLOAD)
    data = [("s", "a", "1d", f"2024-{m:02d}-{d:02d}", float(m * 100 + d), 0) for m in range(1, 7) for d in (1, 2)]
    table.append(rows(spark, data).drop("seq"))
    for n in (0, 1, 3, 12, 20):
        tail = table.tail(n, source="s", symbol="a", timeframe="1d").collect()
        assert [r["value"] for r in tail] == sorted((x[4] for x in data), reverse=True)[:n]
    assert table.tail(3, source="s", symbol="z", timeframe="1d").count() == 0
    assert table.time_ranges(source="s", start="2024-03-01").first()["start_time"] == dt.datetime(2024, 3, 1)


def test_the_later_page_counts(spark, tmp_path):
    feed = next(iter(landed.DERIVATIVES_FEEDS))
    value, time, _ = landed.DERIVATIVES_FEEDS[feed]
    for page in (2, 1, 3):
        spark.createDataFrame([("a", str(page), "1704067200000")], f"symbol string, {value} string, {time} string").write.json(
            str(tmp_path / feed / f"page-{page}")
        )
    for other in list(landed.DERIVATIVES_FEEDS)[1:]:
        spark.createDataFrame([], landed.feed_schema(other)).write.json(str(tmp_path / other))
    column = landed.DERIVATIVES_FEEDS[feed][2]
    assert [r[column] for r in landed.read_derivatives(spark, str(tmp_path), "1h").collect()] == [3.0]


def test_a_key_listed_twice_repeats_no_rows(spark):
    catalogue = spark.createDataFrame([("a", "y"), ("a", "x")], "symbol string, name string")
    described = membership.describe(spark.createDataFrame([("a",), ("b",)], "symbol string"), catalogue, ["symbol"])
    assert sorted((r["symbol"], r["name"]) for r in described.collect()) == [("a", "x"), ("b", None)]
