"""Own sources read page by page, as a table and as a stream."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.sources import paged, paths
from seriesmill.streaming import ingest

SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("n", T.LongType())])


@pytest.fixture
def source():
    def fetch(page):
        if page["symbol"] == "broken":
            raise RuntimeError("venue is down")
        return [{"symbol": page["symbol"], "n": n} for n in range(page["first"], page["last"])]

    return paged.paged_source("numbers", SCHEMA, fetch)


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "symbol string, page_no long, first long, last long")


def got(df):
    return sorted((r.symbol, r.n) for r in df.collect())


def test_every_page_is_read_once(spark, tmp_path, source):
    plan = str(tmp_path / "plan")
    assert got(paged.read_pages(spark, source, plan)) == []
    asked = [("a", i, i * 3, i * 3 + 3) for i in range(40)] + [("b", 0, 5, 5)]
    assert paged.write_plan(pages(spark, *asked), plan, pages_per_task=7) == 0
    read = paged.read_pages(spark, source, plan)
    assert read.rdd.getNumPartitions() >= 6  # no task has more than seven pages
    assert got(read) == [("a", n) for n in range(120)]
    assert paged.write_plan(pages(spark, ("c", 0, 1, 3)), plan) == 1
    assert got(paged.read_pages(spark, source, plan))[-2:] == [("c", 1), ("c", 2)]


def test_an_unfinished_round_is_not_read(spark, tmp_path, source):
    plan = str(tmp_path / "plan")
    paged.write_plan(pages(spark, ("a", 0, 0, 2)), plan)
    paged.write_plan(pages(spark, ("b", 0, 0, 2)), plan)
    (tmp_path / "plan" / "round=00000001" / "_SUCCESS").unlink()
    assert paged.rounds(paths.qualified(spark, plan)) == [0]
    assert got(paged.read_pages(spark, source, plan)) == [("a", 0), ("a", 1)]


def test_a_stream_goes_on_after_its_last_round(spark, tmp_path, source):
    plan, out, checkpoint = (str(tmp_path / n) for n in ("plan", "out", "checkpoint"))

    def go():
        stream = paged.stream_pages(spark, source, plan)
        ingest.to_parquet(stream, out, checkpoint).awaitTermination()
        return got(spark.read.schema(SCHEMA).parquet(out))

    paged.write_plan(pages(spark, ("a", 0, 0, 2)), plan)
    assert go() == [("a", 0), ("a", 1)]
    paged.write_plan(pages(spark, ("a", 1, 2, 3)), plan)
    paged.write_plan(pages(spark, ("b", 0, 9, 10)), plan)
    assert go() == [("a", 0), ("a", 1), ("a", 2), ("b", 9)]
    assert go() == [("a", 0), ("a", 1), ("a", 2), ("b", 9)]


def test_a_failing_page_is_an_error(spark, tmp_path, source):
    plan = str(tmp_path / "plan")
    paged.write_plan(pages(spark, ("broken", 0, 0, 2)), plan)
    with pytest.raises(Exception, match="venue is down"):
        paged.read_pages(spark, source, plan).collect()


def test_a_task_gets_neighbouring_pages_of_a_series(spark, tmp_path):
    plan = str(tmp_path / "plan")
    paged.write_plan(pages(spark, *[(f"s{i}", n, n, n + 1) for i in range(60) for n in range(40)]), plan, pages_per_task=20)
    read = spark.read.parquet(f"{plan}/round=00000000").withColumn("file", F.input_file_name())
    held = read.groupBy("file").agg(F.count("*").alias("n"), F.countDistinct("symbol", F.floor(F.col("page_no") / 10)).alias("stretches"))
    held = held.toPandas()
    assert held["n"].sum() == 2400 and held["n"].max() <= 20
    # Two whole stretches, or the ends of some; one by one there were up to twenty.
    assert held["stretches"].max() <= 4
    series = read.groupBy("symbol").agg(F.countDistinct("file").alias("files")).toPandas()
    assert (series["files"] > 1).all()


def test_pages_of_a_landed_history(spark, tmp_path, monkeypatch):
    """Buckets follow the rows, a page reads the row groups that can hold its rows, and gets what a venue gives."""
    import pyarrow.parquet as pq

    monkeypatch.setattr(paged, "ROWS_PER_BUCKET", 100)
    monkeypatch.setattr(paged, "_ROW_GROUP", 512)
    count = {"long": 3000, "a": 1, "b": 40, "\u00e4\U0001f600": 25, "": 7}
    data = [(s, i * 10, float(i)) for s, n in count.items() for i in range(n)] + [("b", None, 1.0), (None, 10, 2.0)]
    rows = spark.createDataFrame(data, "symbol string, ms long, value double")
    history = str(tmp_path / "venue")
    paged.land_history(rows.select("symbol", F.timestamp_millis("ms").alias("time"), "value"), history)
    assert (tmp_path / "venue" / "buckets=31").is_dir()

    read = []
    real = pq.ParquetFile.read_row_group
    monkeypatch.setattr(pq.ParquetFile, "read_row_group", lambda *a, **k: read.append(1) or real(*a, **k))
    fetch = paged.landed_pages(paths.qualified(spark, history), ["time", "value"])
    epoch = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
    for symbol in [*count, "absent", "b"]:
        for start, end, limit in ((0, 10**6, 5), (95, 400, 100), (29_990, 29_990, 3), (-50, -1, 9), (10, 5, 9)):
            page = {"symbol": symbol, "timeframe": "1h", "page_no": 4, "page_start_ms": start, "page_end_ms": end, "page_limit": limit}
            got = fetch(page)
            wanted = [i for i in range(count.get(symbol, 0)) if start <= i * 10 <= end][:limit]
            assert [(r["symbol"], r["value"], r["page_no"]) for r in got] == [(symbol, float(i), 4) for i in wanted]
            assert [r["time"] for r in got] == [epoch + datetime.timedelta(milliseconds=i * 10) for i in wanted]
    read.clear()
    late = {"symbol": "long", "timeframe": "1h", "page_no": 0, "page_start_ms": 29_000, "page_end_ms": 29_100, "page_limit": 9}
    assert len(fetch(late)) == 9 and len(read) <= 2
