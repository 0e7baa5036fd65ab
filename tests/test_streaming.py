import os

import pytest
from pyspark.sql import functions as F

from seriesmill.operators.audit import latest_state, status_changes, status_counts
from seriesmill.operators.bars import bars_from_events
from seriesmill.schemas import OHLCV, columns
from seriesmill.sources.store import SeriesTable
from seriesmill.streaming import ingest

PAYLOAD = columns(time=OHLCV["time"].dataType, value=OHLCV["open"].dataType)
WIRE = "source STRING, symbol STRING, timeframe STRING, day STRING, value DOUBLE, seq BIGINT"


def rows(spark, data):
    return spark.createDataFrame(data, WIRE).select(
        "source", "symbol", "timeframe", F.col("day").cast("timestamp").alias("time"),
        "value", "seq",
    )


def land(spark, folder, data):
    rows(spark, data).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def landing(spark, tmp_path):
    folder = str(tmp_path / "landing")
    land(spark, folder, [("s", "a", "1d", f"2024-01-{d:02d}", float(d), d) for d in range(1, 11)])
    return folder


def run(spark, tmp_path, landing):
    schema = rows(spark, []).schema
    table = SeriesTable(spark, str(tmp_path / "table"), PAYLOAD)
    stream = ingest.landing_stream(spark, landing, schema, files_per_batch=1)
    ingest.ingest(
        stream, table, str(tmp_path / "checkpoint"), arrival=["seq"],
        audit_path=str(tmp_path / "audit"),
    ).awaitTermination()
    return table


def test_ingest_in_batches(spark, tmp_path, landing):
    table = run(spark, tmp_path, landing)
    assert table.read().count() == 10
    # A second run sees only the new file: an overlap, a repeat within it, and another month.
    land(spark, landing, [
        ("s", "a", "1d", "2024-01-10", 99.0, 20), ("s", "a", "1d", "2024-01-11", 11.0, 21),
        ("s", "a", "1d", "2024-01-11", 98.0, 22), ("s", "b", "1d", "2024-02-01", 1.0, 23),
    ])
    table = run(spark, tmp_path, landing)
    assert sorted((r.symbol, r.value) for r in table.read().collect()) == sorted(
        [("a", float(d)) for d in range(1, 12)] + [("b", 1.0)]
    )
    log = spark.read.schema(ingest.AUDIT).parquet(str(tmp_path / "audit"))
    assert sorted((r.batch_id, r.symbol, r.rows_in, r.rows_new) for r in log.collect()) == [
        (0, "a", 10, 10), (1, "a", 3, 1), (1, "b", 1, 1)
    ]
    # Nothing new: nothing changes.
    run(spark, tmp_path, landing)
    assert table.read().count() == 12


def test_a_replayed_batch_keeps_its_audit(spark, tmp_path, landing):
    """The commit of a batch is lost: the batch runs again, finds its rows stored, and leaves the log."""
    run(spark, tmp_path, landing)
    read = lambda: sorted(map(tuple, spark.read.schema(ingest.AUDIT).parquet(str(tmp_path / "audit")).collect()))
    before = read()
    commits = tmp_path / "checkpoint" / "commits"
    for name in ("0", ".0.crc"):
        if (commits / name).exists():
            (commits / name).unlink()
    run(spark, tmp_path, landing)
    assert read() == before and before[0][3:5] == (10, 10)
    # A new checkpoint is another run; the first one's log stays.
    table = SeriesTable(spark, str(tmp_path / "table"), PAYLOAD)
    stream = ingest.landing_stream(spark, landing, rows(spark, []).schema)
    ingest.ingest(stream, table, str(tmp_path / "second"), arrival=["seq"], audit_path=str(tmp_path / "audit")).awaitTermination()
    after = read()
    assert len(after) == 2 and before[0] in after and table.read().count() == 10


def test_stream_equals_batch(spark, tmp_path, landing):
    """The same rows in one upsert and file by file."""
    land(spark, landing, [("s", "a", "1d", "2024-01-05", 77.0, 50)])
    table = run(spark, tmp_path, landing)
    batch = SeriesTable(spark, str(tmp_path / "batch"), PAYLOAD)
    batch.upsert(spark.read.parquet(landing), ["seq"])
    assert table.read().exceptAll(batch.read()).isEmpty()
    assert batch.read().exceptAll(table.read()).isEmpty()


def test_repeated_batch_adds_nothing(spark, tmp_path, landing):
    table = run(spark, tmp_path, landing)
    batch = spark.read.parquet(landing)
    added = table.upsert(batch, ["seq"])
    assert added.count() == 0
    log = ingest.audit_rows(batch, added, 7).collect()
    assert [(r.rows_in, r.rows_new, r.status) for r in log] == [(10, 0, "idle")]


def streamed(spark, tmp_path, df, name):
    path, checkpoint = str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")
    ingest.to_parquet(df, path, checkpoint).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def test_first_arrivals(spark, tmp_path, landing):
    land(spark, landing, [("s", "a", "1d", "2024-01-10", 99.0, 20)])
    stream = ingest.landing_stream(spark, landing, rows(spark, []).schema, files_per_batch=1)
    first = ingest.first_arrivals(stream, ["symbol", "time"], "3 days")
    got = streamed(spark, tmp_path, first, "first")
    assert got.count() == 10
    # Whichever file is read first, one value per key comes out.
    assert got.select("symbol", "time").distinct().count() == 10


@pytest.mark.parametrize("frame, emitted", [("1d", 8), ("1w", 1)])
def test_closed_bars(spark, tmp_path, landing, frame, emitted):
    """The watermark stands a day before the last row, January 10th."""
    schema = rows(spark, []).schema
    stream = ingest.landing_stream(spark, landing, schema)
    bars = ingest.closed_bars(stream, ["symbol"], frame, "1 day")
    got = streamed(spark, tmp_path, bars, f"bars-{frame}")
    batch = bars_from_events(spark.read.parquet(landing), ["symbol"], frame)
    assert got.count() == emitted
    assert got.exceptAll(batch.select(got.columns)).isEmpty()
    if frame == "1w":
        assert got.first().time.strftime("%a %Y-%m-%d") == "Mon 2024-01-01"


def test_run_log_reports(spark):
    log = spark.createDataFrame(
        [("t1", 1, "created", None), ("t1", 2, "running", None), ("t1", 3, "failed", "boom"),
         ("t1", 4, "failed", "again"), ("t2", 1, "running", None)],
        "task STRING, seq BIGINT, status STRING, error STRING",
    ).withColumn("time", F.timestamp_seconds("seq"))
    counts = {r.status: (r.n_runs, r.n_running) for r in status_counts(log).collect()}
    assert counts == {"created": (1, 0), "running": (2, 2), "failed": (2, 0)}
    state = {r.task: r for r in
             latest_state(log, ["task"], time="time", seq="seq").collect()}
    assert (state["t1"].run_count, state["t1"].last_status, state["t1"].last_error) == (
        4, "failed", "again"
    )
    assert (state["t2"].run_count, state["t2"].last_status) == (1, "running")
    changed = status_changes(log, ["task"], ["time"], rows_per_task=None).collect()
    assert sorted((r.seq, r.old_status, r.new_status) for r in changed) == [
        (2, "created", "running"), (3, "running", "failed")
    ]


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path, landing):
    """A row for a bar that has been emitted does not change it, nor emit it again."""
    schema = rows(spark, []).schema
    path, checkpoint = str(tmp_path / "late"), str(tmp_path / "late-checkpoint")

    def go():
        stream = ingest.landing_stream(spark, landing, schema)
        bars = ingest.closed_bars(stream, ["symbol"], "1d", "1 day")
        ingest.to_parquet(bars, path, checkpoint).awaitTermination()
        return spark.read.schema(bars.schema).parquet(path)

    assert go().count() == 8
    land(spark, landing, [("s", "a", "1d", "2024-01-02", 500.0, 60),
                          ("s", "a", "1d", "2024-01-12", 12.0, 61)])
    got = go()
    assert got.count() == 10
    assert got.filter("time = '2024-01-02'").first().high == 2.0


def out_of_order(spark, landing):
    """Two more files: the first read holds later arrivals than the second for the same keys."""
    land(spark, landing, [("s", "b", "1d", "2024-01-20", 2.0, 70), ("s", "b", "1d", "2024-01-21", 3.0, 71),
                          ("s", "b", "1d", "2024-01-22", 4.0, 73)])
    land(spark, landing, [("s", "b", "1d", "2024-01-20", 1.0, 60), ("s", "b", "1d", "2024-01-21", 9.0, 72),
                          ("s", "b", "1d", "2024-01-22", 4.5, 73), ("s", "b", "1d", "2024-02-20", 0.0, 80)])


@pytest.mark.parametrize("files", [1, None])
def test_first_wins_whatever_file_it_comes_in(spark, tmp_path, landing, files):
    out_of_order(spark, landing)
    stream = ingest.landing_stream(spark, landing, rows(spark, []).schema, files_per_batch=files)
    first = ingest.first_wins(stream, ["source", "symbol", "timeframe", "time"], ["seq"], "30 days")
    got = streamed(spark, tmp_path, first, "first")
    # The watermark stands at January 21st; the day after is still open.
    assert sorted((r.time.day, r.value, r.seq) for r in got.filter("symbol = 'b'").collect()) == [(20, 1.0, 60), (21, 3.0, 71)]
    batch = spark.read.parquet(landing).filter("time <= '2024-01-21'")
    expected = batch.groupBy("source", "symbol", "timeframe", "time").agg(F.min("seq").alias("seq"))
    assert sorted(map(repr, got.select(*expected.columns).collect())) == sorted(map(repr, expected.collect()))
    with pytest.raises(ValueError):
        ingest.first_wins(stream, ["symbol"], ["seq"], "1 day")


def test_first_by_key_holds_state_until_its_timer(spark, tmp_path, landing):
    out_of_order(spark, landing)
    schema = rows(spark, []).schema
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, ingest.ROCKSDB)
    try:
        stream = ingest.landing_stream(spark, landing, schema, files_per_batch=1)
        first = ingest.first_by_key(stream.filter("symbol = 'b'"), ["symbol", "time"], ["seq"], "30 days")
        got = streamed(spark, tmp_path, first, "by-key")
        assert sorted((r.time.day, r.value, r.seq) for r in got.collect()) == [(20, 1.0, 60), (21, 3.0, 71)]
    finally:
        spark.conf.set(provider, before)


@pytest.mark.parametrize("bound", [{}, {"files_per_batch": 1}, {"bytes_per_batch": 1}])
def test_batches_are_bounded(spark, tmp_path, landing, bound):
    land(spark, landing, [("s", "c", "1d", "2024-01-20", 2.0, 70)])
    land(spark, landing, [("s", "c", "1d", "2024-01-21", 2.0, 71)])
    files = len([n for n in os.listdir(landing) if n.endswith(".parquet")])
    stream = ingest.landing_stream(spark, landing, rows(spark, []).schema, **bound)
    query = ingest.to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == (files if bound else 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 12
    with pytest.raises(ValueError):
        ingest.landing_stream(spark, landing, rows(spark, []).schema, files_per_batch=1, bytes_per_batch=1)
