import datetime
import os

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from seriesmill.schemas import OHLCV, check_schema, columns, schema_violations
from seriesmill.sources import documents, files, registry, store
from seriesmill.sources.feather import read_feather

KEYED = "source STRING, symbol STRING, timeframe STRING, day STRING, value DOUBLE"
PAYLOAD = columns(time=OHLCV["time"].dataType, value=OHLCV["open"].dataType)


def series(spark, rows):
    return spark.createDataFrame(rows, KEYED).select(
        "source", "symbol", "timeframe", F.col("day").cast("timestamp").alias("time"), "value"
    )


def content(df):
    return sorted(
        (r.source, r.symbol, r.timeframe, r.time.strftime("%Y-%m-%d"), r.value)
        for r in df.collect()
    )


@pytest.fixture
def table(spark, tmp_path):
    made = store.SeriesTable(spark, str(tmp_path / "series"), PAYLOAD)
    made.append(
        series(
            spark,
            [
                ("spot", "binance:BTC/USDT", "1d", "2024-01-01", 1.0),
                ("spot", "binance:BTC/USDT", "1d", "2024-02-01", 2.0),
                ("spot", "ETH", "1d", "2024-01-01", 3.0),
                ("a/b:c", "BTC", "1h", "2024-01-01", 4.0),
            ],
        )
    )
    return made


def test_missing_table_is_empty(spark, tmp_path):
    made = store.SeriesTable(spark, str(tmp_path / "none"), PAYLOAD)
    assert made.read().count() == 0
    assert made.read().columns == ["source", "symbol", "timeframe", "time", "value"]
    assert made.time_ranges().count() == 0
    assert made.catalog().count() == 0


def test_read_filters(table):
    assert table.read(source="spot", symbols=["ETH"]).count() == 1
    assert table.read(timeframe="1h").first().source == "a/b:c"
    assert content(table.read(start="2024-01-15", end="2024-02-01")) == [
        ("spot", "binance:BTC/USDT", "1d", "2024-02-01", 2.0)
    ]


def test_range_prunes_partitions(table, plan_of):
    plan = plan_of(table.read(source="spot", start="2024-02-01"))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "month" in filters and "source" in filters


def test_upsert_adds_only_missing_rows(spark, table):
    new = series(
        spark,
        [
            ("spot", "ETH", "1d", "2024-01-01", 30.0),
            ("spot", "ETH", "1d", "2024-01-02", 31.0),
            ("spot", "NEW", "1d", "2024-03-01", 32.0),
        ],
    )
    added = table.upsert(new)
    assert sorted((r.symbol, r.value) for r in added.collect()) == [("ETH", 31.0), ("NEW", 32.0)]
    assert table.read().count() == 6
    assert table.upsert(new).count() == 0
    assert table.read().count() == 6


def test_upsert_into_nothing_settles_repeats(spark, tmp_path):
    made = store.SeriesTable(spark, str(tmp_path / "series"), PAYLOAD)
    rows = [("s", "x", "1d", "2024-01-01", 1.0), ("s", "x", "1d", "2024-01-01", 2.0)]
    made.upsert(series(spark, rows).withColumn("seq", F.col("value")), ["seq"])
    assert [r.value for r in made.read().collect()] == [1.0]


def keys(spark, *rows):
    return spark.createDataFrame(list(rows), "source STRING, symbol STRING, timeframe STRING")


def test_delete_empties_partitions(spark, table):
    report = table.delete(
        keys(spark, ("spot", "binance:BTC/USDT", "1d"), ("a/b:c", "BTC", "1h"),
             ("spot", "nothing", "1d"))
    )
    assert {(r.symbol, r.deleted) for r in report.collect()} == {
        ("binance:BTC/USDT", True), ("BTC", True), ("nothing", False)
    }
    assert content(table.read()) == [("spot", "ETH", "1d", "2024-01-01", 3.0)]
    # Deleting again finds nothing, and the table can be written to again.
    assert not table.delete(keys(spark, ("a/b:c", "BTC", "1h"))).first().deleted
    table.append(series(spark, [("a/b:c", "BTC", "1h", "2024-01-01", 5.0)]))
    assert table.read(source="a/b:c").first().value == 5.0


def test_replace(spark, table):
    anew = series(
        spark,
        [("spot", "binance:BTC/USDT", "1d", "2024-01-05", 9.0),
         ("a/b:c", "BTC2", "1h", "2024-01-05", 8.0)],
    )
    assert table.replace(anew)
    assert content(table.read()) == [
        ("a/b:c", "BTC", "1h", "2024-01-01", 4.0),
        ("a/b:c", "BTC2", "1h", "2024-01-05", 8.0),
        ("spot", "ETH", "1d", "2024-01-01", 3.0),
        ("spot", "binance:BTC/USDT", "1d", "2024-01-05", 9.0),
    ]
    assert table.replace(anew.limit(0))
    assert table.read().count() == 4


def test_wrong_rows_are_refused(spark, table):
    with pytest.raises(ValueError, match="missing column 'value'"):
        table.append(series(spark, []).drop("value"))


def test_catalog(table):
    rows = {r.id: r for r in table.catalog().collect()}
    assert [r.table_name for r in table.catalog().collect()] == sorted(
        r.table_name for r in rows.values()
    )
    row = rows["binance:BTC/USDT_1d"]
    assert (row["sub"], row.table_name, row.column_count, row.row_count) == (
        "spot", "spot_binance_btc_usdt_1d", 2, 2
    )
    # {"time":1704067200000,"value":1.0} twice
    assert (row.size_bytes, row["size"]) == (68, "68 B")
    assert row.start_time.strftime("%Y-%m-%d") == "2024-01-01"


def test_info_report(spark, table):
    wanted = spark.createDataFrame(
        [("ETH", "1d"), ("nothing", "1d")], "symbol STRING, timeframe STRING"
    )
    ranges = table.time_ranges().filter("symbol = 'ETH'").unionByName(
        spark.sql("SELECT 's' source, 'open' symbol, '1d' timeframe, CAST(NULL AS TIMESTAMP) "
                  "start_time, CAST(NULL AS TIMESTAMP) end_time")
    )
    wanted = wanted.unionByName(
        spark.createDataFrame([("open", "1d")], "symbol STRING, timeframe STRING")
    )
    rows = store.info_report(
        wanted, ranges.drop("source"), ["symbol", "timeframe"]
    ).collect()
    assert {r.data_name: (r.start_time, r.end_time) for r in rows} == {
        "ETH_1d": ("2024-01-01 00:00:00", "2024-01-01 00:00:00"),
        "nothing_1d": ("无法获取", "无法获取"),
        "open_1d": ("未知", "至今"),
    }


# -- plain files -------------------------------------------------------------
BARS = [("2024-01-01", 100.0), ("2024-01-02", 200.0), ("2024-01-03", 300.0)]


@pytest.fixture
def bars(spark):
    return spark.createDataFrame(BARS, "day STRING, open DOUBLE").select(
        F.col("day").cast("timestamp").alias("time"), "open"
    )


@pytest.mark.parametrize("fmt", list(files.EXTENSIONS))
def test_files_round_trip(spark, tmp_path, bars, fmt):
    path = str(tmp_path / fmt)
    schema = bars.schema
    assert files.load_files(spark, path, schema, fmt).count() == 0
    assert files.save_files(bars.limit(0), path, fmt)
    assert not os.path.exists(path)
    for _ in range(2):  # saving again replaces
        assert files.save_files(bars, path, fmt)
        loaded = files.load_files(spark, path, schema, fmt)
        assert loaded.schema == schema
        assert [(r.time.strftime("%Y-%m-%d"), r.open) for r in
                loaded.orderBy("time").collect()] == BARS
    # Saving nothing leaves what is there.
    assert files.save_files(bars.limit(0), path, fmt)
    assert files.load_files(spark, path, schema, fmt).count() == 3
    listed = files.list_files(spark, path, fmt).collect()
    # One dataset, however many part files it has.
    assert [(r.id, r.sub) for r in listed] == [(fmt, None)]
    assert listed[0].size_bytes > 0 and listed[0].file_path.endswith(f"/{fmt}")


def test_unknown_format(spark, bars):
    with pytest.raises(ValueError):
        files.save_files(bars, "/tmp/x", "xml")
    with pytest.raises(ValueError):
        files.load_files(spark, "/tmp/x", bars.schema, "xml")


def test_feather_written_by_pandas(spark, tmp_path):
    frame = pd.DataFrame(
        {
            "time": pd.to_datetime(["2024-01-01", "2024-01-02"], utc=True),
            "name": ["a", None],
            "value": [1.5, float("nan")],
            "n": [1, 2],
        }
    )
    path = str(tmp_path / "one.feather")
    frame.to_feather(path)
    df = read_feather(spark, path)
    assert dict(df.dtypes) == {
        "time": "timestamp", "name": "string", "value": "double", "n": "bigint"
    }
    rows = df.orderBy("n").collect()
    assert rows[0].time.strftime("%Y-%m-%d") == "2024-01-01" and rows[1].name is None
    # A column of the schema the file lacks is null; others are not read.
    partial = read_feather(spark, path, columns(n=df.schema["n"].dataType,
                                                absent=df.schema["name"].dataType))
    assert sorted(map(tuple, partial.collect())) == [(1, None), (2, None)]


def test_large_feather_files_are_split(spark, tmp_path, monkeypatch):
    from seriesmill.sources import feather

    path = str(tmp_path / "many.feather")
    with pa.OSFile(path, "wb") as sink:
        with pa.ipc.new_file(sink, pa.schema([("n", pa.int64())])) as out:
            for i in range(20):
                out.write_batch(pa.record_batch({"n": list(range(i * 10, i * 10 + 10))}))
    monkeypatch.setattr(feather, "_BYTES_PER_TASK", 600)
    reader = feather.FeatherSource({"path": path}).reader(columns(n=LongType()))
    parts = reader.partitions()
    assert len(parts) > 3
    got = [v for p in parts for b in reader.read(p) for v in b.column("n").to_pylist()]
    assert got == list(range(200))


# -- documents ---------------------------------------------------------------
@pytest.mark.parametrize("limit", [None, 50])
def test_documents(spark, limit):
    rows = [("hot", t, t / 2) for t in range(230)] + [("cold", 5, None)]
    df = spark.createDataFrame(rows, "symbol STRING, t BIGINT, value DOUBLE").select(
        "symbol", F.timestamp_millis("t").alias("time"), "value"
    )
    docs = documents.to_documents(
        df, ["symbol"], ["time", "value"], ["time"], rows_per_document=20, rows_per_task=limit
    )
    sizes = [r.n_rows for r in docs.collect()]
    assert sum(sizes) == 231 and max(sizes) <= 20
    cold = docs.filter("symbol = 'cold'").first()
    assert cold.payload == '[{"time":"1970-01-01T00:00:00.005Z","value":null}]'
    back = documents.from_documents(docs, ["symbol"], PAYLOAD)
    assert sorted((r.symbol, r.t, r.value) for r in
                  back.select("symbol", F.unix_millis("time").alias("t"), "value").collect()
                  if r.symbol == "hot") == [("hot", t, t / 2) for t in range(230)]


# -- contracts ---------------------------------------------------------------
def test_every_violation_is_reported(spark):
    df = spark.createDataFrame([(1, "x")], "time BIGINT, extra STRING")
    problems = schema_violations(df, PAYLOAD, allow_extra=False)
    assert len(problems) == 3
    with pytest.raises(ValueError, match="missing column 'value'"):
        check_schema(df, PAYLOAD)


def test_registering_sources(spark, tmp_path):
    schema = columns(symbol=StringType(), timeframe=StringType(), time=OHLCV["time"].dataType,
                     value=OHLCV["open"].dataType)

    def read(spark, path, shift=0.0):
        return spark.range(2).select(
            F.lit("x").alias("symbol"), F.lit("1d").alias("timeframe"),
            F.timestamp_seconds("id").alias("time"), (F.col("id") + shift).alias("value")
        )

    registry.register_source(registry.Source("own", schema, read), replace=True)
    assert "own" in registry.source_names()
    rows = registry.read_source(spark, "own", "anywhere", shift=0.5).collect()
    assert sorted(r.value for r in rows) == [0.5, 1.5]
    with pytest.raises(ValueError, match="already registered"):
        registry.register_source(registry.Source("own", schema, read))
    with pytest.raises(ValueError) as error:
        registry.register_source(registry.Source("bad", columns(symbol=StringType()), None))
    assert str(error.value).count("\n- ") == 4
    with pytest.raises(ValueError, match="not one of"):
        registry.read_source(spark, "unknown", "x")

    def wrong(spark, path):
        return spark.range(1)

    registry.register_source(registry.Source("wrong", schema, wrong), replace=True)
    with pytest.raises(ValueError, match="missing column"):
        registry.read_source(spark, "wrong", "x")
    fits, problems = registry.verify_rows("own", spark.range(1))
    assert not fits and len(problems) == 4


def test_registering_stores(spark, tmp_path, bars):
    assert {"feather", "parquet", "json", "jsongz"} <= set(registry.store_names())
    def gone(*_):
        return False

    with pytest.raises(ValueError, match="write must be callable") as error:
        registry.register_store(
            registry.Store("bad", None, files.load_files, gone, lambda spark: False, gone, lambda spark, path: None)
        )
    # All problems at once: what is missing, and what can't be called as it will be.
    assert "exists(spark, path)" in str(error.value) and "time_range(spark, path, schema)" in str(error.value)
    assert "delete" not in str(error.value)
    orc = registry.Store(
        "orc", lambda df, path: df.write.mode("overwrite").orc(path),
        lambda spark, path, schema: spark.read.schema(schema).orc(path),
        files.delete_files, files.files_exist, lambda spark, path: files.list_files(spark, path, "parquet"),
        lambda spark, path, schema: spark.read.schema(schema).orc(path).selectExpr(
            "min(time) AS start_time", "max(time) AS end_time"),
    )
    registry.register_store(orc, replace=True)
    path = str(tmp_path / "orc")
    registry.get_store("orc").write(bars, path)
    assert registry.get_store("orc").read(spark, path, bars.schema).count() == 3
    assert registry.get_store("orc").delete(spark, path) and not registry.get_store("orc").exists(spark, path)


@pytest.mark.parametrize("name", ["feather", "parquet", "json", "jsongz", "manifest"])
def test_every_store_keeps_the_contract(spark, tmp_path, bars, name):
    kind = registry.get_store(name)
    extension = files.EXTENSIONS.get(name, "")
    folder, path = str(tmp_path), str(tmp_path / f"x_1d{extension}")
    assert not kind.exists(spark, path) and not kind.delete(spark, path)
    assert kind.read(spark, path, bars.schema).count() == 0
    kind.write(bars, path)
    assert kind.exists(spark, path)
    assert sorted(map(repr, kind.read(spark, path, bars.schema).collect())) == sorted(map(repr, bars.collect()))
    assert [r.id for r in kind.list(spark, folder).collect()] == ["x_1d"]
    ends = bars.agg(F.min("time"), F.max("time")).first()
    assert tuple(kind.time_range(spark, path, bars.schema).first()) == tuple(ends)
    kind.write(bars.limit(0), path)  # nothing to save: what is stored stays
    assert kind.read(spark, path, bars.schema).count() == bars.count()
    assert kind.delete(spark, path) and not kind.exists(spark, path)
    assert kind.read(spark, path, bars.schema).count() == 0
    assert tuple(kind.time_range(spark, path, bars.schema).first()) == (None, None)


def test_a_failed_write_leaves_the_dataset_as_it_was(spark, tmp_path, bars):
    """Some tasks write their files, one fails: no manifest names them, and they are removed."""
    from seriesmill.sources import manifest

    path = str(tmp_path / "x")
    manifest.save(bars.repartition(2), path)
    before = manifest.entries(manifest.qualified(spark, path))
    broken = spark.range(40).repartition(4).selectExpr(
        "id", "CAST(id AS TIMESTAMP) AS time", "IF(id = 39, raise_error('lost'), 1.0D) AS value"
    )
    with pytest.raises(Exception, match="lost"):
        manifest.save(broken, path)
    assert manifest.entries(manifest.qualified(spark, path)) == before
    assert len(os.listdir(f"{path}/data")) == len(before)
    manifest.save(bars, path, append=True)
    assert manifest.load(spark, path, bars.schema).count() == 2 * bars.count()
    assert len(os.listdir(f"{path}/manifests")) == 2


def test_paths_are_resolved_by_the_session(spark, tmp_path, bars):
    from seriesmill.sources import paths

    assert paths.qualified(spark, "/a/b").startswith("file:/a/b")
    assert paths.qualified(spark, "file:///a/b") == "file:/a/b" or paths.qualified(spark, "file:///a/b") == "file:///a/b"
    with pytest.raises(ValueError, match="no scheme"):
        paths.system_of("/a/b")
    with pytest.raises(Exception, match="nowhere"):
        read_feather(spark, "nowhere://x/y", bars.schema)


def test_many_partitions_are_matched_by_a_join(spark, table, monkeypatch):
    monkeypatch.setattr(store, "_LISTED", 1)
    new = series(
        spark,
        [("spot", "ETH", "1d", f"2024-{m:02d}-01", float(m)) for m in range(1, 7)]
        + [("a/b:c", "BTC", "1h", "2024-01-01", 9.0)],
    )
    assert table.upsert(new).count() == 5
    table.delete(keys(spark, ("spot", "ETH", "1d"), ("a/b:c", "BTC", "1h")))
    assert {r.symbol for r in table.read().collect()} == {"binance:BTC/USDT"}


@pytest.mark.parametrize("listed", [1000, 0])
def test_rows_without_a_time_are_kept_once(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(store, "_LISTED", listed)
    made = store.SeriesTable(spark, str(tmp_path / "series"), PAYLOAD)
    new = series(
        spark,
        [("s", "x", "1d", None, 1.0), ("s", "x", "1d", None, 2.0),
         ("s", "x", "1d", "2024-01-01", 3.0), ("s", "y", "1d", None, 4.0)],
    ).withColumn("seq", F.col("value"))
    assert made.upsert(new, ["seq"]).count() == 3
    assert made.upsert(new, ["seq"]).count() == 0
    assert sorted(r.value for r in made.read().collect()) == [1.0, 3.0, 4.0]
    made.delete(keys(spark, ("s", "x", "1d")))
    assert [r.value for r in made.read().collect()] == [4.0]
    made.delete(keys(spark, ("s", "y", "1d")))
    assert made.read().isEmpty()


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from seriesmill.session import shared_folder

    def session(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda name, default: default),
            sparkContext=SimpleNamespace(
                master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None
            ),
        )

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))
    assert shared_folder(session("local[2]"))


# -- the index -----------------------------------------------------------------
def recount(table):
    """The index rows as the data would give them."""
    return sorted(map(repr, table.index.counted(table._scan()).select(*INDEX_COLUMNS).collect()))


INDEX_COLUMNS = ["source", "symbol", "timeframe", "month", "first_time", "last_time", "row_count", "size_bytes"]


def indexed(table):
    return sorted(map(repr, table.index_rows().select(*INDEX_COLUMNS).collect()))


def test_index_follows_every_change(spark, table):
    assert indexed(table) == recount(table) and len(indexed(table)) == 4
    table.upsert(series(spark, [("spot", "ETH", "1d", "2024-01-01", 9.0), ("spot", "ETH", "1d", "2024-01-09", 7.0),
                                ("spot", None, "1d", "2024-03-09", 7.0)]))
    assert indexed(table) == recount(table) and len(indexed(table)) == 5
    table.delete(keys(spark, ("spot", "binance:BTC/USDT", "1d")))
    assert indexed(table) == recount(table) and len(indexed(table)) == 3
    table.replace(series(spark, [("spot", "ETH", "1d", "2024-05-01", 1.5), ("new", "X", "1h", "2024-01-01", 2.5)]))
    assert indexed(table) == recount(table) and len(indexed(table)) == 4
    table.append(series(spark, [("new", "X", "1h", "2024-01-01", 2.5)]))
    table.compact(source="new", timeframe="1h", month="2024-01")
    assert indexed(table) == recount(table)
    assert table.series(source="new").first().row_count == 1
    table.delete(keys(spark, ("new", "X", "1h"), ("a/b:c", "BTC", "1h")))
    assert indexed(table) == recount(table)
    assert not table.index.notes()


def test_ends_and_counts_read_no_data_files(spark, table, plan_of):
    asked = keys(spark, ("spot", "ETH", "1d"))
    for frame in (table.series(), table.time_ranges(source="spot"), table.high_water(), table.catalog(), table.exists(asked)):
        files = {path for path in frame.inputFiles() if path.endswith(".parquet")}
        assert files and all("/_series_index/" in path for path in files)


def test_delete_reads_the_months_of_its_series_alone(spark, table, monkeypatch, plan_of):
    plans = []
    within = store.SeriesTable._within

    def seen(self, rows, columns):
        out = within(self, rows, columns)
        plans.append(plan_of(out).split("PartitionFilters: [")[1].split("DataFilters")[0].split("PushedFilters")[0])
        return out

    monkeypatch.setattr(store.SeriesTable, "_within", seen)
    table.append(series(spark, [("spot", "ETH", "1d", "2024-04-01", 1.0)]))
    table.delete(keys(spark, ("spot", "binance:BTC/USDT", "1d")))
    assert plans
    for plan in plans:
        # The plan's text cuts long lists short; the months come first.
        assert "IN (2024-02,2024-01)" in plan or "IN (2024-01,2024-02)" in plan


def test_a_table_without_an_index_gets_one(spark, table, tmp_path):
    other = store.SeriesTable(spark, str(tmp_path / "foreign"), PAYLOAD)
    other._write(other._prepared(table.read()), "append")
    assert other.index.stored() is None
    assert indexed(other) == indexed(table)
    other.append(series(spark, [("spot", "ETH", "1d", "2024-04-01", 1.0)]))
    assert other.index.stored() is not None
    assert indexed(other) == recount(other)


def test_an_append_cut_short_is_counted_anew(spark, table):
    """Data written and index not: readers count it, the next writer settles it."""
    rows = table._prepared(series(spark, [("spot", "ETH", "1d", "2024-01-05", 1.0), ("spot", "SOL", "1d", "2024-07-01", 1.0)]))
    staged = store.written(rows, "cut")
    table.index.begin(staged)
    table._write(staged, "append")
    assert indexed(table) == recount(table) and len(indexed(table)) == 5
    assert len(table.index.notes()) == 1
    table.append(series(spark, [("spot", "ETH", "1d", "2024-08-01", 1.0)]))
    assert not table.index.notes()
    assert indexed(table) == recount(table) and len(indexed(table)) == 6


@pytest.mark.parametrize("done", [False, True])
def test_a_rewrite_cut_short_is_done_again(spark, table, monkeypatch, done):
    """Lost after its note: with or without the data swapped, the next writer finishes it."""
    swap = store.SeriesTable._swap

    def lost(self, note):
        if done:
            self._write(self.spark.read.schema(self._stored).parquet(note["staged"]), "overwrite")
        raise RuntimeError("lost")

    monkeypatch.setattr(store.SeriesTable, "_swap", lost)
    with pytest.raises(RuntimeError):
        table.delete(keys(spark, ("spot", "binance:BTC/USDT", "1d")))
    monkeypatch.setattr(store.SeriesTable, "_swap", swap)
    assert indexed(table) == recount(table)  # before: nobody is told of rows that are not there
    table.settle()
    assert indexed(table) == recount(table)
    assert table.read(symbols=["binance:BTC/USDT"]).count() == 0
    assert table.read(symbols=["ETH"]).count() == 1


def test_tail_over_all_series_reads_the_newest_months(spark, table, plan_of):
    assert [r.value for r in table.tail(1).collect()] == [2.0]
    assert ">= 2024-02)" in plan_of(table.tail(1))
    assert sorted(r.value for r in table.tail(4).collect()) == [1.0, 2.0, 3.0, 4.0]
    assert table.tail(0).count() == 0
    assert table.tail(99).count() == 4
    assert [r.value for r in table.tail(5, source="spot", symbol="ETH", timeframe="1d").collect()] == [3.0]


def test_feather_batches_are_skipped_by_their_ranges(spark, tmp_path, monkeypatch):
    """A range reads the record batches it lies in, and filters give the rows they would without ranges."""
    from seriesmill.sources import feather

    monkeypatch.setattr(feather, "_ROWS_PER_BATCH", 100)
    path = str(tmp_path / "many.feather")
    rows = spark.range(1000).coalesce(1).selectExpr(
        "id AS n", "CAST(id * 86400 AS TIMESTAMP) AS time", "CONCAT('s', LPAD(CAST(id AS STRING), 4, '0')) AS name",
        "IF(id % 250 = 7, CAST('NaN' AS DOUBLE), CAST(id AS DOUBLE)) AS x", "IF(id < 300, NULL, id) AS late",
    )
    feather.register(spark)
    writer = feather._Writer(path, True)
    message = writer.write(b for b in rows.toArrow().to_batches())
    writer.commit([message])
    assert [p.stop for p in feather._Reader(path, rows.schema).partitions()] == [-1]  # one whole file

    def batches(**between):
        return [(p.first, p.stop) for p in feather._Reader(path, rows.schema, between).partitions()]

    assert batches(n=[250, 419]) == [(2, 5)]
    assert batches(name=["s0733", "s0733"], n=[None, 800]) == [(7, 8)]
    assert batches(late=[None, 310]) == [(3, 4)] and batches(n=[5000, None]) == [(0, 0)]
    at = datetime.datetime
    for between, test in (
        ({"n": (250, 419)}, "n BETWEEN 250 AND 419"),
        ({"time": (at(1970, 6, 1), at(1970, 6, 5, tzinfo=datetime.timezone.utc))},
         "time BETWEEN TIMESTAMP '1970-06-01' AND TIMESTAMP '1970-06-05'"),
        ({"name": ("s0733", None), "x": (None, 900.0)}, "name >= 's0733' AND x <= 900"),
        ({"late": (None, 310)}, "late <= 310"),
        ({"n": (5000, None)}, "n >= 5000"),
    ):
        found = read_feather(spark, path, rows.schema, between=between)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, rows.filter(test).collect())), test
    # Replacing a dataset replaces its ranges.
    feather.write_feather(rows.limit(10), path)
    assert len([f for f in os.listdir(path) if f.endswith(".ranges")]) == len([f for f in os.listdir(path) if f.endswith(".feather")])


def test_writes_leave_no_intermediate_tables(spark, table):
    from seriesmill.session import scratch, shared_folder, work_path

    def there():
        return {n for n in os.listdir(shared_folder(spark)) if not n.startswith(".") and "-" in n and len(n) > 33}

    before = there()
    table.append(series(spark, [("spot", "ETH", "1d", "2024-01-05", 1.0)]))
    table.replace(series(spark, [("spot", "ETH", "1d", "2024-05-01", 1.5)]))
    table.delete(keys(spark, ("a/b:c", "BTC", "1h")))
    table.compact(source="spot", timeframe="1d", month="2024-01")
    left = {n.rsplit("-", 1)[0] for n in there() - before}
    assert not left & {"staged", "series-counts", "emptied", "replacing"}
    with scratch(spark):
        inner = work_path(spark, "inner")
        spark.range(3).write.parquet(inner)
    assert not os.path.exists(inner)


def test_an_unstable_input_is_read_once(spark, table):
    """Random months: every row that is added lies in a partition that was looked at, and the index agrees."""
    new = spark.range(40).select(
        F.lit("spot").alias("source"), F.lit("R").alias("symbol"), F.lit("1d").alias("timeframe"),
        F.expr("TIMESTAMP '2024-01-01' + make_interval(0, CAST(floor(rand() * 12) AS INT), 0, CAST(id AS INT) % 28)").alias("time"),
        F.rand().alias("value"),
    )
    added = table.upsert(new)
    stored = table.read(symbols=["R"])
    assert sorted(map(repr, added.select(*stored.columns).collect())) == sorted(map(repr, stored.collect()))
    assert indexed(table) == recount(table)
