"""Continuous ingest: landed files into the series table, and streaming cleanup."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from seriesmill.functions.timeframe import milliseconds_of
from seriesmill.operators.bars import bar_columns, order_key
from seriesmill.schemas import SERIES_KEYS, columns
from seriesmill.session import scratch, written
from seriesmill.sources.store import SeriesTable

AUDIT = columns(
    run_id=T.StringType(),
    batch_id=T.LongType(),
    source=T.StringType(),
    symbol=T.StringType(),
    timeframe=T.StringType(),
    rows_in=T.LongType(),
    rows_new=T.LongType(),
    first_time=T.TimestampType(),
    last_time=T.TimestampType(),
    status=T.StringType(),
)


def landing_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_batch: int | None = None,
    bytes_per_batch: str | int | None = None,
) -> DataFrame:
    """New files of a landing folder as a stream with a fixed schema.

    A batch takes all files that are there unless it is bounded by files or by bytes;
    a folder with a long backlog should be.
    """
    if files_per_batch and bytes_per_batch:
        raise ValueError("a batch is bounded by files or by bytes")
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.load(path)


def audit_rows(batch: DataFrame, added: DataFrame, batch_id: int, run_id: str = "") -> DataFrame:
    """One row per series of a batch: rows in, rows new, time range, status."""
    marked = batch.select(*SERIES_KEYS, "time", F.lit(0).alias("_new")).unionByName(
        added.select(*SERIES_KEYS, "time", F.lit(1).alias("_new"))
    )
    new = F.sum("_new")
    return marked.groupBy(*SERIES_KEYS).agg(
        F.lit(run_id).alias("run_id"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        (F.count("*") - new).alias("rows_in"),
        new.alias("rows_new"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
        F.when(new > 0, "completed").otherwise("idle").alias("status"),
    ).select(*AUDIT.fieldNames())


def ingest(
    rows: DataFrame,
    table: SeriesTable,
    checkpoint: str,
    *,
    arrival: list[str] | None = None,
    audit_path: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Upsert a stream of rows into ``table``; first stored row of a key wins.

    A batch that is run again after a failure adds nothing twice: the upsert
    skips stored keys.  The audit lies by run, which is the id that the
    checkpoint keeps, and batch.  It is written before the rows are stored; a
    batch that then finds all its rows stored has been through before, and
    leaves its audit as it is.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            # The source is read once; what follows looks at the stored batch.
            keep(written(batch, "batch"), batch_id)

    def keep(batch: DataFrame, batch_id: int) -> None:
        added = table.new_rows(batch, arrival)
        if audit_path is not None:
            run_id = run_of(batch.sparkSession, checkpoint)
            path = f"{audit_path}/run_id={run_id}/batch_id={batch_id}"
            if not (added.isEmpty() and _written(batch.sparkSession, path)):
                audit_rows(batch, added, batch_id, run_id).drop("run_id", "batch_id").write.mode("overwrite").parquet(path)
        table.add_rows(added)

    return _start(rows, checkpoint, trigger, store)


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that a checkpoint belongs to."""
    text = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0]
    return json.loads(text)["id"]


def _written(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False


def _start(
    rows: DataFrame,
    checkpoint: str,
    trigger: dict | None,
    store: Callable[[DataFrame, int], None],
) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def first_arrivals(
    rows: DataFrame, keys: list[str], delay: str, *, time: str = "time"
) -> DataFrame:
    """One row per key among rows that arrive within ``delay`` of each other.

    State is dropped once the watermark passes; a key that is already stored
    is the business of :meth:`SeriesTable.upsert`.
    """
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def first_wins(rows: DataFrame, keys: list[str], arrival: list[str], delay: str, *, time: str = "time") -> DataFrame:
    """Of the rows of each key the one that is first by ``arrival``, once no earlier one can come.

    ``keys`` include the event time, so all rows of a key lie at one time.  A key is
    held until the watermark, ``delay`` behind the latest time, has passed it; whichever
    file or batch a row comes in, the least arrival wins, and of equal ones the least row.
    State is one row per key, kept by the JVM.
    """
    if time not in keys:
        raise ValueError(f"keys must include {time!r}; see first_by_key")
    rest = [c for c in rows.columns if c not in keys]
    order = F.struct(*arrival, *[c for c in rest if c not in arrival])
    first = F.min_by(F.struct(*rest), order).alias("_first")
    return (
        rows.withWatermark(time, delay)
        .groupBy(*keys)
        .agg(first)
        .select(*[F.col(f"_first.{c}").alias(c) if c in rest else F.col(c) for c in rows.columns])
    )


class _FirstArrival(StatefulProcessor):
    """Holds the least row of a key by ``order`` until its timer fires."""

    def __init__(self, names: list[str], order: list[str], time: str, schema: T.StructType):
        self._names, self._order, self._time, self._schema = names, order, time, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._first = handle.getValueState("first", self._schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(rows, ignore_index=True).sort_values(self._order, kind="stable").iloc[:1]
        if self._first.exists():
            held = pd.DataFrame([list(self._first.get())], columns=self._names)
            found = pd.concat([held, found], ignore_index=True).sort_values(self._order, kind="stable").iloc[:1]
        else:
            # The key stays open until the watermark reaches the time of the row that came first.
            at = found[self._time].iloc[0]
            self._handle.registerTimer(int(pd.Timestamp(at).value // 1_000_000))
        self._first.update(tuple(found[self._names].iloc[0].tolist()))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._first.get()
        self._first.clear()
        yield pd.DataFrame([list(held)], columns=self._names)

    def close(self) -> None:
        pass


def first_by_key(rows: DataFrame, keys: list[str], arrival: list[str], delay: str, *, time: str = "time") -> DataFrame:
    """As :func:`first_wins` for keys without the event time, such as an id that is sent again later.

    A key is held from its first row until the watermark reaches that row's time, then
    the least arrival so far comes out and the key is forgotten.  Arbitrary keyed state
    with an event-time timer; the session needs the RocksDB state store.
    """
    rest = [c for c in rows.columns if c not in arrival]
    processor = _FirstArrival(rows.columns, [*arrival, *rest], time, rows.schema)
    return (
        rows.withWatermark(time, delay)
        .groupBy(*keys)
        .transformWithStateInPandas(processor, rows.schema, "Append", "EventTime")
    )


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def closed_bars(
    rows: DataFrame,
    series: list[str],
    timeframe: str,
    delay: str,
    *,
    time: str = "time",
    value: str = "value",
    tie_break: str = "seq",
) -> DataFrame:
    """Bars of a stream, each emitted once, after the watermark has passed its end.

    ``1w`` bars start on Monday, all others count from the epoch.
    """
    width = f"{milliseconds_of(timeframe)} milliseconds"
    offset = "4 days" if timeframe == "1w" else "0 seconds"
    window = F.window(time, width, width, offset)
    return (
        rows.withWatermark(time, delay)
        .groupBy(*series, window.alias("_bar"))
        .agg(*bar_columns(value, order_key(rows, [time, tie_break]), rows.schema[value].dataType))
        .select(
            *series,
            F.col("_bar.start").alias("time"),
            "open",
            "high",
            "low",
            "close",
            "volume",
        )
    )


def to_parquet(
    rows: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
