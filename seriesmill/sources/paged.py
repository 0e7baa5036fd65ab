"""A source whose partitions are the pages of a plan.

An own source that answers requests page by page, such as a venue's history, is a
function ``fetch(page)`` that returns the rows of one page.  The plan is a table: one
row a page, written by ``write_plan`` in files of at most ``pages_per_task`` pages.  Every
plan file is one partition; the task that reads it opens the file and fetches its
pages, so neither driver nor plan has to hold all of them.

As a stream, plans lie side by side in numbered rounds, and the offset is the number
of the last round that was read: a round added to the folder is the next batch, and a
query that starts again goes on after the last round it finished.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from seriesmill.sources.paths import list_below, qualified, system_of

PAGES_PER_TASK = 100
_DEALT = 10
_ROUND = "round="


@dataclass
class PlanFile(InputPartition):
    uri: str


def write_plan(pages: DataFrame, path: str, *, pages_per_task: int = PAGES_PER_TASK) -> int:
    """Add the pages of a plan as the next round of the plan folder; returns its number.

    Pages are dealt out by series and number, ``_DEALT`` of a series at a time, so that no
    task has only one venue's or one long series' pages, and a source that keeps what
    it has opened can answer several pages from it.
    """
    number = last_round(qualified(pages.sparkSession, path)) + 1
    series = [F.col(c) for c in pages.columns if c in ("source", "symbol", "timeframe")]
    block = [F.floor(F.col("page_no") / _DEALT)] if "page_no" in pages.columns else []
    order = ["page_no"] if block else []
    deal = F.xxhash64(*(series + block or pages.columns))
    # Files, not tasks of the write, are the partitions of the source: as many tasks write them as the session likes.
    (
        pages.withColumn("_deal", deal)
        .repartition("_deal")
        .sortWithinPartitions("_deal", *series, *order)
        .drop("_deal")
        .write.option("maxRecordsPerFile", pages_per_task)
        .parquet(f"{path}/{_ROUND}{number:08d}")
    )
    return number


def rounds(uri: str) -> list[int]:
    """The finished rounds of a plan folder; Spark marks a finished one with a file."""
    from pyarrow import fs

    system, root = system_of(uri)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    names = [f.base_name for f in found if f.type == fs.FileType.Directory and f.base_name.startswith(_ROUND)]
    done = [n for n in names if system.get_file_info(f"{root}/{n}/_SUCCESS").type == fs.FileType.File]
    return sorted(int(n.removeprefix(_ROUND)) for n in done)


def last_round(uri: str) -> int:
    return max(rounds(uri), default=-1)


def plan_files(uri: str, after: int, upto: int) -> list[PlanFile]:
    scheme = uri.partition(":")[0]
    out = []
    for number in rounds(uri):
        if after < number <= upto:
            out += [PlanFile(f"{scheme}:{path}" if scheme == "file" else f"{scheme}://{path}")
                    for path, _ in list_below(f"{uri}/{_ROUND}{number:08d}", ".parquet")]
    return out


def paged_source(name: str, schema: T.StructType, fetch: Callable[[dict], Iterable[dict]]) -> type[DataSource]:
    """A data source class to register with ``spark.dataSource.register``.

    ``fetch`` gets a row of the plan as a dict and returns rows as dicts of the columns of
    ``schema``; it runs in tasks, and again if a task is lost, so it must only read.
    Load with ``format(name)`` and the plan folder as ``path``, see :func:`read_pages`.
    """

    def rows(partition: PlanFile) -> Iterator[tuple]:
        import pyarrow.parquet as pq

        names = schema.fieldNames()
        system, path = system_of(partition.uri)
        with system.open_input_file(path) as handle:
            for batch in pq.ParquetFile(handle).iter_batches(batch_size=64):
                for page in batch.to_pylist():
                    for row in fetch(page):
                        yield tuple(row.get(f) for f in names)

    class Reader(DataSourceReader):
        def __init__(self, uri: str):
            self.uri = uri

        def partitions(self):
            return plan_files(self.uri, -1, last_round(self.uri)) or [PlanFile("")]

        def read(self, partition):
            return rows(partition) if partition.uri else iter(())

    class StreamReader(DataSourceStreamReader):
        def __init__(self, uri: str):
            self.uri = uri

        def initialOffset(self):
            return {"round": -1}

        def latestOffset(self):
            return {"round": last_round(self.uri)}

        def partitions(self, start, end):
            return plan_files(self.uri, start["round"], end["round"]) or [PlanFile("")]

        def read(self, partition):
            return rows(partition) if partition.uri else iter(())

        def commit(self, end):
            pass  # plans stay; the checkpoint knows how far the query is

    class Paged(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader(self.options["path"])

        def streamReader(self, schema):
            return StreamReader(self.options["path"])

    return Paged


def read_pages(spark: SparkSession, source: type[DataSource], path: str) -> DataFrame:
    """All pages of the plan folder at ``path``."""
    spark.dataSource.register(source)
    return spark.read.format(source.name()).load(qualified(spark, path))


def stream_pages(spark: SparkSession, source: type[DataSource], path: str) -> DataFrame:
    """The pages of the plan folder as a stream, a batch for the rounds that were added."""
    spark.dataSource.register(source)
    return spark.readStream.format(source.name()).load(qualified(spark, path))


ROWS_PER_BUCKET = 100_000
# Row groups of a landed history: what a page reads at least.
_ROW_GROUP = 256 << 10
_BUCKETS = "buckets="
_AT = "_at"


def land_history(rows: DataFrame, path: str) -> None:
    """Rows of many symbols as a history that :func:`landed_pages` answers from.

    Symbols lie in buckets, whose number follows the rows, in order of symbol and time, so
    that what a page opens and reads does not grow with the history.
    """
    buckets = max(1, -(-rows.count() // ROWS_PER_BUCKET))
    by = ["bucket", "symbol", _AT]
    (
        rows.withColumn("bucket", F.crc32(F.col("symbol")) % buckets)
        .withColumn(_AT, F.unix_micros(F.col("time").cast("timestamp")))
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .write.option("parquet.block.size", _ROW_GROUP)
        .partitionBy("bucket")
        .parquet(f"{path}/{_BUCKETS}{buckets}")
    )


def landed_pages(uri: str, columns: list[str]) -> Callable[[dict], list[dict]]:
    """A ``fetch`` over a history that :func:`land_history` wrote.

    Gives the first ``page_limit`` rows from ``page_start_ms`` to ``page_end_ms``, both
    ends included, in order of time, as a venue would.
    """
    payload = [c for c in columns if c != "time"]
    held: dict = {}

    def row_groups(symbol: str) -> list[tuple]:
        """(path, number, symbols, times) of the row groups of a symbol's bucket, kept while pages ask for the same one."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, root = system_of(uri)
        if "folder" not in held:
            (held["folder"],) = [f.base_name for f in system.get_file_info(fs.FileSelector(root)) if _BUCKETS in f.base_name]
        bucket = zlib.crc32(symbol.encode()) % int(held["folder"].removeprefix(_BUCKETS))
        if held.get("bucket") == bucket:
            return held["groups"]
        groups = []
        for path, _ in list_below(f"{uri}/{held['folder']}/bucket={bucket}", ".parquet"):
            with system.open_input_file(path) as handle:
                meta = pq.ParquetFile(handle).metadata
            places = {meta.schema.column(i).name: i for i in range(len(meta.schema))}
            for number in range(meta.num_row_groups):
                known = [meta.row_group(number).column(places[name]).statistics for name in ("symbol", _AT)]
                ends = [(k.min, k.max) if k is not None and k.has_min_max else None for k in known]
                groups.append((path, number, *ends))
        held.update(bucket=bucket, groups=groups, tables={})
        return groups

    def fetch(page: dict) -> list[dict]:
        import datetime

        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        epoch = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
        symbol, start, end = page["symbol"], page["page_start_ms"] * 1000, page["page_end_ms"] * 1000
        system, _ = system_of(uri)
        found, opened = [], {}
        for path, number, symbols, times in row_groups(symbol):
            if symbols and not symbols[0] <= symbol <= symbols[1] or times and (times[1] < start or times[0] > end):
                continue
            table = held["tables"].get((path, number))
            if table is None:
                with system.open_input_file(path) as handle:
                    table = pq.ParquetFile(handle).read_row_group(number, ["symbol", _AT, *payload], use_threads=False)
            opened[path, number] = table
            own = pc.equal(table["symbol"], symbol)
            inside = pc.and_(pc.greater_equal(table[_AT], start), pc.less_equal(table[_AT], end))
            found += table.filter(pc.and_(own, inside)).to_pylist()
        held["tables"] = opened
        found.sort(key=lambda row: row[_AT])
        return [
            {**row, "timeframe": page["timeframe"], "page_no": page["page_no"],
             "time": epoch + datetime.timedelta(microseconds=row[_AT])}
            for row in found[: page["page_limit"]]
        ]

    return fetch
