"""A store of one folder per dataset, written in two phases: ``format("manifest")``.

Tasks write Parquet files and hand their names, row counts and first and last times to
the driver.  Only the driver's commit makes them part of the dataset, by one new
manifest that lists all live files and is moved into place whole.  A reader takes the
latest manifest, so it sees a dataset before or after a write and never in between;
files of a write that failed are in no manifest, and are removed.  Existence and time
range come from the manifest, without data files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from seriesmill.sources.paths import list_below, qualified, system_of

_ENTRY = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
    ]
)


def manifests(uri: str) -> list[str]:
    return [path for path, _ in list_below(f"{uri}/manifests", ".json")]


def entries(uri: str) -> list[dict]:
    """The live files of a dataset; one entry a task that wrote it."""
    known = manifests(uri)
    if not known:
        return []
    system, _ = system_of(uri)
    with system.open_input_stream(known[-1]) as handle:
        return json.loads(handle.read())


def _publish(uri: str, live: list[dict]) -> None:
    """A new manifest, written beside and moved, numbered after the latest."""
    system, root = system_of(uri)
    system.create_dir(f"{root}/manifests", recursive=True)
    known = manifests(uri)
    number = int(known[-1].rsplit("/", 1)[1].split(".")[0]) + 1 if known else 0
    beside = f"{root}/manifests/.{uuid.uuid4().hex}"
    with system.open_output_stream(beside) as handle:
        handle.write(json.dumps(live).encode())
    system.move(beside, f"{root}/manifests/{number:010d}.json")


@dataclass
class _Task(WriterCommitMessage):
    written: list[dict]


@dataclass
class _File(InputPartition):
    file: str


class ManifestSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "manifest"

    def schema(self) -> T.StructType:
        raise ValueError("a manifest dataset is read with a schema")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options["path"], schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], overwrite, self.options.get("time", "time"))


class _Reader(DataSourceReader):
    def __init__(self, uri: str, schema: T.StructType):
        self.uri, self.spark_schema = uri, schema

    def partitions(self) -> list[InputPartition]:
        return [_File(e["file"]) for e in entries(self.uri)] or [_File("")]

    def read(self, partition: _File):
        if not partition.file:
            return
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        system, root = system_of(self.uri)
        wanted = to_arrow_schema(self.spark_schema)
        with system.open_input_file(f"{root}/data/{partition.file}") as handle:
            for batch in pq.ParquetFile(handle).iter_batches(columns=wanted.names):
                yield batch.select(wanted.names).cast(wanted)


class _Writer(DataSourceArrowWriter):
    def __init__(self, uri: str, overwrite: bool, time: str):
        self.uri, self.overwrite, self.time = uri, overwrite, time
        self.job = uuid.uuid4().hex

    def write(self, iterator) -> WriterCommitMessage:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        system, root = system_of(self.uri)
        system.create_dir(f"{root}/data", recursive=True)
        # The job in the name: whatever is left of a failed write can be told from the rest.
        name = f"{self.job}-{uuid.uuid4().hex}.parquet"
        writer, rows, times = None, 0, []
        with system.open_output_stream(f"{root}/data/{name}") as handle:
            for batch in iterator:
                if writer is None:
                    writer = pq.ParquetWriter(handle, batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
                if self.time in batch.schema.names and batch.num_rows:
                    ends = pc.min_max(batch.column(self.time).cast(pa.timestamp("us", tz="UTC")).cast(pa.int64())).as_py()
                    times += [t for t in ends.values() if t is not None]
            if writer is not None:
                writer.close()
        if not rows:
            system.delete_file(f"{root}/data/{name}")
            return _Task([])
        return _Task([{"file": name, "rows": rows, "first": min(times, default=None), "last": max(times, default=None)}])

    def commit(self, messages) -> None:
        new = [e for m in messages if m is not None for e in m.written]
        if not new:
            return  # saving nothing leaves a dataset as it is
        live = [] if self.overwrite else entries(self.uri)
        _publish(self.uri, live + new)

    def abort(self, messages) -> None:
        system, root = system_of(self.uri)
        for path, _ in list_below(f"{self.uri}/data", ".parquet"):
            if path.rsplit("/", 1)[1].startswith(self.job):
                system.delete_file(path)


# -- the six methods of a store ------------------------------------------------
def save(df: DataFrame, path: str, *, append: bool = False) -> bool:
    """Store ``df`` as the dataset at ``path``; an empty frame changes nothing."""
    spark = df.sparkSession
    spark.dataSource.register(ManifestSource)
    df.write.format("manifest").mode("append" if append else "overwrite").save(qualified(spark, path))
    return True


def load(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The dataset's rows; one that is missing is an empty frame."""
    spark.dataSource.register(ManifestSource)
    return spark.read.format("manifest").schema(schema).load(qualified(spark, path))


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a dataset; False where there was none.  Readers at work keep their files."""
    if not exists(spark, path):
        return False
    _publish(qualified(spark, path), [])
    return True


def exists(spark: SparkSession, path: str) -> bool:
    return bool(entries(qualified(spark, path)))


def datasets(spark: SparkSession, path: str) -> DataFrame:
    """(id, files, rows) of every dataset right below ``path``, by the manifests alone."""
    from pyarrow import fs

    uri = qualified(spark, path)
    system, root = system_of(uri)
    folders = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    names = sorted(f.base_name for f in folders if f.type == fs.FileType.Directory)
    found = [(name, entries(f"{uri}/{name}")) for name in names]
    rows = [(name, len(live), sum(e["rows"] for e in live)) for name, live in found if live]
    return spark.createDataFrame(rows, "id string, files long, rows long")


def time_range(spark: SparkSession, path: str) -> DataFrame:
    """One row (start_time, end_time) from the manifest; nulls for a dataset that is missing."""
    live = spark.createDataFrame(entries(qualified(spark, path)), _ENTRY)
    return live.agg(
        F.timestamp_micros(F.min("first")).alias("start_time"), F.timestamp_micros(F.max("last")).alias("end_time")
    )
