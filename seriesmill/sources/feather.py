"""Feather (Arrow IPC) files as a Spark data source: ``format("feather")``.

Reading splits each file by its record batches, so one large file feeds
several tasks, and only the wanted columns are decoded.  Beside each file lies a
hidden one with the least and greatest value of every column in every record batch;
``read_feather`` leaves out batches that lie outside the ends it is given.  Writing puts files
in place only after every task has finished.  ``read_feather`` and ``write_feather``
resolve the path by the session's file systems; it must be shared by all executors.
"""

from __future__ import annotations

import datetime
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from seriesmill.sources.paths import qualified, system_of

_ROWS_PER_BATCH = 64 * 1024
_BYTES_PER_TASK = 128 << 20
_EPOCH = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)


def _arrow_types() -> dict:
    """Spark type name -> Arrow type; series files are flat, so this list is all of it."""
    import pyarrow as pa

    return {
        "string": pa.string(),
        "bigint": pa.int64(),
        "int": pa.int32(),
        "smallint": pa.int16(),
        "tinyint": pa.int8(),
        "double": pa.float64(),
        "float": pa.float32(),
        "boolean": pa.bool_(),
        "date": pa.date32(),
        "timestamp": pa.timestamp("us", tz="UTC"),
        "timestamp_ntz": pa.timestamp("us"),
        "binary": pa.binary(),
    }


def _spark_type(arrow_type) -> str:
    import pyarrow as pa

    if pa.types.is_timestamp(arrow_type):
        return "timestamp" if arrow_type.tz else "timestamp_ntz"
    if pa.types.is_large_string(arrow_type) or pa.types.is_dictionary(arrow_type):
        return "string"
    for name, known in _arrow_types().items():
        if known == arrow_type:
            return name
    raise ValueError(f"no column type for Arrow {arrow_type}")


def _arrow_schema(schema: StructType):
    import pyarrow as pa

    types = _arrow_types()
    return pa.schema([(f.name, types[f.dataType.simpleString()]) for f in schema.fields])


def _filesystem(path: str):
    """A path that nobody has resolved is one on this machine."""
    return system_of(path if ":" in path.split("/")[0] else f"file:{path}")


def _files(path: str) -> list[tuple[str, int]]:
    from pyarrow import fs

    system, root = _filesystem(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return [(info.path, info.size)]
    if info.type == fs.FileType.NotFound:
        return []
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    return sorted(
        (f.path, f.size)
        for f in found
        if f.type == fs.FileType.File
        and f.path.endswith(".feather")
        and "/_staged-" not in f.path
    )


@dataclass
class _Batches(InputPartition):
    file: str
    first: int
    stop: int


# -- ranges of record batches ----------------------------------------------------
def _ranges_file(file: str) -> str:
    folder, _, name = file.rpartition("/")
    return f"{folder}/.{name}.ranges"


def _plain(value):
    """A value as it is kept and compared: times in microseconds, all else as it is."""
    if isinstance(value, datetime.datetime):
        zoned = value if value.tzinfo else value.replace(tzinfo=datetime.timezone.utc)
        return (zoned - _EPOCH) // datetime.timedelta(microseconds=1)
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _ranges(batch) -> dict:
    """{column: [least, greatest]} of the columns that have an order; without nulls and NaN."""
    import pyarrow as pa
    import pyarrow.compute as pc

    out = {}
    for name in batch.schema.names:
        column = batch.column(name)
        kind = column.type
        if pa.types.is_floating(kind):
            column = column.filter(pc.invert(pc.fill_null(pc.is_nan(column), False)))
        elif not (pa.types.is_integer(kind) or pa.types.is_temporal(kind) or pa.types.is_string(kind)):
            continue
        ends = pc.min_max(column).as_py()
        out[name] = [_plain(ends["min"]), _plain(ends["max"])]
    return out


def _may_hold(ranges: dict, between: dict) -> bool:
    """Whether a batch of these ranges may hold a row between all of the given ends, both included."""
    for name, (low, high) in between.items():
        least, greatest = ranges.get(name, (low, high))
        if least is None:
            return False  # nothing but nulls and NaN, which lie between no ends
        if (low is not None and greatest < low) or (high is not None and least > high):
            return False
    return True


class FeatherSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feather"

    def schema(self) -> str:
        import pyarrow as pa

        files = _files(self.options["path"])
        if not files:
            raise FileNotFoundError(
                f"no feather files in {self.options['path']}; give a schema to read none"
            )
        system, _ = _filesystem(self.options["path"])
        with system.open_input_file(files[0][0]) as handle:
            found = pa.ipc.open_file(handle).schema
        return ", ".join(f"`{f.name}` {_spark_type(f.type)}" for f in found)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], schema, json.loads(self.options.get("between", "{}")))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], overwrite)


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, between: dict | None = None):
        self.path, self.spark_schema, self.between = path, schema, between or {}

    def _wanted(self, system, file: str) -> list[tuple[int, int]] | None:
        """Runs of batches that may hold wanted rows; None where nothing is known."""
        from pyarrow import fs

        beside = _ranges_file(file)
        if not self.between or system.get_file_info(beside).type != fs.FileType.File:
            return None
        with system.open_input_stream(beside) as handle:
            ranges = json.loads(handle.read())
        runs: list[tuple[int, int]] = []
        for i, own in enumerate(ranges):
            if _may_hold(own, self.between):
                if runs and runs[-1][1] == i:
                    runs[-1] = (runs[-1][0], i + 1)
                else:
                    runs.append((i, i + 1))
        return runs

    def partitions(self) -> list[InputPartition]:
        import pyarrow as pa

        parts = []
        system, _ = _filesystem(self.path)
        for file, size in _files(self.path):
            runs = self._wanted(system, file)
            if runs is not None:
                with system.open_input_file(file) as handle:
                    batches = pa.ipc.open_file(handle).num_record_batches
                step = max(1, batches * _BYTES_PER_TASK // max(size, 1))
                parts += [
                    _Batches(file, i, min(i + step, stop)) for first, stop in runs for i in range(first, stop, step)
                ]
                continue
            if size <= _BYTES_PER_TASK:
                parts.append(_Batches(file, 0, -1))
                continue
            with system.open_input_file(file) as handle:
                batches = pa.ipc.open_file(handle).num_record_batches
            step = max(1, batches * _BYTES_PER_TASK // size)
            parts += [
                _Batches(file, i, min(i + step, batches)) for i in range(0, batches, step)
            ]
        return parts or [_Batches("", 0, 0)]

    def read(self, partition: _Batches):
        import pyarrow as pa

        if not partition.file:
            return
        wanted = _arrow_schema(self.spark_schema)
        system, _ = _filesystem(self.path)
        with system.open_input_file(partition.file) as handle:
            names = pa.ipc.open_file(handle).schema.names
            keep = [names.index(n) for n in wanted.names if n in names]
            options = pa.ipc.IpcReadOptions(included_fields=keep)
            source = pa.ipc.open_file(handle, options=options)
            stop = source.num_record_batches if partition.stop < 0 else partition.stop
            for i in range(partition.first, stop):
                batch = source.get_batch(i)
                columns = [
                    batch.column(f.name).cast(f.type, safe=False)
                    if f.name in batch.schema.names
                    else pa.nulls(batch.num_rows, f.type)
                    for f in wanted
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class _Writer(DataSourceArrowWriter):
    """Tasks write below a staging folder; commit moves the files of finished tasks."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.job = uuid.uuid4().hex

    def _staging(self, root: str) -> str:
        return f"{root.rstrip('/')}/_staged-{self.job}"

    def write(self, iterator) -> WriterCommitMessage:
        import pyarrow as pa

        system, root = _filesystem(self.path)
        staging = self._staging(root)
        system.create_dir(staging, recursive=True)
        name = f"part-{uuid.uuid4().hex}.feather"
        writer, handle, ranges = None, None, []
        try:
            for batch in iterator:
                if batch.num_rows == 0:
                    continue
                if writer is None:
                    handle = system.open_output_stream(f"{staging}/{name}")
                    options = pa.ipc.IpcWriteOptions(compression="lz4")
                    writer = pa.ipc.new_file(handle, batch.schema, options=options)
                for start in range(0, batch.num_rows, _ROWS_PER_BATCH):
                    part = batch.slice(start, _ROWS_PER_BATCH)
                    writer.write_batch(part)
                    ranges.append(_ranges(part))
        finally:
            if writer is not None:
                writer.close()
                handle.close()
        if writer is None:
            return _Written([])
        with system.open_output_stream(_ranges_file(f"{staging}/{name}")) as beside:
            beside.write(json.dumps(ranges).encode())
        return _Written([name])

    def commit(self, messages) -> None:
        from pyarrow import fs

        system, root = _filesystem(self.path)
        system.create_dir(root, recursive=True)
        names = [n for m in messages if m is not None for n in m.files]
        # Saving nothing leaves a stored series as it is.
        replaced = _files(self.path) if self.overwrite and names else []
        for name in names:
            staged, final = f"{self._staging(root)}/{name}", f"{root.rstrip('/')}/{name}"
            # Ranges first: a file is never read with another one's.
            system.move(_ranges_file(staged), _ranges_file(final))
            system.move(staged, final)
        for file, _ in replaced:
            system.delete_file(file)
            if system.get_file_info(_ranges_file(file)).type == fs.FileType.File:
                system.delete_file(_ranges_file(file))
        self._clear(system, root)

    def abort(self, messages) -> None:
        self._clear(*_filesystem(self.path))

    def _clear(self, system, root: str) -> None:
        from pyarrow import fs

        staging = self._staging(root)
        if system.get_file_info(staging).type == fs.FileType.Directory:
            system.delete_dir(staging)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FeatherSource)


def read_feather(
    spark: SparkSession, path: str, schema: StructType | None = None, *, between: dict[str, tuple] | None = None
) -> DataFrame:
    """Feather files below ``path``; with a schema, a missing path is an empty frame.

    ``between`` names columns and their (least, greatest) wanted values, both included,
    None for an open end; times are datetimes, naive ones in UTC.  Record batches
    outside are not read, and of the others only the rows inside are returned.
    """
    register(spark)
    reader = spark.read.format("feather")
    if between:
        ends = {name: [_plain(low), _plain(high)] for name, (low, high) in between.items()}
        reader = reader.option("between", json.dumps(ends))
    rows = (reader.schema(schema) if schema is not None else reader).load(qualified(spark, path))
    for name, ends in (between or {}).items():
        low, high = (v if v is None else F.lit(_zoned(v)) for v in ends)
        if low is not None:
            rows = rows.filter(F.col(name) >= low)
        if high is not None:
            rows = rows.filter(F.col(name) <= high)
    return rows


def _zoned(value):
    is_time = isinstance(value, datetime.datetime)
    return value.replace(tzinfo=datetime.timezone.utc) if is_time and value.tzinfo is None else value


def write_feather(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    register(df.sparkSession)
    df.write.format("feather").mode(mode).save(qualified(df.sparkSession, path))
