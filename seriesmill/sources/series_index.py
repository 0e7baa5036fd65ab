"""What a series table holds, by series and month, without reading its data files.

The index is a Parquet table below the series table, in a folder that scans of the
table skip.  Appending rows appends their counts, one row per series and month they
lie in; rewriting partitions replaces the index rows of just those partitions.  Reading
it adds up the rows of a series.  Its size follows the number of series and months,
not the number of rows.

Data and index can't be written in one step, so a note of every write is left beside
the index before the data changes, and removed after the index has followed.  A note
that is still there belongs to a writer at work, or to one that was lost.  Readers
count the partitions it names from the data; the next writer finishes what was begun:
a rewrite is done again from its staged rows, after an append the partitions are
counted anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators.matching import null_safe_join
from seriesmill.schemas import SERIES_KEYS, columns
from seriesmill.session import remove, written_at

MONTH = "month"
PARTITIONS = ["source", "timeframe", MONTH]
COUNTS = columns(
    first_time=T.TimestampType(),
    last_time=T.TimestampType(),
    row_count=T.LongType(),
    size_bytes=T.LongType(),
)
_BY = [*SERIES_KEYS, MONTH]
SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType()), *COUNTS.fields, *(T.StructField(c, T.StringType()) for c in PARTITIONS)]
)


def merged(rows: DataFrame, by: list[str]) -> DataFrame:
    """Index rows added up by ``by``."""
    return rows.groupBy(*by).agg(
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.sum("row_count").alias("row_count"),
        F.sum("size_bytes").alias("size_bytes"),
    )


class SeriesIndex:
    """The index of the table at ``path``; ``size`` gives the bytes of a stored row."""

    def __init__(self, spark: SparkSession, path: str, size: Callable[[DataFrame], object]):
        self.spark, self.size = spark, size
        self.path, self._notes = f"{path}/_series_index", f"{path}/_series_writes"

    # -- reading -------------------------------------------------------------
    def stored(self) -> DataFrame | None:
        """Index rows as they were written, several for a series and month; None without an index."""
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def counted(self, rows: DataFrame) -> DataFrame:
        """Index rows of stored rows: one per series and month."""
        sized = rows.withColumn("_size", self.size(rows))
        return sized.groupBy(*_BY).agg(
            F.min("time").alias("first_time"),
            F.max("time").alias("last_time"),
            F.count("*").alias("row_count"),
            F.sum("_size").cast("long").alias("size_bytes"),
        ).select(*SCHEMA.fieldNames())

    # -- notes ---------------------------------------------------------------
    def _file_system(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def notes(self) -> list[dict]:
        """Writes whose index has not followed yet, as far as anybody knows."""
        fs, folder = self._file_system(self._notes)
        if not fs.exists(folder):
            return []
        # One writer at a time leaves at most one note, or a few after lost ones.
        names = sorted(status.getPath().getName() for status in fs.listStatus(folder))
        return [self._note(name) for name in names if name.endswith(".json")]

    def _note(self, name: str) -> dict:
        text = self.spark.read.text(f"{self._notes}/{name}", wholetext=True).first()[0]
        return json.loads(text)

    def begin(self, rows: DataFrame, staged: str | None = None, emptied: DataFrame | None = None) -> dict:
        """Leave a note of a write of ``rows``, a stored table.

        ``staged`` is its path where its partitions are to be replaced by it, and
        ``emptied`` has the partitions that lose all their rows.
        """
        note = {"name": f"{uuid.uuid4().hex}.json", "staged": staged, "emptied": None}
        note["deltas"] = written_at(self.counted(rows), "series-counts")[1]
        if emptied is not None:
            note["emptied"] = written_at(emptied.select(*PARTITIONS), "emptied")[1]
        fs, path = self._file_system(f"{self._notes}/{note['name']}")
        # Written beside and moved, so that nobody reads half a note.
        beside = self._file_system(f"{self._notes}/.{note['name']}")[1]
        out = fs.create(beside, True)
        out.write(bytearray(json.dumps(note).encode()))
        out.close()
        fs.rename(beside, path)
        return note

    def end(self, note: dict) -> None:
        """The write and its index are done: the note goes, and with it the tables it names."""
        fs, path = self._file_system(f"{self._notes}/{note['name']}")
        fs.delete(path, False)
        for name in ("staged", "deltas", "emptied"):
            if note[name]:
                remove(self.spark, note[name])

    def deltas(self, note: dict) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(note["deltas"])

    def emptied(self, note: dict) -> DataFrame | None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in PARTITIONS])
        return self.spark.read.schema(schema).parquet(note["emptied"]) if note["emptied"] else None

    def touched(self, note: dict) -> DataFrame:
        """The partitions that a write changes."""
        own = self.deltas(note).select(*PARTITIONS)
        gone = self.emptied(note)
        return (own if gone is None else own.unionByName(gone)).distinct()

    # -- writing -------------------------------------------------------------
    def add(self, counts: DataFrame) -> None:
        self._write(counts, "append")

    def replace(self, counts: DataFrame) -> None:
        """Index rows of whole partitions in place of what these partitions had."""
        self._write(counts, "overwrite")

    def _write(self, counts: DataFrame, mode: str) -> None:
        # Rebalancing gives a partition one file, and several where it has very many series.
        (
            counts.select(*SCHEMA.fieldNames())
            .hint("rebalance", *PARTITIONS)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITIONS)
            .parquet(self.path)
        )

    def known(self, count_partitions: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """One row per series and month; partitions under a note are counted by ``count_partitions``."""
        rows = self.stored()
        notes = self.notes()
        if rows is None:
            rows = self.spark.createDataFrame([], SCHEMA)
        for note in notes:
            open_ = self.touched(note)
            rows = null_safe_join(rows, open_, PARTITIONS, "left_anti").unionByName(
                count_partitions(open_).select(*SCHEMA.fieldNames())
            )
        return merged(rows, _BY)

