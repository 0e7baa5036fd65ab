"""Token ids in Parquet list columns, and selective reads of them.

Ids are dictionary encoded (a vocabulary of 50,000 ids takes 16 bits an id),
integers beside them delta encoded; rows lie in ascending ``doc_id`` order with
row groups and pages of set sizes and a page index, so a read of a few
documents or of the metadata alone touches a small part of the files.

Defined results: a null text is empty and holds the end id alone; null
``doc_id`` comes first; repeated ``doc_id`` keep all their rows, in the order of
a hash of their texts; an empty table gives files without rows; other columns
of the input, whatever their names, are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesmill.llm.tokens import END_ID, encoded
from seriesmill.session import work_path

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
FILE_SCHEMA = "doc_id long, part int, before long, n_tokens long, ids array<int>"


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = END_ID,
    text: str = "text",
    key: str = "doc_id",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Encode every whole text and write the ids below ``path``.

    One range exchange of the texts puts them in order; the ids never cross an
    exchange.  ``part`` and ``before`` say where in the order a document's ids
    lie: tokens of lower parts, and of earlier documents of its own part.
    """

    def ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for block, own, ends in encoded(batches, "text", tokenizer, end_id):
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array(np.full(block.num_rows, part, np.int32)),
                    pa.array(before + ends[:-1]),
                    pa.array(np.diff(ends)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(own.view(np.int32))),
                ],
                names=["doc_id", "part", "before", "n_tokens", "ids"],
            )
            before += int(ends[-1])

    (
        docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(F.col("doc_id"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .mapInArrow(ids, FILE_SCHEMA)
        .write.option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.enable.dictionary", "true")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("compression", "snappy")
        .parquet(path)
    )


def read_tokens(
    spark: SparkSession, path: str, condition: Column | None = None, columns: list[str] | None = None
) -> DataFrame:
    """Rows of the files with ``start``, the number of ids of all documents before.

    The starts come from ``part`` and ``n_tokens`` alone: their sums, one row for
    each part, are the only thing that is broadcast.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("first"))
    rows = files if condition is None else files.filter(condition)
    rows = rows.join(F.broadcast(firsts), "part").withColumn("start", F.col("first") + F.col("before"))
    return rows.select(*(columns or ["doc_id", "start", "n_tokens", "ids"]))


def crc32_of_ids(rows: DataFrame, schema: str, ids: str = "ids") -> DataFrame:
    """The rows with ``ids`` replaced by ``ids_crc32`` of them as little-endian 32-bit numbers."""
    names = [c for c in rows.columns if c != ids]

    def crc(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(ids)
            values = column.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            ends = column.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sums, pa.int64())],
                names=[*names, "ids_crc32"],
            )

    return rows.mapInArrow(crc, schema)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents to the shared folder, read them back: start, length and checksum."""
    spark = docs.sparkSession
    path = work_path(spark, "token-files")
    write_tokens(docs, path, tokenizer)
    return crc32_of_ids(
        read_tokens(spark, path), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
