"""Series as JSON documents, the shape of a key-value store.

A document is one JSON array of records with ISO times.  Long series become
several documents in time order, so that no document, and no task, holds more
than a fixed number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.timerange import between
from seriesmill.operators.matching import null_safe_join
from seriesmill.plans.skew import PIECE, ROWS_PER_TASK, cut_pieces, split_series

ROWS_PER_DOCUMENT = 1000
# Row groups of stored documents, small enough that an index entry rules out few bytes at a time.
_ROW_GROUP = 8 << 20
DOCUMENT_INDEX = T.StructType(
    [
        T.StructField("doc_no", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("first_time", T.TimestampType()),
        T.StructField("last_time", T.TimestampType()),
    ]
)
_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _record(df: DataFrame, payload: list[str]):
    return F.struct(
        *[
            F.date_format(c, _ISO).alias(c)
            if isinstance(df.schema[c].dataType, T.TimestampType)
            else F.col(c)
            for c in payload
        ]
    )


def to_documents(
    df: DataFrame,
    series: list[str],
    payload: list[str],
    order: list[str],
    *,
    rows_per_document: int = ROWS_PER_DOCUMENT,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """(series, doc_no, payload, n_rows, first_time, last_time) documents.

    First and last time are the index of a document: a reader looking for a
    range opens only the documents it touches.
    """
    split = split_series(df, series, rows_per_task)
    row = F.row_number().over(Window.partitionBy(*series).orderBy(*order))
    numbered = split.ordinary.withColumn("_row", row)
    if split.long is not None:
        pieces = cut_pieces(split.long, series, order, split.long_rows, rows_per_task)
        numbered = numbered.unionByName(_numbered_through(pieces, series, order))
    return _grouped(numbered, series, payload, rows_per_document)


def _numbered_through(pieces: DataFrame, series: list[str], order: list[str]) -> DataFrame:
    """Rows of cut series numbered as if they had not been cut: the rows of earlier pieces count."""
    earlier = Window.partitionBy(*series).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        pieces.groupBy(*series, PIECE)
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*series, PIECE).orderBy(*order)
    numbered = pieces.withColumn("_row", F.row_number().over(inside))
    joined = null_safe_join(numbered, before, [*series, PIECE], "left")
    return joined.withColumn("_row", F.col("_row") + F.col("_before")).drop(PIECE, "_before")


def _grouped(numbered, series, payload, rows_per_document):
    keyed = numbered.select(
        *series,
        F.expr(f"(_row - 1) div {rows_per_document}").alias("doc_no"),
        "time",
        F.struct("_row", _record(numbered, payload).alias("record")).alias("_item"),
    )
    grouped = keyed.groupBy(*series, "doc_no").agg(
        F.sort_array(F.collect_list("_item")).alias("_items"),
        F.count("*").alias("n_rows"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
    )
    return grouped.select(
        *series,
        "doc_no",
        F.to_json(F.col("_items.record"), {"ignoreNullFields": "false"}).alias("payload"),
        "n_rows",
        "first_time",
        "last_time",
    )


def from_documents(documents: DataFrame, series: list[str], payload: T.StructType) -> DataFrame:
    """The rows of JSON documents, one per record, with the declared types."""
    records = F.from_json("payload", T.ArrayType(payload))
    return documents.select(*series, F.inline(records))


# -- stored documents and their index -------------------------------------------
def save_documents(documents: DataFrame, series: list[str], path: str) -> None:
    """Documents as Parquet, in order of series and time, so that the index columns skip row groups."""
    by = [*series, "first_time", "doc_no"]
    ordered = documents.repartitionByRange(*by).sortWithinPartitions(*by)
    ordered.write.mode("overwrite").option("parquet.block.size", _ROW_GROUP).parquet(path)


def load_documents(spark: SparkSession, series: list[str], path: str) -> DataFrame:
    keys = [T.StructField(k, T.StringType()) for k in series]
    return spark.read.schema(T.StructType([*keys, *DOCUMENT_INDEX.fields])).parquet(path)


def read_range(documents: DataFrame, series: list[str], payload: T.StructType, *, start=None, end=None) -> DataFrame:
    """Rows within an inclusive range, from the documents that overlap it alone.

    Overlap is told by the index before any payload is parsed, and reaches the scan.
    Records hold milliseconds, so a document's first time counts from its millisecond on.
    """
    touched = documents
    if start is not None:
        touched = touched.filter(F.col("last_time") >= F.lit(start).cast("timestamp"))
    if end is not None:
        touched = touched.filter(F.col("first_time") < F.lit(end).cast("timestamp") + F.expr("INTERVAL 1 MILLISECOND"))
    return from_documents(touched, series, payload).filter(between(F.col("time"), start, end))


def read_last(documents: DataFrame, series: list[str], payload: T.StructType, n: int) -> DataFrame:
    """The last ``n`` rows of every series, from its last documents alone.

    The index tells how many rows lie behind a document; one with ``n`` or more is not
    parsed, and of the first one that is needed just the last records are taken.
    """
    behind = Window.partitionBy(*series).orderBy(F.col("doc_no").desc()).rowsBetween(Window.unboundedPreceding, -1)
    index = documents.select(*series, "doc_no", F.coalesce(F.sum("n_rows").over(behind), F.lit(0)).alias("_behind"))
    keys = [*series, "doc_no"]
    needed = index.filter(F.col("_behind") < n)
    records = F.from_json("payload", T.ArrayType(payload))
    found = null_safe_join(documents.select(*keys, "payload", "n_rows"), needed, keys, "left").filter("_behind IS NOT NULL")
    skipped = F.greatest(F.lit(0), F.col("n_rows") + F.col("_behind") - n).cast("int")
    last = F.slice(records, skipped + 1, F.greatest(F.lit(1), F.col("n_rows").cast("int")))
    return found.select(*series, F.inline(last))
