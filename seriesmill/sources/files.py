"""Series files in the plain formats, and listings of them."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.names import format_size
from seriesmill.sources.feather import read_feather, write_feather

EXTENSIONS = {
    "feather": ".feather",
    "parquet": ".parquet",
    "json": ".json",
    "jsongz": ".json.gz",
}


def _time_as_number(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.TimestampType)
                          else f.dataType)
            for f in schema.fields
        ]
    )


def save_files(
    df: DataFrame, path: str, fmt: str = "feather", *, partition_by: list[str] | None = None
) -> bool:
    """Write ``df`` over ``path``; an empty frame writes nothing and counts as saved.

    JSON holds times as epoch milliseconds, one record per line.  Feather files
    are not partitioned; asking for it is an error.
    """
    if fmt not in EXTENSIONS:
        raise ValueError(f"unknown file format {fmt!r}")
    if fmt == "feather" and partition_by:
        raise ValueError("feather files can't be partitioned")
    if df.isEmpty():
        return True
    if fmt == "feather":
        write_feather(df, path)
        return True
    if fmt in ("json", "jsongz"):
        df = df.withColumns(
            {
                f.name: F.unix_millis(f.name)
                for f in df.schema.fields
                if isinstance(f.dataType, T.TimestampType)
            }
        )
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.json(path, compression="gzip" if fmt == "jsongz" else None)
    return True


def load_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "feather"
) -> DataFrame:
    """Files of one format with a declared schema; a missing path is an empty frame."""
    if fmt == "feather":
        return read_feather(spark, path, schema)
    try:
        if fmt == "parquet":
            return spark.read.schema(schema).parquet(path)
        if fmt in ("json", "jsongz"):
            wire = spark.read.schema(_time_as_number(schema)).json(path)
            return wire.select(
                *[
                    F.timestamp_millis(f.name).alias(f.name)
                    if isinstance(f.dataType, T.TimestampType)
                    else F.col(f.name)
                    for f in schema.fields
                ]
            )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
    raise ValueError(f"unknown file format {fmt!r}")


def list_files(spark: SparkSession, path: str, fmt: str = "feather") -> DataFrame:
    """(id, sub, file_path, size, size_bytes, modified) of every dataset below ``path``.

    A dataset is a file, or a folder of part files with any partition folders
    in it; ``sub`` is the folder it lies in, null at the top.  Contents are not
    read.
    """
    extension = EXTENSIONS[fmt]
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{extension}")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    # Part files, and the partition folders they lie in, belong to the folder above.
    dataset = F.regexp_replace("path", r"(/[^/=]+=[^/]*)*/part-[^/]*$", "")
    name = F.substring_index("dataset", "/", -1)
    top = "/" + re.sub(r"^[a-z0-9]+:(//[^/]*)?", "", path).strip("/")
    inside = F.substr("dataset", F.instr("dataset", top) + len(top) + 1)
    sub = F.substring_index(F.regexp_replace(inside, "/?[^/]*$", ""), "/", -1)
    grouped = listed.groupBy(dataset.alias("dataset")).agg(
        F.sum("length").alias("size_bytes"), F.max("modificationTime").alias("modified")
    )
    return grouped.select(
        F.regexp_replace(name, f"{re.escape(extension)}$", "").alias("id"),
        F.nullif(sub, F.lit("")).alias("sub"),
        F.col("dataset").alias("file_path"),
        format_size(F.col("size_bytes")).alias("size"),
        "size_bytes",
        "modified",
    )


def files_exist(spark: SparkSession, path: str) -> bool:
    """Whether a dataset lies at ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def delete_files(spark: SparkSession, path: str) -> bool:
    """Remove the dataset at ``path``; False where there was none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def files_time_range(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "feather", time: str = "time"
) -> DataFrame:
    """One row (start_time, end_time); nulls for a dataset that is missing or has no time column."""
    rows = load_files(spark, path, schema, fmt)
    at = F.col(time) if time in schema.fieldNames() else F.lit(None).cast("timestamp")
    return rows.agg(F.min(at).alias("start_time"), F.max(at).alias("end_time"))
