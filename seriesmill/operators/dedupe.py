"""One row per key, chosen by an explicit order.

``row_number() = 1`` lets Spark cut each key down to one row inside every map
task, before the shuffle, so a key with any number of copies costs one row per
map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key under ``order``, which must break all ties."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return keep_one(df, keys, [F.col(c).asc() for c in order])


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return keep_one(df, keys, [F.col(c).desc() for c in order])
