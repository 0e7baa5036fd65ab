"""Merging newly fetched rows into stored series.

Stored rows win over new rows with the same key, and the first new row wins
over later ones.  A merge therefore never changes a stored row; it comes down
to finding the new rows whose key is not stored yet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.dedupe import keep_first


def union_pages(pages: list[DataFrame]) -> DataFrame:
    """Pages under each other by column name; columns a page lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def rows_to_add(
    stored: DataFrame, new: DataFrame, keys: list[str], arrival: list[str]
) -> DataFrame:
    """First new row of every key that is not stored.

    The join runs on the whole key, time included, so a series that makes up
    much of the table is still spread over all tasks.  The key is one struct:
    structs with a null at the same place are equal, and one shuffle by it
    serves both steps.  Stored keys lie in small files and are large once read, so
    they are merged in order, never broadcast: a task holds its share of them.
    """
    key = F.struct(*keys)
    first = keep_first(new.withColumn("_key", key), ["_key"], arrival)
    known = stored.select(key.alias("_key")).hint("merge")
    return first.join(known, "_key", "left_anti").drop("_key")


def merge_upsert(
    stored: DataFrame, new: DataFrame, keys: list[str], arrival: list[str]
) -> DataFrame:
    """Stored rows, unique by key, and the rows :func:`rows_to_add` finds.

    ``is_new`` tells them apart.
    """
    return stored.withColumn("is_new", F.lit(False)).unionByName(
        rows_to_add(stored, new, keys, arrival).withColumn("is_new", F.lit(True))
    )


def merge_unsettled(
    stored: DataFrame, new: DataFrame, keys: list[str], arrival: list[str]
) -> DataFrame:
    """The same merge where stored rows may repeat keys themselves."""
    both = stored.withColumn("is_new", F.lit(False)).unionByName(
        new.withColumn("is_new", F.lit(True))
    )
    return keep_first(both, keys, ["is_new", *arrival])


def upsert_summary(merged: DataFrame, series: list[str], time: str = "time") -> DataFrame:
    """Per series: rows after the merge, rows added by it, first and last time."""
    return merged.groupBy(*series).agg(
        F.count("*").alias("total"),
        F.sum(F.col("is_new").cast("bigint")).alias("added"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    )
