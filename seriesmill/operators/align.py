"""Bringing several feeds of a symbol onto one time axis.

The relational meaning is a chain of full outer joins on (series, time).  It
is computed as one grouping of the feeds in long form: a single shuffle
instead of one or two per feed, and repeated keys of a feed are settled in
the same pass (the highest ``seq`` wins).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators.ordered import fill_ordinary, fill_pieces
from seriesmill.plans.skew import PIECE, ROWS_PER_TASK, cut_pieces, split_series


def whole_second(time: Column) -> Column:
    """Drop the fraction of a second, so that feeds meet on the same time."""
    return F.date_trunc("second", time)


def _is_struct(df: DataFrame, name: str) -> bool:
    return name in df.columns and isinstance(df.schema[name].dataType, T.StructType)


def long_form(feeds: dict[str, DataFrame], series: list[str], seq: str = "seq") -> DataFrame:
    """Feeds with columns (series, time, value[, seq]) under each other, tagged by name.

    ``seq`` is a number or any one type that has an order, the same for all
    feeds.  A feed without it gets 0 and must have unique keys.
    """
    parts = []
    for name, df in feeds.items():
        order = F.col(seq) if seq in df.columns else F.lit(0)
        parts.append(
            df.select(
                *series,
                "time",
                F.lit(name).alias("feed"),
                F.col("value").cast("double").alias("value"),
                (order if _is_struct(df, seq) else order.cast("bigint")).alias("seq"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _feed_columns(feeds: list[str]) -> list[Column]:
    here = F.col("feed")
    return [
        F.max_by(F.when(here == f, F.col("value")), F.when(here == f, F.col("seq"))).alias(f)
        for f in feeds
    ]


def align_feeds(long: DataFrame, series: list[str], feeds: list[str]) -> DataFrame:
    """One row per (series, time), one column per feed, null where a feed has no value."""
    return long.groupBy(*series, "time").agg(*_feed_columns(feeds))


def align_and_fill(
    long: DataFrame,
    series: list[str],
    feeds: list[str],
    *,
    backward: bool = False,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Align feeds, then carry values forward (and, if asked, backward).

    Ordinary series are partitioned by series once; grouping and filling both
    run on that partitioning.  Long series are grouped first, with map-side
    combining, and then filled piece by piece.
    """
    split = split_series(long, series, rows_per_task)
    together = split.ordinary.repartition(*series)
    filled = fill_ordinary(
        align_feeds(together, series, feeds), series, ["time"], feeds, backward=backward
    )
    if split.long is None:
        return filled
    pieces = cut_pieces(
        align_feeds(split.long, series, feeds), series, ["time"], split.long_rows, rows_per_task
    )
    return filled.unionByName(fill_pieces(pieces, series, ["time"], feeds, backward=backward))


def full_outer(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """The literal chain of full outer joins, for a few wide frames with unique keys."""
    return reduce(lambda left, right: left.join(right, keys, "full_outer"), frames)
