"""Keeping long series out of single tasks.

A window partitioned by series puts one whole series into one task.  That is
fine until one series holds a large share of the table.  :func:`split_series`
separates the few series above a row limit from the rest; the rest keep the
plain one-shuffle window, and the long ones are cut into contiguous, evenly
sized pieces by a range exchange on (series, order).  The piece number becomes
a column, and operators pass the little state that crosses pieces through a
summary with one row per piece.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.matching import null_safe_join
from seriesmill.session import shared_folder, written

PIECE = "_piece"
ROWS_PER_TASK = 5_000_000
# Pieces smaller than this are cut several in one task, so that tasks follow rows, not pieces.
ROWS_PER_CUT = 250_000
# Keys of long series: at most rows / ROWS_PER_TASK of them exist; they are
# broadcast up to this count and shuffled beyond it.
BROADCAST_KEYS = 100_000


@dataclass
class SplitSeries:
    """Rows of ordinary series, and rows of long ones (None when there are none)."""

    ordinary: DataFrame
    long: DataFrame | None
    long_rows: int = 0


def split_series(
    df: DataFrame, series: list[str], rows_per_task: int | None = ROWS_PER_TASK
) -> SplitSeries:
    """Separate series with more than ``rows_per_task`` rows.

    One aggregation over the key columns decides; ``None`` skips it for
    callers that know their series are short.
    """
    if rows_per_task is None:
        return SplitSeries(df, None)
    counts = df.groupBy(*series).agg(F.count("*").alias("_rows"))
    is_long = F.col("_rows") > rows_per_task
    n_keys, n_rows = counts.agg(
        F.count_if(is_long), F.sum(F.when(is_long, F.col("_rows")))
    ).first()
    if not n_keys:
        return SplitSeries(df, None)
    shared_folder(df.sparkSession)
    long_keys = counts.filter(is_long).checkpoint()
    keys = long_keys.select(*series)
    if n_keys <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return SplitSeries(
        null_safe_join(df, keys, series, "left_anti"),
        null_safe_join(df, keys, series, "left_semi"),
        int(n_rows),
    )


def cut_pieces(
    df: DataFrame, series: list[str], order: list[str], rows: int, rows_per_task: int
) -> DataFrame:
    """``df`` with a piece number; pieces are contiguous in (series, order).

    The range exchange balances by sampled row counts, so one dominant series
    or one crowded stretch of time is spread like any other.  Where pieces are small, a
    task of the exchange holds many of them and cuts them by row number.  The result is
    checkpointed, because piece numbers must stay the same however often a
    task is run again.
    """
    by = [F.col(c) for c in [*series, *order]]
    tasks = max(2, -(-2 * rows // max(rows_per_task, ROWS_PER_CUT)))
    ranged = df.repartitionByRange(tasks, *by)
    piece = F.spark_partition_id().cast("long")
    if rows_per_task < ROWS_PER_CUT:
        # The task's number in the upper bits, the row's number in the lower 33: pieces end with their task.
        ranged = ranged.sortWithinPartitions(*by)
        piece = F.expr(f"monotonically_increasing_id() div {max(1, rows_per_task // 2)}")
    return written(ranged.withColumn(PIECE, piece), "pieces")
