"""What has been fetched, as sets of time intervals per series: union and difference.

An interval is half open, ``[start_ms, end_ms)``.  A set of intervals is rows of
(series, start_ms, end_ms), in any order, overlapping or not; an empty interval
covers nothing.  Both operations sweep over the end points of a series once: the
running count of open intervals tells where a set begins and ends.  End points of
one time are one row, so a time shared by very many intervals is summed up before
the sweep.

The sweep of a series with very many end points is cut into stretches of time: a
stretch starts with what is open at its beginning, which is a sum over the stretches
before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.operators.matching import null_safe_join
from seriesmill.plans.skew import PIECE, ROWS_PER_TASK, cut_pieces, split_series


def _points(intervals: DataFrame, series: list[str], name: str) -> DataFrame:
    """End points of intervals: +1 where one opens and -1 where one closes, in the column ``name``."""
    real = intervals.filter(F.col("start_ms") < F.col("end_ms"))
    ends = F.array(
        F.struct(F.col("start_ms").alias("at"), F.lit(1).cast("long").alias(name)),
        F.struct(F.col("end_ms").alias("at"), F.lit(-1).cast("long").alias(name)),
    )
    return real.select(*series, F.inline(ends))


def _swept(points: DataFrame, series: list[str], names: list[str], rows_per_task: int | None) -> DataFrame:
    """(series, at, next, names): how many intervals of each set are open from ``at`` to ``next``."""
    summed = points.groupBy(*series, "at").agg(*[F.sum(n).alias(n) for n in names])
    split = split_series(summed, series, rows_per_task)
    ahead = Window.partitionBy(*series).orderBy("at")
    open_ = [F.sum(n).over(ahead.rowsBetween(Window.unboundedPreceding, 0)).alias(n) for n in names]
    out = split.ordinary.select(*series, "at", F.lead("at").over(ahead).alias("next"), *open_)
    if split.long is None:
        return out
    pieces = cut_pieces(split.long, series, ["at"], split.long_rows, rows_per_task)
    inside = Window.partitionBy(*series, PIECE).orderBy("at")
    local = pieces.select(
        *series, PIECE, "at", F.lead("at").over(inside).alias("next"),
        *[F.sum(n).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias(n) for n in names],
    )
    between = Window.partitionBy(*series).orderBy(PIECE)
    before = between.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        pieces.groupBy(*series, PIECE)
        .agg(F.min("at").alias("_first"), *[F.sum(n).alias(f"_all_{n}") for n in names])
        .select(
            *series, PIECE, F.lead("_first").over(between).alias("_following"),
            *[F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in names],
        )
    )
    joined = null_safe_join(local, carried, [*series, PIECE], "left")
    return out.unionByName(
        joined.select(
            *series, "at", F.coalesce("next", "_following").alias("next"),
            *[(F.col(n) + F.col(f"_before_{n}")).alias(n) for n in names],
        )
    )


def _joined_up(stretches: DataFrame, series: list[str], covered: Column, rows_per_task: int | None) -> DataFrame:
    """Maximal runs of the stretches in which ``covered`` holds.

    A run starts where the stretch before, which ends where this one starts, is not
    covered; both ends of a run are rows of their own, so starts and ends are paired
    by one more sweep over the few rows where coverage changes.
    """
    marked = stretches.select(*series, "at", "next", F.coalesce(covered, F.lit(False)).alias("_in"))
    # Where a covered stretch ends at a time and another starts at it, the two ends cancel.
    changes = (
        marked.filter("_in")
        .select(*series, F.inline(F.array(
            F.struct(F.col("at").alias("at"), F.lit(1).cast("long").alias("_d")),
            F.struct(F.col("next").alias("at"), F.lit(-1).cast("long").alias("_d")),
        )))
        .groupBy(*series, "at").agg(F.sum("_d").alias("_d"))
        .filter("_d <> 0")
    )
    runs = _swept(changes, series, ["_d"], rows_per_task)
    return runs.filter("_d > 0").select(*series, F.col("at").alias("start_ms"), F.col("next").alias("end_ms"))


def union(*sets: DataFrame, series: list[str], rows_per_task: int | None = ROWS_PER_TASK) -> DataFrame:
    """The maximal intervals that any of the sets covers; intervals that touch become one."""
    points = None
    for intervals in sets:
        own = _points(intervals, series, "n")
        points = own if points is None else points.unionByName(own)
    # Ends and starts at one time have been added up, so touching intervals leave no trace there.
    stretches = _swept(points, series, ["n"], rows_per_task)
    return _joined_up(stretches, series, F.col("n") > 0, rows_per_task)


def difference(
    wanted: DataFrame, had: DataFrame, *, series: list[str], rows_per_task: int | None = ROWS_PER_TASK
) -> DataFrame:
    """The maximal intervals that ``wanted`` covers and ``had`` does not, holes inside ``had`` included."""
    zero = F.lit(0).cast("long")
    points = _points(wanted, series, "w").withColumn("h", zero).unionByName(
        _points(had, series, "h").withColumn("w", zero)
    )
    stretches = _swept(points, series, ["w", "h"], rows_per_task)
    return _joined_up(stretches, series, (F.col("w") > 0) & (F.col("h") == 0), rows_per_task)


def bar_intervals(bars: DataFrame, series: list[str], step: Column | int, *, time: str = "time") -> DataFrame:
    """Every bar as the interval it stands for: from its start for one time frame."""
    start = F.unix_millis(time)
    return bars.select(*series, start.alias("start_ms"), (start + step).alias("end_ms"))


def fetch_segments(
    requests: DataFrame, fetched: DataFrame, series: list[str], now_ms: int, *, rows_per_task: int | None = ROWS_PER_TASK
) -> DataFrame:
    """What is still to be fetched: requested ranges without what has been fetched.

    Other than the incremental plan, which only extends a series at its end, this asks
    for the head before the first stored bar and for interior holes too.  ``requests``
    has ``start_ms`` and ``end_ms``, null end means now; nothing after now is asked for.
    """
    end = F.least(F.coalesce(F.nullif(F.col("end_ms"), F.lit(0)), F.lit(now_ms)), F.lit(now_ms))
    wanted = requests.select(*series, "start_ms", end.alias("end_ms"))
    out = difference(wanted, fetched, series=series, rows_per_task=rows_per_task)
    return out.select(*series, F.col("start_ms").alias("fetch_start_ms"), F.col("end_ms").alias("fetch_end_ms"))
