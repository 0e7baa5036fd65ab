"""Holes in a series: where they are and which bars are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.timeframe import DAY_MS, milliseconds_of
from seriesmill.operators.ordered import previous
from seriesmill.plans.skew import ROWS_PER_TASK

# Bars of a hole are listed in runs of this length, one array per run.
_RUN = 10_000
# Bars are unique on their grid, so this many years bound the rows of a series.
_YEARS_MS = 150 * 366 * DAY_MS


def _limit(step: int, rows_per_task: int | None) -> int | None:
    """No search for long series where the grid leaves no room for one."""
    if rows_per_task is None or _YEARS_MS // step <= rows_per_task:
        return None
    return rows_per_task


def gap_ranges(
    bars: DataFrame,
    series: list[str],
    timeframe: str,
    *,
    time: str = "time",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """One row per hole: (series, gap_start_ms, gap_end_ms, missing).

    Start and end are the first and last missing bar; bars lie on the grid of
    the time frame and are unique per series.
    """
    step = milliseconds_of(timeframe)
    keyed = bars.select(*series, F.unix_millis(time).alias("_ms"))
    looked = previous(
        keyed, series, ["_ms"], {"_prev": "_ms"}, rows_per_task=_limit(step, rows_per_task)
    )
    return looked.filter(F.col("_ms") - F.col("_prev") > step).select(
        *series,
        (F.col("_prev") + step).alias("gap_start_ms"),
        (F.col("_ms") - step).alias("gap_end_ms"),
        F.expr(f"(_ms - _prev) div {step} - 1").alias("missing"),
    )


def missing_bars(
    bars: DataFrame,
    series: list[str],
    timeframe: str,
    *,
    time: str = "time",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """One row per missing bar between the first and last bar of a series.

    The bars come out of the holes, so no calendar of all bars is built or
    joined.  A long hole is first cut into runs, and the runs are spread.
    """
    step = milliseconds_of(timeframe)
    gaps = gap_ranges(bars, series, timeframe, time=time, rows_per_task=rows_per_task)
    span = step * _RUN
    runs = gaps.select(
        *series,
        "gap_end_ms",
        F.explode(F.sequence("gap_start_ms", "gap_end_ms", F.lit(span))).alias("_run"),
    ).repartition(*series, "_run")
    last = F.least(F.col("gap_end_ms"), F.col("_run") + (span - step))
    return runs.select(
        *series, F.explode(F.sequence("_run", last, F.lit(step))).alias("_ms")
    ).select(*series, F.timestamp_millis("_ms").alias("time"))
