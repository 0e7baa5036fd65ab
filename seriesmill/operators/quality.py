"""Data-quality counts per series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.ordered import previous
from seriesmill.plans.skew import ROWS_PER_TASK


def high_below_low(high: Column, low: Column) -> Column:
    """The check that a bar's highest price is not below its lowest; nulls pass."""
    return high < low


def series_quality(
    df: DataFrame,
    series: list[str],
    *,
    time: str = "time",
    arrival: str = "seq",
    checks: dict[str, Column] | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Per series: rows, null times, repeated times, times out of order, failed checks.

    ``arrival`` is the order rows came in; a row is out of order when its time
    lies before that of the row that arrived before it.
    """
    marks = {name: F.coalesce(test, F.lit(False)) for name, test in (checks or {}).items()}
    looked = previous(
        df.select(*series, time, arrival, *[c.alias(f"_x_{n}") for n, c in marks.items()]),
        series,
        [arrival],
        {"_before": time},
        rows_per_task=rows_per_task,
    )
    # First per (series, time), where Spark combines map-side; then per series.
    per_time = looked.groupBy(*series, time).agg(
        F.count("*").alias("_n"),
        F.sum(F.when(F.col(time) < F.col("_before"), 1).otherwise(0)).alias("_back"),
        *[F.sum(F.col(f"_x_{n}").cast("int")).alias(f"_x_{n}") for n in marks],
    )
    null_time = F.col(time).isNull()
    return per_time.groupBy(*series).agg(
        F.sum("_n").alias("n_rows"),
        F.sum(F.when(null_time, F.col("_n")).otherwise(0)).alias("n_null_time"),
        F.sum(F.when(~null_time, F.col("_n") - 1).otherwise(0)).alias("n_duplicate_time"),
        F.sum("_back").alias("n_out_of_order"),
        *[F.sum(f"_x_{n}").alias(n) for n in marks],
    )
