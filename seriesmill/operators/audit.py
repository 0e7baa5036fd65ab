"""Reports over the run log of collection tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.ordered import changes
from seriesmill.plans.skew import ROWS_PER_TASK


def status_counts(runs: DataFrame, status: str = "status") -> DataFrame:
    """Runs per status, with the share of running ones marked."""
    return runs.groupBy(status).agg(
        F.count("*").alias("n_runs"),
        F.sum(F.when(F.col(status) == "running", 1).otherwise(0)).alias("n_running"),
    )


def latest_state(runs: DataFrame, task: list[str], *, time: str, seq: str) -> DataFrame:
    """Per task: its last run with status and error, and how often it ran."""
    at = F.struct(time, seq)
    return runs.groupBy(*task).agg(
        F.count("*").alias("run_count"),
        F.max(at).getField(time).alias("last_run_time"),
        F.max_by("status", at).alias("last_status"),
        F.max_by("error", at).alias("last_error"),
    )


def status_changes(
    runs: DataFrame,
    task: list[str],
    order: list[str],
    status: str = "status",
    *,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Runs whose status differs from the task's run before."""
    return changes(runs, task, order, status, rows_per_task=rows_per_task)
