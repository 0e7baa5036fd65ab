"""One incremental run over all series: plan, check, store, set aside, report.

A run takes what was landed for many series at once.  Rows that break a rule are set
aside with their reasons and don't stop anything; a series that has nothing but such
rows is reported as failed, and the others go on.  The landed rows are read once: checked
and staged, they feed the series table and the quarantine, and what is counted is what
was staged.  Quarantine and report lie by run, so a run that is started again after
a failure replaces its own rows and adds nothing twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.timeframe import bucket_start, step_ms
from seriesmill.operators.matching import null_safe_join
from seriesmill.operators.quality import high_below_low
from seriesmill.plans.incremental import incremental_plan
from seriesmill.schemas import SERIES_KEYS, columns
from seriesmill.session import shared_folder, written
from seriesmill.sources.store import SeriesTable

# A plan of up to this many series is broadcast to the landed rows, a larger one is joined by a shuffle.
BROADCAST_SERIES = 100_000

SUMMARY = columns(
    run_id=T.StringType(),
    **{k: T.StringType() for k in SERIES_KEYS},
    action=T.StringType(),
    rows_in=T.LongType(),
    rows_new=T.LongType(),
    rows_known=T.LongType(),
    rows_skipped=T.LongType(),
    rows_set_aside=T.LongType(),
    first_time=T.TimestampType(),
    last_time=T.TimestampType(),
    status=T.StringType(),
)


@dataclass(frozen=True)
class Run:
    """What a run did: its plan, the rows it added, the rows set aside, and one summary row per series."""

    plan: DataFrame
    added: DataFrame
    set_aside: DataFrame
    summary: DataFrame


def payload_checks(payload: T.StructType) -> dict[str, Column]:
    """Rules every row must keep: numbers that are there and, for bars, a high that is not below its low."""
    checks = {}
    for field in payload.fields:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            checks[f"{field.name} is missing"] = F.col(field.name).isNull() | F.isnan(field.name)
    if {"high", "low"} <= set(payload.fieldNames()):
        checks["high below low"] = high_below_low(F.col("high"), F.col("low"))
    return checks


def checked(
    landed: DataFrame, plan: DataFrame, now_ms: int, checks: dict[str, Column], broadcast_series: int = BROADCAST_SERIES
) -> DataFrame:
    """``landed`` with ``_reasons``, empty for a good row, and ``_due``: whether the plan asks for it.

    A null time, a series nobody requested, a time off the grid of its time frame, a bar
    that has not ended by now, and every failed check are reasons.  A good row of a
    series that is up to date, or outside the range to fetch, is not due.
    """
    few = plan.limit(broadcast_series + 1).count() <= broadcast_series
    known = plan.withColumn("_requested", F.lit(True))
    rows = null_safe_join(landed, F.broadcast(known) if few else known, SERIES_KEYS, "left")
    rows = rows.withColumn("_ms", F.unix_millis("time")).withColumn("_step", step_ms(F.col("timeframe")))
    rules = {
        "no time": F.col("time").isNull(),
        "not requested": F.col("_requested").isNull(),
        "off the grid": bucket_start(F.col("_ms"), F.col("timeframe"), F.col("_step")) != F.col("_ms"),
        "unfinished": F.col("_ms") + F.col("_step") > now_ms,
        **checks,
    }
    reasons = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))
    start, end = F.coalesce("fetch_start_ms", F.col("_ms")), F.coalesce(F.nullif("fetch_end_ms", F.lit(0)), F.lit(now_ms))
    due = (F.col("action") != "none") & F.col("_ms").between(start, end)
    return rows.withColumn("_reasons", reasons).withColumn("_due", F.coalesce(due, F.lit(False))).drop(
        "_ms", "_step", "_requested", "fetch_start_ms", "fetch_end_ms", "action"
    )


def incremental_run(
    table: SeriesTable,
    requests: DataFrame,
    landed: DataFrame,
    now_ms: int,
    *,
    run_id: str,
    folder: str,
    arrival: list[str] | None = None,
    checks: dict[str, Column] | None = None,
) -> Run:
    """Bring the requested series of ``table`` up to date from ``landed``.

    ``requests`` has the series keys, ``start_ms`` and ``end_ms``, one row a series;
    ``landed`` the table's columns and those of ``arrival``.  Rows set aside lie below
    ``folder`` in ``set_aside/run_id=...``, the summary in ``runs/run_id=...``.
    """
    shared_folder(table.spark)
    plan = incremental_plan(requests, table.high_water(), SERIES_KEYS, now_ms).checkpoint()
    payload = T.StructType([f for f in table.schema.fields if f.name not in SERIES_KEYS])
    rules = payload_checks(payload) | (checks or {})
    names = [*table.schema.fieldNames(), *(c for c in arrival or [] if c not in table.schema.fieldNames())]
    rows = written(checked(landed.select(*names), plan, now_ms, rules), "checked")
    good = rows.filter((F.size("_reasons") == 0) & F.col("_due")).select(*names)
    added = table.new_rows(good, arrival)
    aside = f"{folder}/set_aside/run_id={run_id}"
    bad = rows.filter(F.size("_reasons") > 0).withColumnRenamed("_reasons", "reasons").drop("_due")
    bad.write.mode("overwrite").parquet(aside)
    # The report is stored before the rows: a run that is lost in between finds its rows new again.
    report = f"{folder}/runs/run_id={run_id}"
    summary_rows(plan, rows, added, run_id).write.mode("overwrite").parquet(report)
    table.add_rows(added)
    spark = table.spark
    return Run(
        plan,
        added.select(*table.schema.fieldNames()),
        spark.read.schema(bad.schema).parquet(aside).withColumn("run_id", F.lit(run_id)),
        spark.read.schema(SUMMARY).parquet(report),
    )


def summary_rows(plan: DataFrame, rows: DataFrame, added: DataFrame, run_id: str) -> DataFrame:
    """One row per series that was requested or landed: what became of its rows, and a status.

    ``completed`` added rows, ``partial`` did so and set others aside, ``idle`` had
    nothing to add, ``failed`` had rows set aside and none added, ``no data`` was due
    and got nothing, ``unknown`` was not requested.
    """
    keys = list(SERIES_KEYS)
    bad = (F.size("_reasons") > 0).cast("long")
    skipped = ((F.size("_reasons") == 0) & ~F.col("_due")).cast("long")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("timestamp")
    marked = rows.select(
        *keys, F.lit(None).cast("string").alias("action"), F.lit(1).cast("long").alias("rows_in"), zero.alias("rows_new"),
        skipped.alias("rows_skipped"), bad.alias("rows_set_aside"), none.alias("time"),
    )
    new = added.select(
        *keys, F.lit(None).cast("string").alias("action"), zero.alias("rows_in"), F.lit(1).cast("long").alias("rows_new"),
        zero.alias("rows_skipped"), zero.alias("rows_set_aside"), "time",
    )
    asked = plan.select(
        *keys, "action", zero.alias("rows_in"), zero.alias("rows_new"), zero.alias("rows_skipped"),
        zero.alias("rows_set_aside"), none.alias("time"),
    )
    counted = marked.unionByName(new).unionByName(asked).groupBy(*keys).agg(
        F.max("action").alias("action"),
        *[F.sum(c).alias(c) for c in ("rows_in", "rows_new", "rows_skipped", "rows_set_aside")],
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
    )
    known = F.col("rows_in") - F.col("rows_new") - F.col("rows_skipped") - F.col("rows_set_aside")
    status = (
        F.when(F.col("action").isNull(), "unknown")
        .when((F.col("rows_new") > 0) & (F.col("rows_set_aside") > 0), "partial")
        .when(F.col("rows_new") > 0, "completed")
        .when(F.col("rows_set_aside") > 0, "failed")
        .when((F.col("action") != "none") & (F.col("rows_in") == 0), "no data")
        .otherwise("idle")
    )
    return counted.select(
        F.lit(run_id).alias("run_id"), *keys, "action", "rows_in", "rows_new", known.alias("rows_known"), "rows_skipped",
        "rows_set_aside", "first_time", "last_time", status.alias("status"),
    )
