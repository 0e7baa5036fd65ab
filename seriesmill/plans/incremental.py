"""What still has to be fetched: per series, then per page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.fixed_values import (
    FUTURES_PAGE_BARS,
    FUTURES_PAGE_PAD_MS,
    SPOT_PAGE_BARS,
    SPOT_PAGE_BARS_BY_VENUE,
)
from seriesmill.functions.timeframe import step_ms
from seriesmill.functions.timerange import clean_range

# Pages of one series are numbered in runs of this length, one array per run.
_RUN = 10_000


def high_water(df: DataFrame, series: list[str], time: str = "time") -> DataFrame:
    """First and last stored time of every series, in milliseconds."""
    ms = F.unix_millis(time)
    return df.groupBy(*series).agg(F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"))


def incremental_plan(
    requests: DataFrame,
    marks: DataFrame,
    series: list[str],
    now_ms: int,
    *,
    clean: bool = False,
) -> DataFrame:
    """One row per request: (series, action, fetch_start_ms, fetch_end_ms).

    A series without stored rows is fetched as requested (``initial``).  One
    that is more than two time frames behind its end is extended from the bar
    after the last stored one (``extend``).  Any other is left alone
    (``none``).  ``requests`` has start_ms and end_ms, null end means now.

    With ``clean`` the derived range goes through :func:`clean_range` like a
    requested one, which moves starts before its first year to a fixed day; by
    default an extension starts where the stored rows end, however old.
    """
    step, following, end = F.col("_step"), F.col("_following"), F.col("_end")
    planned = (
        requests.join(marks.select(*series, "max_ms"), series, "left")
        .withColumn("_step", step_ms(F.col("timeframe")))
        .withColumn("_following", F.col("max_ms") + step)
        .withColumn("_end", F.coalesce(F.nullif(F.col("end_ms"), F.lit(0)), F.lit(now_ms)))
        .withColumn(
            "action",
            F.when(F.col("max_ms").isNull(), "initial")
            .when(following < end - step, "extend")
            .otherwise("none"),
        )
        .withColumn(
            "_range",
            clean_range(following, end, now_ms)
            if clean
            else F.struct(following.alias("start_ms"), end.alias("end_ms")),
        )
    )
    extend = F.col("action") == "extend"
    initial = F.col("action") == "initial"
    return planned.select(
        *series,
        "action",
        F.when(initial, F.col("start_ms"))
        .when(extend, F.col("_range.start_ms"))
        .alias("fetch_start_ms"),
        F.when(initial, F.col("end_ms"))
        .when(extend, F.col("_range.end_ms"))
        .alias("fetch_end_ms"),
    )


def _numbered(df: DataFrame, pages: Column) -> DataFrame:
    """One row per page number 0 .. pages-1, without one array per series.

    The outer form of explode, with the nulls dropped afterwards, keeps Spark
    from copying the whole arithmetic behind ``pages`` into an earlier filter.
    """
    runs = F.expr(
        f"CASE WHEN _pages > 0 THEN sequence(0L, (_pages - 1) div {_RUN} * {_RUN}, {_RUN}L) END"
    )
    numbers = F.expr(f"sequence(_from, least(_from + {_RUN - 1}, _pages - 1), 1L)")
    return (
        df.withColumn("_pages", pages)
        .withColumn("_from", F.explode_outer(runs))
        .withColumn("page_no", F.explode_outer(numbers))
        .filter("page_no IS NOT NULL")
        .drop("_from", "_pages")
    )


def page_bars(venue: Column) -> Column:
    """Bars a venue returns per page."""
    size = F.lit(SPOT_PAGE_BARS)
    for name, bars in SPOT_PAGE_BARS_BY_VENUE.items():
        size = F.when(venue == name, bars).otherwise(size)
    return size


def bar_pages(plan: DataFrame, series: list[str], bars_per_page: Column | int) -> DataFrame:
    """Pages of at most ``bars_per_page`` bars; each starts 1 ms after the last bar before it.

    Start and end are known up front, so the pages of all series can be
    fetched at once.  The range start is taken to be a bar time.
    """
    cap = F.lit(bars_per_page) if isinstance(bars_per_page, int) else bars_per_page
    sized = (
        plan.withColumn("_step", step_ms(F.col("timeframe")))
        .withColumn("_cap", cap.cast("bigint"))
        .withColumn("_span", F.col("fetch_end_ms") - F.col("fetch_start_ms"))
        .withColumn("_bars", F.expr("_span div _step"))
    )
    # A range shorter than a page needs one more request for a rest below one bar.
    pages = F.expr(
        "CASE WHEN _bars <= 0 THEN 0L"
        " WHEN _bars < _cap THEN 1L + CAST(_span > _bars * _step AS BIGINT)"
        " ELSE (_span + _cap * _step - 1) div (_cap * _step) END"
    )
    numbered = _numbered(sized, pages).withColumn(
        "_before", F.expr("least(page_no * _cap, _bars)")
    )
    return numbered.withColumn(
        "page_start_ms",
        F.expr(
            "fetch_start_ms + CASE WHEN page_no = 0 THEN 0L ELSE (_before - 1) * _step + 1 END"
        ),
    ).select(
        *series,
        "page_no",
        "page_start_ms",
        F.col("fetch_end_ms").alias("page_end_ms"),
        F.expr("least((fetch_end_ms - page_start_ms) div _step, _cap)").alias("page_limit"),
    )


def window_pages(
    plan: DataFrame, series: list[str], bars_per_page: int = FUTURES_PAGE_BARS
) -> DataFrame:
    """Fixed windows of ``bars_per_page`` time frames, each padded at its end."""
    sized = plan.withColumn("_step", step_ms(F.col("timeframe"))).withColumn(
        "_width", F.col("_step") * bars_per_page
    )
    pages = F.expr(
        "CASE WHEN fetch_end_ms > fetch_start_ms"
        " THEN (fetch_end_ms - fetch_start_ms + _width - 1) div _width ELSE 0L END"
    )
    numbered = _numbered(sized, pages).withColumn(
        "page_start_ms", F.expr("fetch_start_ms + page_no * _width")
    )
    end = F.least(F.col("fetch_end_ms"), F.col("page_start_ms") + F.col("_width"))
    return (
        numbered.withColumn("page_end_ms", end + FUTURES_PAGE_PAD_MS)
        .withColumn(
            "page_limit",
            F.expr(f"least((page_end_ms - page_start_ms) div _step, {bars_per_page}L)"),
        )
        .select(*series, "page_no", "page_start_ms", "page_end_ms", "page_limit")
        .filter("page_limit > 0")
    )
