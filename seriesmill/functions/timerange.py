"""Time ranges: reading them from text, cleaning them, testing against them.

A range is two epoch-millisecond values, both ends inclusive, either may be
null for "open".  "Now" is always an argument, so results can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.fixed_values import (
    DEFAULT_RANGE_START,
    EPOCH_MS_THRESHOLD,
    RANGE_DAY_END,
    RANGE_DAY_START,
    RANGE_FALLBACK_START_MS,
    RANGE_MAX_MS,
    RANGE_MIN_MS,
    RELATIVE_UNITS_MS,
)

_STAMP = r"^\d{8}_\d{6}$"
_RELATIVE = r"^([+-]?)(\d+)([smhdwy])$"
_ISO_DASHED = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
_ISO_COMPACT = r"^\d{8}$"


def _stamp_ms(text: Column) -> Column:
    return F.when(
        text.rlike(_STAMP),
        F.unix_millis(F.try_to_timestamp(text, F.lit("yyyyMMdd_HHmmss"))),
    )


def _with_clock(day: Column, clock: str) -> Column:
    return F.when(F.contains(day, F.lit("_")), day).otherwise(F.concat(day, F.lit(clock)))


def read_ranges(
    df: DataFrame, text: str = "timerange", now_ms: Column | int | None = None
) -> DataFrame:
    """Add ``start_ms``, ``end_ms`` and ``valid`` for a column of ``A-B`` texts.

    A missing start means the default start, a missing end stays open.  A day
    without a clock starts at 00:00:00 as start and ends at 23:59:59 as end.
    Texts that are no range give nulls and ``valid`` False.  With ``now_ms``
    the ranges are also cleaned, see :func:`clean_range`.

    Works in steps, one projection each, so that each text is read once.
    """
    start, end = F.col("_start"), F.col("_end")
    split = df.withColumn("_start", F.substring_index(text, "-", 1)).withColumn(
        "_end", F.substr(F.col(text), F.length("_start") + 2)
    )
    stamped = split.withColumns(
        {
            "_open": end == "",
            "_start": _stamp_ms(
                F.when(start == "", F.lit(DEFAULT_RANGE_START)).otherwise(
                    _with_clock(start, RANGE_DAY_START)
                )
            ),
            "_end": _stamp_ms(_with_clock(end, RANGE_DAY_END)),
        }
    )
    valid = F.coalesce(
        F.contains(F.col(text), F.lit("-")) & start.isNotNull() & (F.col("_open") | end.isNotNull()),
        F.lit(False),
    )
    judged = stamped.withColumns(
        {"valid": valid, "_start": F.when(valid, start), "_end": F.when(valid, end)}
    )
    if now_ms is not None:
        cleaned = clean_range(start, end, now_ms)
        judged = judged.withColumns(
            {"_start": cleaned.getField("start_ms"), "_end": cleaned.getField("end_ms")}
        )
    return judged.withColumns({"start_ms": start, "end_ms": end}).drop("_start", "_end", "_open")


def clean_range(start_ms: Column, end_ms: Column, now_ms: Column | int) -> Column:
    """Replace implausible ends and put the ends in order; nulls stay open."""
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms

    def plausible(ms: Column) -> Column:
        return ms.between(F.lit(RANGE_MIN_MS), F.lit(RANGE_MAX_MS))

    start = F.when(
        start_ms.isNotNull() & ~plausible(start_ms), F.lit(RANGE_FALLBACK_START_MS)
    ).otherwise(start_ms)
    end = F.when(end_ms.isNotNull() & ~plausible(end_ms), now).otherwise(end_ms)
    both = start.isNotNull() & end.isNotNull()
    return F.struct(
        F.when(both, F.least(start, end)).otherwise(start).cast("bigint").alias("start_ms"),
        F.when(both, F.greatest(start, end)).otherwise(end).cast("bigint").alias("end_ms"),
    )


def contains(time_ms: Column, start_ms: Column, end_ms: Column) -> Column:
    """Both ends inclusive; a null or zero end is open."""
    after = start_ms.isNull() | (start_ms == 0) | (time_ms >= start_ms)
    before = end_ms.isNull() | (end_ms == 0) | (time_ms <= end_ms)
    return after & before


def between(time: Column, start=None, end=None) -> Column:
    """Inclusive range test on a time column; an end of None is open.

    Ends are literals, so the test reaches the file scan.
    """
    test = F.lit(True)
    if start is not None:
        test = test & (time >= F.lit(start).cast("timestamp"))
    if end is not None:
        test = test & (time <= F.lit(end).cast("timestamp"))
    return test


def parse_time(text: Column, now_ms: Column | int) -> Column:
    """Text as epoch milliseconds: ISO form, or a distance from now such as ``-2h``.

    A distance without a sign lies in the future, ``m`` means minutes, ``y``
    is 365 days, times without a zone are UTC; anything else gives null.
    """
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    iso = F.when(
        text.rlike(_ISO_DASHED),
        F.unix_millis(F.regexp_replace(text, ",", ".").try_cast("timestamp")),
    ).when(
        text.rlike(_ISO_COMPACT), F.unix_millis(F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    )
    lowered = F.lower(text)
    unit = F.regexp_extract(lowered, _RELATIVE, 3)
    unit_ms = F.element_at(
        F.create_map(*[F.lit(x) for item in RELATIVE_UNITS_MS.items() for x in item]), unit
    )
    amount = F.nullif(F.regexp_extract(lowered, _RELATIVE, 2), F.lit(""))
    distance = amount.try_cast("bigint") * unit_ms
    sign = F.when(F.regexp_extract(lowered, _RELATIVE, 1) == "-", -1).otherwise(1)
    return F.coalesce(iso, now + sign * distance)


def seconds_to_ms(seconds: Column) -> Column:
    """A numeric time in seconds as whole milliseconds."""
    return (seconds * 1000).cast("bigint")


def epoch_to_time(value: Column) -> Column:
    """A number that is milliseconds when large and seconds when small, as TIMESTAMP."""
    ms = F.when(value > EPOCH_MS_THRESHOLD, value).otherwise(value * 1000)
    return F.timestamp_millis(ms.cast("bigint"))


def whole_days(start_ms: Column, now_ms: Column | int) -> Column:
    """Calendar days (UTC) from a start to now; how many daily records to ask for."""
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    return F.datediff(F.timestamp_millis(now), F.timestamp_millis(start_ms))
