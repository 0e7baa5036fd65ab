"""Time-frame arithmetic as Column expressions.

A time frame is a text such as ``1h``.  Every function takes it either as a
Python string (resolved once, while the plan is built) or as a Column.  Times
are epoch milliseconds, UTC.

Two week origins exist on purpose: plain rounding counts from the epoch, so
its weeks start on Thursday; :func:`bucket_start` and :func:`bucket_end` start
the time frame ``1w`` (and only that spelling) on Monday.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesmill.fixed_values import STANDARD_TIMEFRAMES, TIMEFRAME_UNITS

_UNIT_NAMES = "|".join(sorted(TIMEFRAME_UNITS, key=len, reverse=True))
_FREE_FORM = rf"^(\d+)({_UNIT_NAMES})s?$"
_INTEGER = r"^\s*[+-]?\d+(_\d+)*\s*$"

MINUTE_MS = 60_000
DAY_MS = 86_400_000
WEEK_MS = 7 * DAY_MS
# The epoch is a Thursday; the Monday before it lies three days earlier.
_MONDAY_SHIFT_MS = 3 * DAY_MS


def minutes_of(timeframe: str) -> int:
    """Minutes of a literal time frame; ValueError when it cannot be read."""
    if timeframe in STANDARD_TIMEFRAMES:
        return STANDARD_TIMEFRAMES[timeframe]
    free = re.match(_FREE_FORM, (timeframe or "").lower())
    if free:
        return int(free.group(1)) * TIMEFRAME_UNITS[free.group(2)]
    if timeframe and re.match(_INTEGER, timeframe):
        return int(timeframe)
    raise ValueError(f"cannot read time frame {timeframe!r}")


def milliseconds_of(timeframe: str) -> int:
    return minutes_of(timeframe) * MINUTE_MS


def _lookup(key: Column, table: dict[str, int]) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.element_at(F.create_map(*pairs), key)


def tf_minutes(timeframe: Column) -> Column:
    """Minutes of a time-frame column; null where it cannot be read.

    The forms are tried in turn, the cheap ones first; the pattern is only
    matched for texts that are neither a standard name nor amount and unit.
    """
    lowered = F.lower(timeframe)
    unit = F.ltrim(lowered, F.lit("0123456789"))
    digits = F.left(lowered, F.length(lowered) - F.length(unit))
    # A failed cast is slow, so texts without an amount are not cast at all.
    amount = F.nullif(digits, F.lit("")).try_cast("bigint")
    plurals = {f"{name}s": minutes for name, minutes in TIMEFRAME_UNITS.items()}
    plain = F.when(
        timeframe.rlike(_INTEGER),
        F.regexp_replace(F.trim(timeframe), "[_+]", "").try_cast("bigint"),
    )
    return F.coalesce(
        _lookup(timeframe, STANDARD_TIMEFRAMES).cast("bigint"),
        amount * _lookup(unit, TIMEFRAME_UNITS | plurals),
        plain,
    )


def tf_seconds(timeframe: Column | str) -> Column:
    return _minutes(timeframe) * 60


def tf_ms(timeframe: Column | str) -> Column:
    return _minutes(timeframe) * MINUTE_MS


def _minutes(timeframe: Column | str) -> Column:
    if isinstance(timeframe, str):
        return F.lit(minutes_of(timeframe)).cast("bigint")
    return tf_minutes(timeframe)


def step_ms(timeframe: Column | str) -> Column:
    """Bar length for the arithmetic below; null where the text gives no positive length.

    For a time-frame column, put this into a column of its own and pass it as
    ``step``: the text is then read once per row, not once per use.
    """
    if isinstance(timeframe, str):
        return F.lit(milliseconds_of(timeframe)).cast("bigint")
    ms = tf_ms(timeframe)
    return F.when(ms > 0, ms)


def _given(timeframe: Column | str, step: Column | None) -> Column:
    return step_ms(timeframe) if step is None else step


def _floor(ms: Column, step: Column, origin: int = 0) -> Column:
    """Largest multiple of ``step`` (counted from ``origin``) not above ``ms``."""
    return ms - F.pmod(ms - F.lit(origin) if origin else ms, step)


def round_down(ms: Column, timeframe: Column | str, step: Column | None = None) -> Column:
    """Start of the epoch-aligned time frame holding ``ms``."""
    return _floor(ms, _given(timeframe, step))


def round_up(ms: Column, timeframe: Column | str, step: Column | None = None) -> Column:
    """The next epoch-aligned boundary, strictly after ``ms``."""
    step = _given(timeframe, step)
    return _floor(ms, step) + step


def _monday(ms: Column) -> Column:
    return _floor(ms, F.lit(WEEK_MS).cast("bigint"), -_MONDAY_SHIFT_MS)


def bucket_start(ms: Column, timeframe: Column | str, step: Column | None = None) -> Column:
    """Start of the bar holding ``ms``; ``1w`` bars start on Monday 00:00."""
    if isinstance(timeframe, str):
        return _monday(ms) if timeframe == "1w" else round_down(ms, timeframe)
    return F.when(timeframe == "1w", _monday(ms)).otherwise(round_down(ms, timeframe, step))


def bucket_end(ms: Column, timeframe: Column | str, step: Column | None = None) -> Column:
    """Start of the bar after the one holding ``ms``."""
    step = _given(timeframe, step)
    return bucket_start(ms, timeframe, step) + step


def align(
    ms: Column, timeframe: Column | str, side: str, step: Column | None = None
) -> Column:
    """Boundary before (strictly) or at/after ``ms``; ``ms`` itself if the frame is unreadable."""
    if side not in ("prev", "next"):
        raise ValueError("side must be 'prev' or 'next'")
    if isinstance(timeframe, str):
        try:
            step = step_ms(timeframe)
        except ValueError:
            return ms
    step = _given(timeframe, step)
    # One millisecond back, or one short of a step ahead, lands on the wanted boundary.
    if side == "prev":
        aligned = F.when(ms == 0, ms).otherwise(_floor(ms - 1, step))
    else:
        aligned = _floor(ms + step - 1, step)
    return F.coalesce(aligned, ms)


def near_end(
    ms: Column, timeframe: Column | str, interval_seconds: int, step: Column | None = None
) -> Column:
    """True when the bar ends within the next ``interval_seconds``."""
    return ms + interval_seconds * 1000 >= bucket_end(ms, timeframe, step)


def near_start(
    ms: Column, timeframe: Column | str, interval_seconds: int, step: Column | None = None
) -> Column:
    """True when the bar started within the last ``interval_seconds``."""
    return ms - interval_seconds * 1000 <= bucket_start(ms, timeframe, step)


def to_time(ms: Column) -> Column:
    """Epoch milliseconds as TIMESTAMP; 0 and null mean 'open' and give null."""
    return F.timestamp_millis(F.nullif(ms, F.lit(0)))
