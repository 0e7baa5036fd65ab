"""Recurring wall-clock windows, daily (``HH:MM:SS``) or hourly (``MM:SS``)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_CLOCK = re.compile(r"^(?:(\d\d):)?([0-5]\d):([0-5]\d)$")


def _clock_us(text: str) -> int:
    match = _CLOCK.match(text)
    if not match or int(match.group(1) or 0) > 23:
        raise ValueError(f"slot ends must be HH:MM:SS or MM:SS, not {text!r}")
    hours, minutes, seconds = (int(part or 0) for part in match.groups())
    return ((hours * 60 + minutes) * 60 + seconds) * 1_000_000


def in_slot(time: Column, start: str, end: str) -> Column:
    """True strictly inside the window; a window does not wrap around its period."""
    if len(start) != len(end):
        raise ValueError("both slot ends must have the same form")
    first, last = _clock_us(start), _clock_us(end)
    period = 86_400_000_000 if len(start) == 8 else 3_600_000_000
    clock = F.pmod(F.unix_micros(time), F.lit(period))
    return (clock > first) & (clock < last)
