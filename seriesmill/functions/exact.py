"""Sums of doubles that do not depend on the order of adding.

Every value is split into a whole part and a part below one in steps of
``2 ** -62``; both are added up exactly as decimals, and only the finished sums become
doubles again.  A value keeps its bits down to ``2 ** -62``; what is smaller is cut
off value by value, in the same way wherever the value lies.  Infinite values and NaN
keep their meaning, nulls are skipped, and a group without values gives null.  Whole
parts of more than 38 digits are an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEPS = float(1 << 62)
_LONG = float(1 << 62)


def exact_sum(value: Column | str) -> Column:
    """The sum of a double column, equal in all its bits for any partitioning."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    finite = ~F.isnan(x) & (F.abs(x) < float("inf"))
    # From 2 ** 53 on doubles are whole numbers.
    small = F.abs(x) < _LONG
    whole = F.when(small, F.floor(x).cast("decimal(38,0)")).otherwise(x.cast("decimal(38,0)"))
    rest = F.when(small, ((x - F.floor(x)) * _STEPS).cast("bigint")).otherwise(F.lit(0))
    wholes = F.sum(F.when(finite, whole))
    rests = F.sum(F.when(finite, rest).cast("decimal(20,0)"))
    odd = F.sum(F.when(~finite, x))
    # Rests below one are never negative, so their sum is cut into carried ones and what is left.
    carried = F.floor(rests / F.lit(1 << 62).cast("decimal(20,0)"))
    left = rests - carried * F.lit(1 << 62).cast("decimal(20,0)")
    total = (wholes + carried).cast("double") + left.cast("double") / F.lit(_STEPS)
    return F.coalesce(odd, total)
