"""Joins in which a null key equals a null key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``left`` joined to ``right`` (left, left_semi or left_anti) on equal or both-null keys."""
    names = {k: f"_r_{k}" for k in keys}
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    joined = left.join(right.withColumnsRenamed(names), same, how)
    return joined.drop(*names.values()) if how == "left" else joined

