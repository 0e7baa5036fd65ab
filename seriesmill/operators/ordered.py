"""Operators that look along a series: fills, previous values, changes.

Each has the plain form, one window per series, and for long series the form
over pieces: the same window inside a piece, plus one carried row per piece.
Both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators.matching import null_safe_join
from seriesmill.plans.skew import PIECE, ROWS_PER_TASK, cut_pieces, split_series


def _no_nan(df: DataFrame, name: str) -> Column:
    """The column with NaN as null; a fill treats both as missing."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(name), F.col(name))
    return F.col(name)


def fill(
    df: DataFrame,
    series: list[str],
    order: list[str],
    columns: list[str],
    *,
    backward: bool = False,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Replace null and NaN by the last earlier value of the series.

    With ``backward`` the rows before the first value take that first value;
    note that this looks ahead in time.
    """
    split = split_series(df, series, rows_per_task)
    filled = fill_ordinary(split.ordinary, series, order, columns, backward=backward)
    if split.long is None:
        return filled
    pieces = cut_pieces(split.long, series, order, split.long_rows, rows_per_task)
    return filled.unionByName(fill_pieces(pieces, series, order, columns, backward=backward))


def fill_ordinary(
    df: DataFrame, series: list[str], order: list[str], columns: list[str], *, backward: bool
) -> DataFrame:
    """Fill with one window per series."""
    ahead = Window.partitionBy(*series).orderBy(*order)
    seen = ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ahead.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def filled(name: str) -> Column:
        value = _no_nan(df, name)
        result = F.last(value, ignorenulls=True).over(seen)
        if backward:
            result = F.coalesce(result, F.first(value, ignorenulls=True).over(whole))
        return result.alias(name)

    return df.select(*[filled(c) if c in columns else F.col(c) for c in df.columns])


def fill_pieces(
    pieces: DataFrame, series: list[str], order: list[str], columns: list[str], *, backward: bool
) -> DataFrame:
    """Fill inside pieces, then bring in the last value of the pieces before."""
    out_columns = [c for c in pieces.columns if c != PIECE]
    inside = Window.partitionBy(*series, PIECE).orderBy(*order)
    seen = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = pieces.select(
        *[
            F.last(_no_nan(pieces, c), ignorenulls=True).over(seen).alias(c)
            if c in columns
            else F.col(c)
            for c in out_columns
        ],
        PIECE,
        *[F.first(_no_nan(pieces, c), ignorenulls=True).over(seen).alias(f"_first_{c}")
          for c in columns if backward],
        F.lead(F.lit(True)).over(inside).isNull().alias("_piece_end"),
    )
    between = Window.partitionBy(*series).orderBy(PIECE)
    before = between.rowsBetween(Window.unboundedPreceding, -1)
    anywhere = between.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def carry(name: str) -> Column:
        value = F.last(name, ignorenulls=True).over(before)
        if backward:
            value = F.coalesce(value, F.first(f"_first_{name}", ignorenulls=True).over(anywhere))
        return value.alias(f"_carry_{name}")

    carried = local.filter("_piece_end").select(*series, PIECE, *[carry(c) for c in columns])
    return null_safe_join(local, carried, [*series, PIECE], "left").select(
        *[
            F.coalesce(F.col(c), F.col(f"_carry_{c}")).alias(c) if c in columns else F.col(c)
            for c in out_columns
        ]
    )


def previous(
    df: DataFrame,
    series: list[str],
    order: list[str],
    columns: dict[str, str],
    *,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Add, for each ``new: old`` in ``columns``, the value of ``old`` one row earlier."""
    split = split_series(df, series, rows_per_task)
    ahead = Window.partitionBy(*series).orderBy(*order)
    lagged = split.ordinary.select(
        "*", *[F.lag(old).over(ahead).alias(new) for new, old in columns.items()]
    )
    if split.long is None:
        return lagged
    pieces = cut_pieces(split.long, series, order, split.long_rows, rows_per_task)
    return lagged.unionByName(previous_pieces(pieces, series, order, columns))


def previous_pieces(
    pieces: DataFrame, series: list[str], order: list[str], columns: dict[str, str]
) -> DataFrame:
    """Previous values inside pieces; a piece's first row looks into the piece before."""
    inside = Window.partitionBy(*series, PIECE).orderBy(*order)
    local = pieces.select(
        "*",
        *[F.lag(old).over(inside).alias(new) for new, old in columns.items()],
        F.lag(F.lit(True)).over(inside).isNull().alias("_piece_start"),
        F.lead(F.lit(True)).over(inside).isNull().alias("_piece_end"),
    )
    between = Window.partitionBy(*series).orderBy(PIECE)
    carried = local.filter("_piece_end").select(
        *series,
        PIECE,
        *[F.lag(old).over(between).alias(f"_carry_{new}") for new, old in columns.items()],
    )
    return null_safe_join(local, carried, [*series, PIECE], "left").select(
        *[c for c in pieces.columns if c != PIECE],
        *[
            F.when(F.col("_piece_start"), F.col(f"_carry_{new}"))
            .otherwise(F.col(new))
            .alias(new)
            for new in columns
        ],
    )


def rising_edge(
    df: DataFrame,
    series: list[str],
    order: list[str],
    condition: Column,
    *,
    name: str = "fires",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``name``: true where ``condition`` holds and did not hold one row earlier."""
    marked = df.withColumn("_now", F.coalesce(condition, F.lit(False)))
    looked = previous(marked, series, order, {"_before": "_now"}, rows_per_task=rows_per_task)
    fires = F.col("_now") & ~F.coalesce(F.col("_before"), F.lit(False))
    return looked.withColumn(name, fires).drop("_now", "_before")


def changes(
    df: DataFrame,
    series: list[str],
    order: list[str],
    column: str,
    *,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Rows whose ``column`` differs from the row before, with ``old_`` and ``new_`` values."""
    looked = previous(df, series, order, {f"old_{column}": column}, rows_per_task=rows_per_task)
    changed = F.col(f"old_{column}").isNotNull() & ~F.col(column).eqNullSafe(
        F.col(f"old_{column}")
    )
    return looked.filter(changed).withColumnRenamed(column, f"new_{column}")
