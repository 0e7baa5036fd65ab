"""Reading stored series: ranges, most recent rows, latest state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.fixed_values import READ_LIMIT
from seriesmill.functions.names import dataset_id
from seriesmill.functions.timerange import between

# A row_number filter up to this bound is cut map-side by Spark itself.
_MAP_SIDE_ROWS = 1000


def read_range(
    df: DataFrame,
    *,
    dataset: str | None = None,
    symbols: list[str] | None = None,
    start=None,
    end=None,
    time: str = "time",
) -> DataFrame:
    """Rows of one dataset, or of some symbols, or of all, within an inclusive range.

    ``dataset`` (``symbol_timeframe``) goes before ``symbols``.  All tests are
    literals on stored columns and reach the scan.
    """
    if dataset is not None:
        symbol, _, timeframe = dataset.rpartition("_")
        df = df.filter((F.col("symbol") == symbol) & (F.col("timeframe") == timeframe))
    elif symbols is not None:
        df = df.filter(F.col("symbol").isin(symbols))
    return df.filter(between(F.col(time), start, end))


def tail(
    df: DataFrame, n: int = READ_LIMIT, *, time: str = "time", tie_break: list[str] | None = None
) -> DataFrame:
    """The most recent ``n`` rows over all series, oldest first; 0 gives no rows."""
    ties = tie_break or []
    newest = df.orderBy(F.col(time).desc(), *[F.col(c).desc() for c in ties]).limit(n)
    return newest.orderBy(time, *ties)


def tail_per_series(
    df: DataFrame,
    series: list[str],
    n: int,
    *,
    time: str = "time",
    tie_break: list[str] | None = None,
) -> DataFrame:
    """The most recent ``n`` rows of every series."""
    newest = [F.col(time).desc(), *[F.col(c).desc() for c in tie_break or []]]

    def cut(frame: DataFrame, *keys) -> DataFrame:
        ranked = Window.partitionBy(*keys).orderBy(*newest)
        return (
            frame.withColumn("_rank", F.row_number().over(ranked))
            .filter(F.col("_rank") <= n)
            .drop("_rank")
        )

    if n > _MAP_SIDE_ROWS:
        # Too deep for the map-side cut: cut within salted parts first.
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(time, *(tie_break or [])), F.lit(64)))
        df = cut(salted, *series, "_salt").drop("_salt")
    return cut(df, *series)


def latest_row(
    df: DataFrame, series: list[str], *, time: str = "time", tie_break: list[str] | None = None
) -> DataFrame:
    """The most recent row of every series."""
    return tail_per_series(df, series, 1, time=time, tie_break=tie_break)


def formatted(df: DataFrame, time: str = "time") -> DataFrame:
    """Times as ``yyyy-MM-dd HH:mm:ss`` text, as the read interface returns them."""
    return df.withColumn(time, F.date_format(time, "yyyy-MM-dd HH:mm:ss"))


def with_dataset(df: DataFrame) -> DataFrame:
    return df.withColumn("data_name", dataset_id(F.col("symbol"), F.col("timeframe")))
