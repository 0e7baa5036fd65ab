"""Text expressions: sizes, dataset names, instrument names and venue routing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesmill.fixed_values import DEFAULT_VENUE

KB, MB, GB = 1 << 10, 1 << 20, 1 << 30


def format_size(size: Column) -> Column:
    """Bytes for people; one decimal, halves round to even, never above GB."""
    whole = size.cast("bigint")

    def scaled(unit: int, label: str) -> Column:
        return F.format_string(f"%.1f {label}", F.bround(whole / F.lit(unit).cast("double"), 1))

    return (
        F.when(whole.isNull() | (whole <= 0), F.lit("0 B"))
        .when(whole < KB, F.concat(whole.cast("string"), F.lit(" B")))
        .when(whole < MB, scaled(KB, "KB"))
        .when(whole < GB, scaled(MB, "MB"))
        .otherwise(scaled(GB, "GB"))
    )


def dataset_id(symbol: Column, timeframe: Column) -> Column:
    return F.concat_ws("_", symbol, timeframe)


def file_name(dataset: Column) -> Column:
    """Dataset id as a file stem."""
    return F.replace(dataset, F.lit("/"), F.lit("_"))


def table_name(dataset: Column, source: Column | None = None) -> Column:
    """Dataset id as a lower-case SQL table name with the source as prefix."""
    name = F.translate(dataset, "/-.=:^", "______")
    if source is not None:
        prefix = F.translate(source, "/-.", "___")
        name = F.when(F.coalesce(source, F.lit("")) == "", name).otherwise(
            F.concat(prefix, F.lit("_"), name)
        )
    name = F.when(name.rlike("^[A-Za-z_]"), name).otherwise(F.concat(F.lit("tbl_"), name))
    return F.lower(name)


def key_name(dataset: Column, source: Column | None = None) -> Column:
    """Dataset id as a key-value key; case is kept."""
    name = F.translate(dataset, "/-.", "___")
    if source is None:
        return name
    prefix = F.translate(source, "/-.", "___")
    return F.when(F.coalesce(source, F.lit("")) == "", name).otherwise(
        F.concat(prefix, F.lit(":"), name)
    )


def squash_symbol(symbol: Column) -> Column:
    """``BTC/USDT`` as ``BTCUSDT``."""
    return F.replace(symbol, F.lit("/"), F.lit(""))


def parse_instrument(symbol: Column) -> Column:
    """``BASE/QUOTE[:SETTLE[-DATE[-STRIKE[-P|C]]]]`` as a struct; null when malformed.

    Parts that are not there are empty texts.
    """
    sides = F.split(symbol, ":")
    unified = F.get(sides, F.lit(0))
    suffix = F.coalesce(F.get(sides, F.lit(1)), F.lit(""))
    pair = F.split(unified, "/")
    parts = F.split(suffix, "-")

    def part(i: int) -> Column:
        return F.coalesce(F.get(parts, F.lit(i)), F.lit(""))

    valid = (F.size(sides) <= 2) & (F.size(pair) == 2) & (F.size(parts) <= 4)
    return F.when(
        valid,
        F.struct(
            symbol.alias("original"),
            unified.alias("unified"),
            F.get(pair, F.lit(0)).alias("base"),
            F.get(pair, F.lit(1)).alias("quote"),
            part(0).alias("settlement"),
            part(1).alias("identifier"),
            part(2).alias("strike"),
            part(3).alias("option_type"),
        ),
    )


def route_symbol(symbol: Column) -> Column:
    """``[datasource:]venue:symbol`` as ``struct(venue, symbol)``.

    Without a readable venue the default venue is taken.
    """
    parts = F.split(symbol, ":")
    count = F.size(parts)
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    default = F.lit(DEFAULT_VENUE)
    tagged = F.contains(F.lower(first), F.lit("datasource"))
    venue = (
        F.when(count == 3, second)
        .when((count == 2) & ~tagged, first)
        .otherwise(default)
    )
    name = F.when(count == 3, F.get(parts, F.lit(2))).when(count == 2, second).otherwise(symbol)
    return F.struct(F.lower(venue).alias("venue"), name.alias("symbol"))
