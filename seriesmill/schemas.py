"""Declared schemas of the series table and of every source, and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES_KEYS = ["source", "symbol", "timeframe"]

_TIME, _DOUBLE, _STRING = T.TimestampType(), T.DoubleType(), T.StringType()


def columns(**types: T.DataType) -> T.StructType:
    """A schema from ``name=type`` pairs."""
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


OHLCV = columns(
    time=_TIME, open=_DOUBLE, high=_DOUBLE, low=_DOUBLE, close=_DOUBLE, volume=_DOUBLE
)
DERIVATIVES = columns(
    time=_TIME,
    open_interest_value=_DOUBLE,
    taker_long_short_ratio=_DOUBLE,
    top_long_short_position_ratio=_DOUBLE,
    top_long_short_account_ratio=_DOUBLE,
    global_long_short_account_ratio=_DOUBLE,
    funding_rate=_DOUBLE,
)
MACRO = columns(time=_TIME, volume=_DOUBLE)
SENTIMENT = columns(time=_TIME, value=_STRING, value_classification=_STRING)

# Shapes as they arrive on the wire.
OHLCV_WIRE = columns(
    symbol=_STRING, timeframe=_STRING, data=T.ArrayType(T.ArrayType(_DOUBLE))
)
MACRO_WIRE = columns(symbol=_STRING, date=_STRING, value=_DOUBLE)
SENTIMENT_WIRE = columns(
    data=T.ArrayType(
        columns(
            value=_STRING,
            value_classification=_STRING,
            timestamp=_STRING,
            time_until_update=_STRING,
        )
    )
)


def keyed(schema: T.StructType, *, source: bool = False) -> T.StructType:
    """``schema`` preceded by the series key columns."""
    keys = SERIES_KEYS if source else SERIES_KEYS[1:]
    return T.StructType([T.StructField(k, T.StringType()) for k in keys] + schema.fields)


def utc(column: Column | str) -> Column:
    """A naive (NTZ) or zoned timestamp as TIMESTAMP; naive values count as UTC."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("timestamp")


def naive(column: Column | str) -> Column:
    """The UTC wall-clock value without a zone."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("timestamp_ntz")


def schema_violations(
    df: DataFrame, required: T.StructType, *, allow_extra: bool = True
) -> list[str]:
    """Every way ``df`` breaks the ``required`` schema; empty when it conforms.

    A naive timestamp is accepted where a timestamp is required, since
    :func:`utc` turns one into the other.
    """
    problems = []
    present = {f.name: f.dataType for f in df.schema.fields}
    for field in required.fields:
        actual = present.get(field.name)
        if actual is None:
            problems.append(f"missing column '{field.name}' {field.dataType.simpleString()}")
        elif actual != field.dataType and not (
            isinstance(actual, T.TimestampNTZType) and isinstance(field.dataType, T.TimestampType)
        ):
            problems.append(
                f"column '{field.name}' is {actual.simpleString()}, "
                f"expected {field.dataType.simpleString()}"
            )
    if not allow_extra:
        known = set(required.fieldNames())
        problems += [f"unexpected column '{n}'" for n in present if n not in known]
    return problems


def check_schema(df: DataFrame, required: T.StructType, what: str = "frame") -> DataFrame:
    """``df`` unchanged, or ValueError listing every violation."""
    problems = schema_violations(df, required)
    if problems:
        raise ValueError(f"{what} does not conform:\n" + "\n".join(f"- {p}" for p in problems))
    return df
