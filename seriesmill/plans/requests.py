"""Checking collection requests before anything is fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.fixed_values import (
    FUTURES_LOOKBACK_DAYS,
    SENTIMENT_SYMBOL,
    SENTIMENT_TIMEFRAME,
    SERIES_TIMEFRAMES,
)
from seriesmill.functions.names import route_symbol, squash_symbol
from seriesmill.functions.timeframe import DAY_MS


def request_problems(
    now_ms: int, *, look_back_days: int = FUTURES_LOOKBACK_DAYS, with_source: bool = False
) -> Column:
    """Problems of one request row (symbol, timeframe, start_ms, end_ms) as an array.

    ``with_source`` also holds rows of the source ``sentiment`` to its one symbol.
    """
    end = F.coalesce(F.col("end_ms"), F.lit(now_ms - 1000))
    sentiment = F.col("symbol") == SENTIMENT_SYMBOL
    tests = []
    if with_source:
        tests.append(((F.col("source") == "sentiment") & ~sentiment, "sentiment has one symbol"))
    tests += [
        (F.col("start_ms") < now_ms - look_back_days * DAY_MS, "start too old"),
        (end <= F.col("start_ms"), "end not after start"),
        (~F.col("timeframe").isin(SERIES_TIMEFRAMES), "timeframe not allowed"),
        (sentiment & (F.col("timeframe") != SENTIMENT_TIMEFRAME), "sentiment is daily only"),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(text)) for test, text in tests]))


def validate_requests(
    requests: DataFrame,
    now_ms: int,
    universe: DataFrame | None = None,
    *,
    look_back_days: int = FUTURES_LOOKBACK_DAYS,
    venues: list[str] | None = None,
) -> DataFrame:
    """Requests with ``valid`` and ``reason`` (all problems, separated by ``; ``).

    With a universe, a symbol that is not listed in it is a problem too; with
    ``venues``, symbols are read as ``[datasource:]venue:symbol``, a venue that is not
    in the list is a problem, and the universe lists symbols without venues.  Bad
    requests stay in the result, so one of them does not stop the others.
    """
    problems = request_problems(
        now_ms, look_back_days=look_back_days, with_source="source" in requests.columns
    )
    symbol = F.col("symbol")
    if venues is not None:
        route = route_symbol(symbol)
        allowed = route["venue"].isin([v.lower() for v in venues]) if venues else F.lit(False)
        foreign = F.when(~F.coalesce(allowed, F.lit(False)), F.array(F.lit("venue not supported")))
        problems = F.concat(problems, F.coalesce(foreign, F.array().cast("array<string>")))
        symbol = route["symbol"]
    if universe is not None:
        listed = (
            universe.select(squash_symbol(F.col("symbol")).alias("_listed"))
            .distinct()
            .withColumn("_known", F.lit(True))
        )
        requests = requests.join(
            listed, squash_symbol(symbol) == F.col("_listed"), "left"
        )
        unknown = F.when(F.col("_known").isNull(), F.array(F.lit("symbol not supported")))
        problems = F.concat(problems, F.coalesce(unknown, F.array().cast("array<string>")))
    kept = [c for c in requests.columns if c not in ("_listed", "_known")]
    return requests.withColumn("_problems", problems).select(
        *kept,
        (F.size("_problems") == 0).alias("valid"),
        F.array_join("_problems", "; ").alias("reason"),
    )
