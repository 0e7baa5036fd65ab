"""Bars, feeds, fills, merges, plans and reads over the event tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.functions.timeframe import DAY_MS
from seriesmill.operators import align, dedupe, gaps, merge, quality, read
from seriesmill.operators.bars import bars_from_events as make_bars
from seriesmill.operators.bars import finished_bars
from seriesmill.plans import incremental, requests
from seriesmill.queries.inputs import (
    ALL_FEEDS,
    NOW_MS,
    as_table,
    event_bars,
    prop_k,
    rounded_volume,
    event_rows,
    feed_long,
    hourly,
    table,
)
from seriesmill.schemas import naive, utc

EV_SQL = (
    "ev AS (SELECT 'u' || user_id AS symbol, ts AS time, event_id AS seq, event_type AS feed, "
    "value, props, epoch_us(ts) // 1000 AS ms FROM events)"
)
BAR = ["open", "high", "low", "close", "volume"]


def bars_sql(name: str, start: str, source: str = "ev") -> str:
    """A CTE with one bar per symbol and ``start``, taking first and last by (time, seq)."""
    return f"""{name} AS (
  SELECT symbol, {start} AS time, first(value ORDER BY time, seq) AS open, max(value) AS high,
    min(value) AS low, last(value ORDER BY time, seq) AS close,
    round(sum(value), 6) AS volume
  FROM {source} GROUP BY symbol, {start})"""


FOUR_HOURS = "make_timestamp_ms(ms // 14400000 * 14400000)"
ONE_DAY = "make_timestamp_ms(ms // 86400000 * 86400000)"


# -- bars --------------------------------------------------------------------
def bars_from_events(spark, sf_dir):
    return event_bars(spark, sf_dir, "4h").select("symbol", naive("time").alias("time"), *BAR)


BARS_SQL = f"WITH {EV_SQL}, {bars_sql('bars', FOUR_HOURS)} SELECT * FROM bars"


def bars_weekly(spark, sf_dir):
    """Monday weeks over the largest table: one series per supplier."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("symbol"),
        utc("l_shipdate").alias("time"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").alias("seq"),
        F.col("l_extendedprice").alias("value"),
    )
    return rounded_volume(make_bars(rows, ["symbol"], "1w")).select(
        "symbol", naive("time").alias("time"), *BAR
    )


def bars_fine_values(spark, sf_dir):
    """Values of eight decimals, as crypto volumes have: their sum is that of whole numbers."""
    rows = event_rows(spark, sf_dir).withColumn("value", F.round(F.col("value") * 100) / 1e8)
    return make_bars(rows, ["symbol"], "4h").select(
        "symbol", naive("time").alias("time"), F.round(F.col("volume") * 1e8).cast("long").alias("units")
    )


BARS_FINE_SQL = f"""
WITH {EV_SQL} SELECT symbol, {FOUR_HOURS} AS time, sum(round(value * 100)::BIGINT)::BIGINT AS units
FROM ev GROUP BY symbol, {FOUR_HOURS}
"""


BARS_WEEKLY_SQL = """
SELECT l_suppkey AS symbol, date_trunc('week', l_shipdate)::TIMESTAMP AS time,
  first(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity)
    AS open,
  max(l_extendedprice) AS high, min(l_extendedprice) AS low,
  last(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity)
    AS close,
  round(sum(l_extendedprice), 6) AS volume
FROM lineitem GROUP BY 1, 2
"""

# Until noon of January 30th, seen from its end.
_UNTIL_MS = NOW_MS - DAY_MS // 2


def drop_unfinished_bars(spark, sf_dir):
    bars = event_bars(spark, sf_dir, "1d")
    return finished_bars(bars, "1d", _UNTIL_MS, NOW_MS).select(
        "symbol", naive("time").alias("time"), *BAR
    )


DROP_UNFINISHED_SQL = f"""
WITH {EV_SQL}, {bars_sql('bars', ONE_DAY)}
SELECT * FROM bars WHERE epoch_us(time) // 1000 + {DAY_MS} < {_UNTIL_MS}
  AND epoch_us(time) // 1000 + {DAY_MS} <= {NOW_MS}
"""


# -- feeds and fills ---------------------------------------------------------
def feeds_aligned(spark, sf_dir):
    wide = align.align_feeds(feed_long(spark, sf_dir), ["symbol"], ALL_FEEDS)
    return wide.select("symbol", naive("time").alias("time"), *ALL_FEEDS)


def _feed_cte(name: str) -> str:
    if name == "funding":
        rows = (
            "SELECT symbol, date_trunc('second', time) AS t, "
            "CAST(props->>'$.k' AS DOUBLE) AS v, seq FROM ev WHERE feed = 'purchase'"
        )
    else:
        rows = (
            "SELECT symbol, date_trunc('hour', time) AS t, value AS v, seq "
            f"FROM ev WHERE feed = '{name}'"
        )
    return (
        f"{name} AS (SELECT symbol, t AS time, v AS {name} FROM ({rows}) "
        "QUALIFY row_number() OVER (PARTITION BY symbol, t ORDER BY seq DESC) = 1)"
    )


WIDE_SQL = (
    f"WITH {EV_SQL}, "
    + ", ".join(_feed_cte(f) for f in ALL_FEEDS)
    + ", wide AS (SELECT * FROM click "
    + " ".join(f"FULL OUTER JOIN {f} USING (symbol, time)" for f in ALL_FEEDS[1:])
    + ")"
)
FEEDS_ALIGNED_SQL = WIDE_SQL + " SELECT * FROM wide"


def fill_forward(spark, sf_dir):
    filled = align.align_and_fill(feed_long(spark, sf_dir), ["symbol"], ALL_FEEDS)
    return filled.select("symbol", naive("time").alias("time"), *ALL_FEEDS)


_FORWARD = "last_value({f} IGNORE NULLS) OVER past"
FILL_FORWARD_SQL = (
    WIDE_SQL
    + " SELECT symbol, time, "
    + ", ".join(f"{_FORWARD.format(f=f)} AS {f}" for f in ALL_FEEDS)
    + " FROM wide WINDOW past AS (PARTITION BY symbol ORDER BY time"
    " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
)


def fill_forward_backward(spark, sf_dir):
    filled = align.align_and_fill(
        feed_long(spark, sf_dir), ["symbol"], ALL_FEEDS, backward=True
    )
    return filled.select("symbol", naive("time").alias("time"), *ALL_FEEDS)


FILL_BOTH_SQL = (
    WIDE_SQL
    + " SELECT symbol, time, "
    + ", ".join(
        f"coalesce({_FORWARD.format(f=f)}, first_value({f} IGNORE NULLS) OVER ahead) AS {f}"
        for f in ALL_FEEDS
    )
    + " FROM wide WINDOW past AS (PARTITION BY symbol ORDER BY time"
    " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),"
    " ahead AS (PARTITION BY symbol ORDER BY time"
    " ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
)


# -- duplicates and merges ---------------------------------------------------
def _hourly_rows(spark, sf_dir):
    return hourly(event_rows(spark, sf_dir)).select("symbol", "time", "seq", "feed", "value")


def _shown(df, *more):
    return df.select(
        "symbol", naive("time").alias("time"), F.col("seq").alias("event_id"), "value", *more
    )


HOURLY_SQL = f"{EV_SQL}, h AS (SELECT symbol, date_trunc('hour', time) AS time, seq, value, \
time AS exact FROM ev)"


def dedupe_keep_first(spark, sf_dir):
    return _shown(dedupe.keep_first(_hourly_rows(spark, sf_dir), ["symbol", "time"], ["seq"]))


def dedupe_keep_last(spark, sf_dir):
    return _shown(dedupe.keep_last(_hourly_rows(spark, sf_dir), ["symbol", "time"], ["seq"]))


def _dedupe_sql(order: str) -> str:
    return (
        f"WITH {HOURLY_SQL} SELECT symbol, time, seq AS event_id, value FROM h "
        f"QUALIFY row_number() OVER (PARTITION BY symbol, time ORDER BY seq {order}) = 1"
    )


def _stored_and_new(spark, sf_dir):
    """Stored: before January 20th, one row per key. New: everything from the 15th on."""
    rows = event_rows(spark, sf_dir).select("symbol", "time", "seq", "value")
    stored = hourly(rows.filter(F.col("time") < F.lit("2024-01-20").cast("timestamp")))
    new = hourly(rows.filter(F.col("time") >= F.lit("2024-01-15").cast("timestamp")))
    return dedupe.keep_first(stored, ["symbol", "time"], ["seq"]), new


def upsert_merge(spark, sf_dir):
    stored, new = _stored_and_new(spark, sf_dir)
    merged = merge.merge_upsert(stored, new, ["symbol", "time"], ["seq"])
    return _shown(merged, "is_new")


_MERGE_SQL = f"""
WITH {HOURLY_SQL}, stored AS (
  SELECT symbol, time, seq, value FROM h WHERE exact < TIMESTAMP '2024-01-20'
  QUALIFY row_number() OVER (PARTITION BY symbol, time ORDER BY seq) = 1
), both_rows AS (
  SELECT *, FALSE AS is_new FROM stored UNION ALL
  SELECT symbol, time, seq, value, TRUE FROM h WHERE exact >= TIMESTAMP '2024-01-15'
), merged AS (
  SELECT * FROM both_rows
  QUALIFY row_number() OVER (PARTITION BY symbol, time ORDER BY is_new, seq) = 1
)"""
UPSERT_MERGE_SQL = (
    _MERGE_SQL + " SELECT symbol, time, seq AS event_id, value, is_new FROM merged"
)


def upsert_unsettled(spark, sf_dir):
    """The merge where stored rows may repeat keys: the whole table against itself."""
    rows = hourly(event_rows(spark, sf_dir).select("symbol", "time", "seq", "value"))
    merged = merge.merge_unsettled(rows, rows, ["symbol", "time"], ["seq"])
    return _shown(merged, "is_new")


UPSERT_UNSETTLED_SQL = f"""
WITH {HOURLY_SQL} SELECT symbol, time, min(seq) AS event_id, arg_min(value, seq) AS value,
  FALSE AS is_new FROM h GROUP BY symbol, time
"""


def upsert_summary(spark, sf_dir):
    stored, new = _stored_and_new(spark, sf_dir)
    merged = merge.merge_upsert(stored, new, ["symbol", "time"], ["seq"])
    summary = merge.upsert_summary(merged, ["symbol"])
    return summary.select(
        "symbol",
        "total",
        "added",
        naive("first_time").alias("first_time"),
        naive("last_time").alias("last_time"),
    )


UPSERT_SUMMARY_SQL = _MERGE_SQL + """
SELECT symbol, count(*) AS total, count(*) FILTER (WHERE is_new) AS added,
  min(time) AS first_time, max(time) AS last_time FROM merged GROUP BY symbol
"""


def pages_union(spark, sf_dir):
    """Two pages that overlap in time; the first one lacks a column."""
    rows = event_rows(spark, sf_dir)
    early = rows.filter(F.col("time") < F.lit("2024-01-16").cast("timestamp"))
    late = rows.filter(F.col("time") >= F.lit("2024-01-15").cast("timestamp"))
    both = merge.union_pages([early.drop("feed", "props"), late.drop("props")])
    return _shown(both, "feed")


PAGES_UNION_SQL = f"""
WITH {EV_SQL}
SELECT symbol, time, seq AS event_id, value, NULL AS feed FROM ev
WHERE time < TIMESTAMP '2024-01-16'
UNION ALL
SELECT symbol, time, seq, value, feed FROM ev WHERE time >= TIMESTAMP '2024-01-15'
"""


# -- plans -------------------------------------------------------------------
_START_MS = 1_704_067_200_000  # 2024-01-01


def _requests(spark, sf_dir):
    """Every customer at four time frames; stored rows exist for those with events.

    One customer in a market segment asks up to a fixed end, the others up to now.
    """
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey")).alias("symbol"),
        F.lit(_START_MS).cast("bigint").alias("start_ms"),
        F.when(
            F.col("c_mktsegment") == "BUILDING", F.lit(NOW_MS - 2 * DAY_MS).cast("bigint")
        ).alias("end_ms"),
    )
    return customers.withColumn(
        "timeframe", F.explode(F.array(*[F.lit(x) for x in ["1w", "1d", "4h", "1h"]]))
    )


def _plan(spark, sf_dir):
    keys = ["symbol", "timeframe"]
    marks = incremental.high_water(event_rows(spark, sf_dir), ["symbol"])
    wanted = _requests(spark, sf_dir)
    # The same stored events back every time frame.
    framed = marks.withColumn(
        "timeframe", F.explode(F.array(*[F.lit(x) for x in ["1w", "1d", "4h", "1h"]]))
    )
    return incremental.incremental_plan(wanted, framed, keys, NOW_MS)


def incremental_plan(spark, sf_dir):
    return _plan(spark, sf_dir)


_FRAMES = "(VALUES ('1w', 604800000::BIGINT), ('1d', 86400000), ('4h', 14400000), ('1h', 3600000)) \
AS f(timeframe, tf)"
_PLAN_SQL = f"""
WITH {EV_SQL}, marks AS (SELECT symbol, max(ms) AS max_ms FROM ev GROUP BY symbol),
req AS (
  SELECT 'u' || c_custkey AS symbol, timeframe, tf,
    CASE WHEN c_mktsegment = 'BUILDING' THEN {NOW_MS - 2 * DAY_MS} END AS end_ms
  FROM customer CROSS JOIN {_FRAMES}
), j AS (
  SELECT req.symbol, timeframe, tf, end_ms, max_ms, max_ms + tf AS nxt,
    coalesce(end_ms, {NOW_MS}) AS fin
  FROM req LEFT JOIN marks ON req.symbol = marks.symbol
), plan AS (
  SELECT symbol, timeframe, tf,
    CASE WHEN max_ms IS NULL THEN 'initial' WHEN nxt < fin - tf THEN 'extend' ELSE 'none' END
      AS action,
    CASE WHEN max_ms IS NULL THEN {_START_MS} WHEN nxt < fin - tf THEN nxt END
      AS fetch_start_ms,
    CASE WHEN max_ms IS NULL THEN end_ms WHEN nxt < fin - tf THEN fin END AS fetch_end_ms
  FROM j
)"""
INCREMENTAL_PLAN_SQL = (
    _PLAN_SQL + " SELECT symbol, timeframe, action, fetch_start_ms, fetch_end_ms FROM plan"
)


def incremental_old_series(spark, sf_dir):
    """Stored series of orders that end in the last century are extended from their end."""
    stored = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("u"), F.col("o_custkey")).alias("symbol"), utc("o_orderdate").alias("time")
    )
    wanted = stored.select("symbol").distinct().select(
        "symbol", F.lit("1d").alias("timeframe"), F.lit(0).cast("long").alias("start_ms"),
        F.lit(None).cast("long").alias("end_ms"),
    )
    marks = incremental.high_water(stored, ["symbol"])
    plan = incremental.incremental_plan(wanted, marks, ["symbol"], NOW_MS)
    return plan.select("symbol", "action", "fetch_start_ms", "fetch_end_ms")


INCREMENTAL_OLD_SQL = f"""
SELECT 'u' || o_custkey AS symbol, 'extend' AS action,
  max(epoch_ms(o_orderdate)) + {DAY_MS} AS fetch_start_ms, {NOW_MS}::BIGINT AS fetch_end_ms
FROM orders GROUP BY o_custkey
"""


def _closed_plan(spark, sf_dir):
    return _plan(spark, sf_dir).withColumn(
        "fetch_end_ms", F.coalesce("fetch_end_ms", F.lit(NOW_MS))
    )


def page_plan(spark, sf_dir):
    """Pages of 100 bars for every range of the plan."""
    return incremental.bar_pages(_closed_plan(spark, sf_dir), ["symbol", "timeframe"], 100)


# Bars 0, 1, 2, ... of a range: a page starts at bar 0 and after every 100th bar, and a
# last short request follows a first page that was not full.
PAGE_PLAN_SQL = _PLAN_SQL + f"""
, r AS (
  SELECT symbol, timeframe, tf, fetch_start_ms AS a, coalesce(fetch_end_ms, {NOW_MS}) AS b
  FROM plan WHERE action <> 'none'
), n AS (SELECT *, (b - a) // tf AS bars, (b - a) % tf AS rest FROM r),
p AS (
  SELECT *, unnest(range(0, CASE WHEN bars <= 0 THEN 0
    WHEN bars < 100 THEN 1 + CAST(rest > 0 AS INT)
    ELSE (bars + CAST(rest > 0 AS INT) + 99) // 100 END)) AS page_no FROM n
), s AS (
  SELECT *, CASE WHEN page_no = 0 THEN a
    ELSE a + (least(page_no * 100, bars) - 1) * tf + 1 END AS page_start_ms FROM p
)
SELECT symbol, timeframe, page_no, page_start_ms, b AS page_end_ms,
  least((b - page_start_ms) // tf, 100) AS page_limit FROM s
"""


def page_plan_windows(spark, sf_dir):
    return incremental.window_pages(_closed_plan(spark, sf_dir), ["symbol", "timeframe"])


PAGE_WINDOWS_SQL = _PLAN_SQL + f"""
, r AS (
  SELECT symbol, timeframe, tf, fetch_start_ms AS a, coalesce(fetch_end_ms, {NOW_MS}) AS b
  FROM plan WHERE action <> 'none'
), p AS (
  SELECT *, unnest(generate_series(0, (b - a - 1) // (500 * tf))) AS page_no
  FROM r WHERE b > a
), s AS (
  SELECT *, a + page_no * 500 * tf AS page_start_ms,
    least(b, a + (page_no + 1) * 500 * tf) + 1000 AS page_end_ms FROM p
)
SELECT symbol, timeframe, page_no, page_start_ms, page_end_ms,
  least((page_end_ms - page_start_ms) // tf, 500) AS page_limit FROM s
WHERE (page_end_ms - page_start_ms) // tf > 0
"""


def request_validate(spark, sf_dir):
    """Every event as a request; the universe is the customers of two market segments."""
    rows = event_rows(spark, sf_dir)
    frame = (
        F.when(F.col("feed") == "click", "1h")
        .when(F.col("feed") == "error", "1d")
        .when(F.col("feed") == "purchase", "5m")
        .otherwise("1w")
    )
    wanted = rows.select(
        F.col("seq").alias("event_id"),
        "symbol",
        frame.alias("timeframe"),
        F.unix_millis("time").alias("start_ms"),
        F.when(
            F.col("feed") != "view",
            F.unix_millis("time") + ((F.col("value") - 10) * 3600000).cast("bigint"),
        ).alias("end_ms"),
    )
    universe = table(spark, sf_dir, "customer").filter(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    ).select(F.concat(F.lit("u/"), F.col("c_custkey")).alias("symbol"))
    checked = requests.validate_requests(wanted, NOW_MS, universe, look_back_days=15)
    return checked.select("event_id", "valid", "reason")


REQUEST_VALIDATE_SQL = f"""
WITH {EV_SQL}, q AS (
  SELECT seq, symbol, ms, CASE WHEN feed = 'view' THEN {NOW_MS} - 1000
      ELSE ms + trunc((value - 10) * 3600000)::BIGINT END AS fin, feed FROM ev
), uni AS (
  SELECT 'u' || c_custkey AS s FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
), m AS (
  SELECT seq, concat_ws('; ',
    CASE WHEN ms < {NOW_MS - 15 * DAY_MS} THEN 'start too old' END,
    CASE WHEN fin <= ms THEN 'end not after start' END,
    CASE WHEN feed = 'purchase' THEN 'timeframe not allowed' END,
    CASE WHEN symbol NOT IN (SELECT s FROM uni) THEN 'symbol not supported' END) AS reason
  FROM q
)
SELECT seq AS event_id, reason = '' AS valid, reason FROM m
"""


# -- holes -------------------------------------------------------------------
def gap_ranges(spark, sf_dir):
    return gaps.gap_ranges(event_bars(spark, sf_dir, "4h"), ["symbol"], "4h")


GAP_SQL = f"""
WITH {EV_SQL}, b AS (SELECT DISTINCT symbol, ms // 14400000 * 14400000 AS t FROM ev),
n AS (SELECT *, lead(t) OVER (PARTITION BY symbol ORDER BY t) AS nxt FROM b)
SELECT symbol, t + 14400000 AS gap_start_ms, nxt - 14400000 AS gap_end_ms,
  (nxt - t) // 14400000 - 1 AS missing FROM n WHERE nxt - t > 14400000
"""


def missing_bars(spark, sf_dir):
    missing = gaps.missing_bars(event_bars(spark, sf_dir, "4h"), ["symbol"], "4h")
    return missing.select("symbol", F.unix_millis("time").alias("time_ms"))


MISSING_SQL = f"""
WITH {EV_SQL}, b AS (SELECT DISTINCT symbol, ms // 14400000 * 14400000 AS t FROM ev),
span AS (SELECT symbol, min(t) AS a, max(t) AS z FROM b GROUP BY symbol),
grid AS (SELECT symbol, unnest(generate_series(a, z, 14400000)) AS t FROM span)
SELECT grid.symbol, grid.t AS time_ms FROM grid
WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.symbol = grid.symbol AND b.t = grid.t)
"""


# -- quality -----------------------------------------------------------------
def series_quality(spark, sf_dir):
    """Events in reverse order of id: every time is earlier than the one before it."""
    rows = hourly(event_rows(spark, sf_dir)).withColumn("arrival", -F.col("seq"))
    return quality.series_quality(
        rows,
        ["symbol"],
        arrival="arrival",
        checks={
            "n_large": F.col("value") > 100,
            "n_error": F.col("feed") == "error",
            # As a bar's high and low: the value against twice the number in its properties.
            "n_high_below_low": quality.high_below_low(F.col("value"), 2 * prop_k().cast("double")),
        },
    )


SERIES_QUALITY_SQL = f"""
WITH {HOURLY_SQL}, q AS (
  SELECT ev.symbol, h.time, ev.value, ev.feed, ev.props,
    lag(h.time) OVER (PARTITION BY ev.symbol ORDER BY ev.seq DESC) AS before
  FROM ev JOIN h USING (seq)
)
SELECT symbol, count(*) AS n_rows, 0::BIGINT AS n_null_time,
  count(*) - count(DISTINCT time) AS n_duplicate_time,
  count(*) FILTER (WHERE time < before) AS n_out_of_order,
  count(*) FILTER (WHERE value > 100) AS n_large,
  count(*) FILTER (WHERE feed = 'error') AS n_error,
  count(*) FILTER (WHERE value < 2 * CAST(props->>'$.k' AS DOUBLE)) AS n_high_below_low
FROM q GROUP BY symbol
"""


# -- reads -------------------------------------------------------------------
def read_range(spark, sf_dir):
    rows = as_table(event_rows(spark, sf_dir), "events", "1h")
    part = read.read_range(rows, start="2024-01-10 00:00:00", end="2024-01-12 12:00:00")
    ordered = part.orderBy("time", "seq")
    return read.formatted(ordered).select(
        "symbol", "time", F.col("seq").alias("event_id"), "feed", "value"
    )


_TEXT_TIME = "strftime(time, '%Y-%m-%d %H:%M:%S') AS time"
READ_RANGE_SQL = f"""
WITH {EV_SQL} SELECT symbol, {_TEXT_TIME}, seq AS event_id, feed, value FROM ev
WHERE time BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12 12:00:00'
"""


def read_dataset(spark, sf_dir):
    rows = as_table(event_rows(spark, sf_dir), "events", "1h")
    return _shown(read.read_range(rows, dataset="u7_1h"))


READ_DATASET_SQL = (
    f"WITH {EV_SQL} SELECT symbol, time, seq AS event_id, value FROM ev WHERE symbol = 'u7'"
)


def read_symbols(spark, sf_dir):
    rows = as_table(event_rows(spark, sf_dir), "events", "1h")
    part = read.read_range(rows, symbols=["u7", "u8", "u46"], start="2024-01-05")
    return _shown(read.with_dataset(part), "data_name")


READ_SYMBOLS_SQL = f"""
WITH {EV_SQL} SELECT symbol, time, seq AS event_id, value, symbol || '_1h' AS data_name
FROM ev WHERE symbol IN ('u7', 'u8', 'u46') AND time >= TIMESTAMP '2024-01-05'
"""


def read_tail_n(spark, sf_dir):
    rows = event_rows(spark, sf_dir).select("symbol", "time", "seq", "feed", "value")
    return read.formatted(read.tail(rows, tie_break=["seq"])).select(
        "symbol", "time", F.col("seq").alias("event_id"), "feed", "value"
    )


READ_TAIL_SQL = f"""
WITH {EV_SQL}, newest AS (SELECT * FROM ev ORDER BY time DESC, seq DESC LIMIT 1000)
SELECT symbol, {_TEXT_TIME}, seq AS event_id, feed, value FROM newest
"""


def read_tail_n_per_series(spark, sf_dir):
    rows = event_rows(spark, sf_dir).select("symbol", "time", "seq", "value")
    return _shown(read.tail_per_series(rows, ["symbol"], 20, tie_break=["seq"]))


def _newest_sql(n: int) -> str:
    return (
        f"WITH {EV_SQL} SELECT symbol, time, seq AS event_id, value FROM ev QUALIFY "
        f"row_number() OVER (PARTITION BY symbol ORDER BY time DESC, seq DESC) <= {n}"
    )


def latest_snapshot(spark, sf_dir):
    rows = event_rows(spark, sf_dir).select("symbol", "time", "seq", "value")
    return _shown(read.latest_row(rows, ["symbol"], tie_break=["seq"]))


QUERIES = {
    "bars_from_events": (bars_from_events, BARS_SQL),
    "bars_weekly": (bars_weekly, BARS_WEEKLY_SQL),
    "drop_unfinished_bars": (drop_unfinished_bars, DROP_UNFINISHED_SQL),
    "feeds_aligned": (feeds_aligned, FEEDS_ALIGNED_SQL),
    "fill_forward": (fill_forward, FILL_FORWARD_SQL),
    "fill_forward_backward": (fill_forward_backward, FILL_BOTH_SQL),
    "dedupe_keep_first": (dedupe_keep_first, _dedupe_sql("ASC")),
    "dedupe_keep_last": (dedupe_keep_last, _dedupe_sql("DESC")),
    "upsert_merge": (upsert_merge, UPSERT_MERGE_SQL),
    "upsert_unsettled": (upsert_unsettled, UPSERT_UNSETTLED_SQL),
    "upsert_summary": (upsert_summary, UPSERT_SUMMARY_SQL),
    "pages_union": (pages_union, PAGES_UNION_SQL),
    "incremental_plan": (incremental_plan, INCREMENTAL_PLAN_SQL),
    "page_plan": (page_plan, PAGE_PLAN_SQL),
    "page_plan_windows": (page_plan_windows, PAGE_WINDOWS_SQL),
    "request_validate": (request_validate, REQUEST_VALIDATE_SQL),
    "gap_ranges": (gap_ranges, GAP_SQL),
    "missing_bars": (missing_bars, MISSING_SQL),
    "bars_fine_values": (bars_fine_values, BARS_FINE_SQL),
    "incremental_old_series": (incremental_old_series, INCREMENTAL_OLD_SQL),
    "series_quality": (series_quality, SERIES_QUALITY_SQL),
    "read_range": (read_range, READ_RANGE_SQL),
    "read_dataset": (read_dataset, READ_DATASET_SQL),
    "read_symbols": (read_symbols, READ_SYMBOLS_SQL),
    "read_tail_n": (read_tail_n, READ_TAIL_SQL),
    "read_tail_n_per_series": (read_tail_n_per_series, _newest_sql(20)),
    "latest_snapshot": (latest_snapshot, _newest_sql(1)),
}
