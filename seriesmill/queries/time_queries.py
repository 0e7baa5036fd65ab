"""Time-frame, time-range and slot functions over the event, order and document tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.functions import timeframe as tf
from seriesmill.functions import timerange as tr
from seriesmill.functions.names import format_size
from seriesmill.functions.slots import in_slot
from seriesmill.operators.ordered import rising_edge
from seriesmill.queries.inputs import NOW_MS, event_rows, prop_k, table
from seriesmill.schemas import naive, utc

FRAMES = ["15m", "1h", "4h", "1d", "7d", "1w"]
_FRAMES_SQL = (
    "(VALUES ('15m', 900000), ('1h', 3600000), ('4h', 14400000), ('1d', 86400000), "
    "('7d', 604800000), ('1w', 604800000)) AS f(timeframe, tf)"
)
_EV = (
    # epoch_ms() rounds to the nearest millisecond; times are cut, so divide instead.
    "SELECT event_id, (epoch_us(ts) // 1000) AS ms, epoch_ms(date_trunc('week', ts)) AS monday, "
    f"timeframe, tf FROM events CROSS JOIN {_FRAMES_SQL}"
)


def _framed(spark, sf_dir):
    """Every event with every time frame; a fixed list, so an explode and no join."""
    return event_rows(spark, sf_dir).select(
        F.col("seq").alias("event_id"),
        F.unix_millis("time").alias("ms"),
        F.explode(F.array(*[F.lit(x) for x in FRAMES])).alias("timeframe"),
    ).withColumn("step", tf.step_ms(F.col("timeframe")))


def tf_minutes(spark, sf_dir):
    unit = (
        F.when(F.col("feed") == "click", "m")
        .when(F.col("feed") == "error", "Hours")
        .when(F.col("feed") == "purchase", "M")
        .when(F.col("feed") == "signup", "")
        .when(F.col("value") < 20, "ms")
        .when(F.col("value") < 60, "w")
        .otherwise("fortnight")
    )
    rows = event_rows(spark, sf_dir).select(
        F.col("seq").alias("event_id"), F.concat(prop_k(), unit).alias("text")
    )
    text = F.col("text")
    return rows.select(
        "event_id",
        "text",
        tf.tf_minutes(text).alias("minutes"),
        tf.tf_seconds(text).alias("seconds"),
        tf.tf_ms(text).alias("ms"),
    )


TF_MINUTES_SQL = """
WITH t AS (
  SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, event_type, value,
    CASE WHEN event_type = 'click' THEN 'm' WHEN event_type = 'error' THEN 'Hours'
         WHEN event_type = 'purchase' THEN 'M' WHEN event_type = 'signup' THEN ''
         WHEN value < 20 THEN 'ms' WHEN value < 60 THEN 'w' ELSE 'fortnight' END AS unit
  FROM events
), m AS (
  SELECT event_id, k::VARCHAR || unit AS text,
    CASE unit WHEN 'm' THEN k WHEN 'Hours' THEN k * 60
      WHEN 'M' THEN CASE WHEN k = 1 THEN 43200 ELSE k END
      WHEN '' THEN k WHEN 'ms' THEN k WHEN 'w' THEN k * 10080 END AS minutes
  FROM t
)
SELECT event_id, text, minutes::BIGINT AS minutes, (minutes * 60)::BIGINT AS seconds,
  (minutes * 60000)::BIGINT AS ms FROM m
"""


def tf_round(spark, sf_dir):
    ms, frame, step = F.col("ms"), F.col("timeframe"), F.col("step")
    down = tf.round_down(ms, frame, step)
    return _framed(spark, sf_dir).select(
        "event_id",
        "timeframe",
        down.alias("down_ms"),
        tf.round_up(ms, frame, step).alias("up_ms"),
        naive(tf.to_time(down)).alias("down_time"),
    )


TF_ROUND_SQL = f"""
SELECT event_id, timeframe, (ms // tf * tf)::BIGINT AS down_ms,
  (ms // tf * tf + tf)::BIGINT AS up_ms, make_timestamp_ms(ms // tf * tf) AS down_time
FROM ({_EV})
"""


def tf_prev(spark, sf_dir):
    return _framed(spark, sf_dir).select(
        "event_id",
        "timeframe",
        tf.bucket_start(F.col("ms"), F.col("timeframe"), F.col("step")).alias("prev_ms"),
    )


TF_PREV_SQL = f"""
SELECT event_id, timeframe,
  (CASE WHEN timeframe = '1w' THEN monday ELSE ms // tf * tf END)::BIGINT AS prev_ms
FROM ({_EV})
"""


def tf_next(spark, sf_dir):
    return _framed(spark, sf_dir).select(
        "event_id",
        "timeframe",
        tf.bucket_end(F.col("ms"), F.col("timeframe"), F.col("step")).alias("next_ms"),
    )


TF_NEXT_SQL = f"""
SELECT event_id, timeframe,
  (CASE WHEN timeframe = '1w' THEN monday ELSE ms // tf * tf END + tf)::BIGINT AS next_ms
FROM ({_EV})
"""


def tf_align(spark, sf_dir):
    """Both sides, for the event time and for the start of its bar (a boundary)."""
    ms, frame, step = F.col("ms"), F.col("timeframe"), F.col("step")
    edge = tf.round_down(ms, frame, step)
    return _framed(spark, sf_dir).select(
        "event_id",
        "timeframe",
        tf.align(ms, frame, "prev", step).alias("prev_ms"),
        tf.align(ms, frame, "next", step).alias("next_ms"),
        tf.align(edge, frame, "prev", step).alias("edge_prev_ms"),
        tf.align(edge, frame, "next", step).alias("edge_next_ms"),
        tf.align(ms, F.concat(F.lit("x"), frame), "prev").alias("unreadable_ms"),
    )


TF_ALIGN_SQL = f"""
WITH e AS (SELECT *, ms // tf * tf AS edge FROM ({_EV}))
SELECT event_id, timeframe,
  (CASE WHEN ms % tf = 0 AND ms // tf > 0 THEN ms - tf ELSE edge END)::BIGINT AS prev_ms,
  (CASE WHEN ms % tf = 0 THEN ms ELSE edge + tf END)::BIGINT AS next_ms,
  (CASE WHEN edge > 0 THEN edge - tf ELSE edge END)::BIGINT AS edge_prev_ms,
  edge::BIGINT AS edge_next_ms, ms::BIGINT AS unreadable_ms
FROM e
"""


def tf_near_boundary(spark, sf_dir):
    ms, frame, step = F.col("ms"), F.col("timeframe"), F.col("step")
    return _framed(spark, sf_dir).select(
        "event_id",
        "timeframe",
        tf.near_start(ms, frame, 300, step).alias("at_start"),
        tf.near_end(ms, frame, 300, step).alias("at_end"),
    )


TF_NEAR_SQL = f"""
WITH e AS (SELECT *, CASE WHEN timeframe = '1w' THEN monday ELSE ms // tf * tf END AS p
  FROM ({_EV}))
SELECT event_id, timeframe, ms - 300000 <= p AS at_start, ms + 300000 >= p + tf AS at_end
FROM e
"""


def _range_texts(spark, sf_dir):
    """Range texts of every documented form, and two that are no range."""
    day = utc("o_orderdate")
    start = F.date_format(day, "yyyyMMdd")
    end = F.date_format(day + F.expr("INTERVAL 30 YEARS"), "yyyyMMdd")
    pieces = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(start, F.lit("-"), end))
    pieces = pieces.when(F.col("o_orderpriority") == "2-HIGH", F.concat(start, F.lit("-")))
    pieces = pieces.when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("-"), end))
    pieces = pieces.when(
        F.col("o_orderstatus") == "F",
        F.concat(end, F.lit("_101112-"), start, F.lit("_131415")),
    )
    pieces = pieces.when(F.col("o_orderstatus") == "O", start).otherwise(
        F.concat(F.lit("x"), start, F.lit("-"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", pieces.alias("text"))


_RANGE_SQL = """
WITH t AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS s,
    strftime(o_orderdate + INTERVAL 30 YEAR, '%Y%m%d') AS e, o_orderpriority AS p,
    o_orderstatus AS st FROM orders
), x AS (
  SELECT o_orderkey,
    CASE WHEN p = '1-URGENT' THEN s || '-' || e WHEN p = '2-HIGH' THEN s || '-'
      WHEN p = '3-MEDIUM' THEN '-' || e
      WHEN st = 'F' THEN e || '_101112-' || s || '_131415'
      WHEN st = 'O' THEN s ELSE 'x' || s || '-' END AS text,
    CASE WHEN p = '1-URGENT' OR p = '2-HIGH' THEN epoch_ms(strptime(s, '%Y%m%d'))
      WHEN p = '3-MEDIUM' THEN 1704067200000
      WHEN st = 'F' THEN epoch_ms(strptime(e || '101112', '%Y%m%d%H%M%S')) END AS start_ms,
    CASE WHEN p = '1-URGENT' OR p = '3-MEDIUM'
        THEN epoch_ms(strptime(e, '%Y%m%d')) + 86399000
      WHEN p = '2-HIGH' THEN NULL
      WHEN st = 'F' THEN epoch_ms(strptime(s || '131415', '%Y%m%d%H%M%S')) END AS end_ms
  FROM t
)
"""


def timerange_parse(spark, sf_dir):
    rows = tr.read_ranges(_range_texts(spark, sf_dir), "text")
    return rows.select("o_orderkey", "text", "valid", "start_ms", "end_ms")


TIMERANGE_PARSE_SQL = _RANGE_SQL + """
SELECT o_orderkey, text, start_ms IS NOT NULL AS valid, start_ms, end_ms FROM x
"""


def timerange_sanitize(spark, sf_dir):
    rows = tr.read_ranges(_range_texts(spark, sf_dir), "text", NOW_MS)
    return rows.select("o_orderkey", "start_ms", "end_ms")


TIMERANGE_SANITIZE_SQL = _RANGE_SQL + f"""
, y AS (
  SELECT o_orderkey,
    CASE WHEN start_ms < 1000000000000 OR start_ms > 3000000000000
      THEN 1640995200000 ELSE start_ms END AS a,
    CASE WHEN end_ms < 1000000000000 OR end_ms > 3000000000000
      THEN {NOW_MS} ELSE end_ms END AS b
  FROM x
)
SELECT o_orderkey, CASE WHEN a > b THEN b ELSE a END AS start_ms,
  CASE WHEN a > b THEN a ELSE b END AS end_ms FROM y
"""


def timerange_contains(spark, sf_dir):
    """Every event against four ranges: both ends, open start, open end, zero start."""
    rows = event_rows(spark, sf_dir).withColumn("ms", F.unix_millis("time"))
    low, high = F.lit(1704844800000), F.lit(1705708800000)
    null, ms = F.lit(None).cast("bigint"), F.col("ms")
    return rows.select(
        F.col("seq").alias("event_id"),
        tr.contains(ms, low, high).alias("inside"),
        tr.contains(ms, null, high).alias("open_start"),
        tr.contains(ms, low, null).alias("open_end"),
        tr.contains(ms, F.lit(0), F.lit(0)).alias("zero"),
        tr.contains(ms, ms, ms).alias("own"),
    )


TIMERANGE_CONTAINS_SQL = """
SELECT event_id, (epoch_us(ts) // 1000) BETWEEN 1704844800000 AND 1705708800000 AS inside,
  (epoch_us(ts) // 1000) <= 1705708800000 AS open_start, (epoch_us(ts) // 1000) >= 1704844800000 AS open_end,
  TRUE AS zero, TRUE AS own
FROM events
"""


def time_parse(spark, sf_dir):
    rows = event_rows(spark, sf_dir).withColumn("k", prop_k())
    text = (
        F.when(
            F.col("feed") == "click", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        )
        .when(F.col("feed") == "error", F.concat(F.lit("-"), "k", F.lit("h")))
        .when(F.col("feed") == "purchase", F.concat("k", F.lit("M")))
        .when(F.col("feed") == "signup", F.date_format("time", "yyyy-MM-dd"))
        .when(F.col("value") < 50, F.concat(F.lit("+"), "k", F.lit("y")))
        .otherwise(F.concat("k", F.lit(" days ago")))
    )
    number = F.when(F.col("value") < 50, F.unix_millis("time")).otherwise(
        F.unix_seconds("time")
    )
    return rows.select(
        F.col("seq").alias("event_id"),
        text.alias("text"),
        tr.parse_time(text, NOW_MS).alias("ms"),
        naive(tr.epoch_to_time(number.cast("double"))).alias("guessed"),
        tr.seconds_to_ms(F.col("value")).alias("value_ms"),
    )


TIME_PARSE_SQL = f"""
WITH t AS (SELECT *, props->>'$.k' AS k FROM events)
SELECT event_id,
  CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
    WHEN 'error' THEN '-' || k || 'h' WHEN 'purchase' THEN k || 'M'
    WHEN 'signup' THEN strftime(ts, '%Y-%m-%d')
    ELSE CASE WHEN value < 50 THEN '+' || k || 'y' ELSE k || ' days ago' END END AS text,
  CASE event_type WHEN 'click' THEN (epoch_us(ts) // 1000)
    WHEN 'error' THEN {NOW_MS} - k::BIGINT * 3600000
    WHEN 'purchase' THEN {NOW_MS} + k::BIGINT * 60000
    WHEN 'signup' THEN epoch_ms(date_trunc('day', ts)::TIMESTAMP)
    ELSE CASE WHEN value < 50 THEN {NOW_MS} + k::BIGINT * 31536000000 END END AS ms,
  CASE WHEN value < 50 THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END
    AS guessed,
  trunc(value * 1000)::BIGINT AS value_ms
FROM t
"""


def fmt_size(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    n = F.col("n_chars")
    return docs.select(
        "doc_id",
        format_size(n).alias("plain"),
        format_size(n * 1000).alias("times_1e3"),
        format_size(n * 1000000).alias("times_1e6"),
        format_size(n - n).alias("none"),
    )


_SIZE_SQL = """CASE WHEN {n} IS NULL OR {n} <= 0 THEN '0 B'
  WHEN {n} < 1024 THEN {n}::VARCHAR || ' B'
  WHEN {n} < 1048576 THEN printf('%.1f KB', {n} / 1024.0::DOUBLE)
  WHEN {n} < 1073741824 THEN printf('%.1f MB', {n} / 1048576.0::DOUBLE)
  ELSE printf('%.1f GB', {n} / 1073741824.0::DOUBLE) END"""


def size_sql(expression: str) -> str:
    return _SIZE_SQL.format(n=f"({expression})")


FMT_SIZE_SQL = f"""
SELECT doc_id, {size_sql('n_chars')} AS plain, {size_sql('n_chars * 1000')} AS times_1e3,
  {size_sql('n_chars * 1000000')} AS times_1e6, '0 B' AS none FROM documents
"""

_DAILY, _HOURLY = ("09:30:00", "16:00:00"), ("15:00", "45:30")


def slot_filter(spark, sf_dir):
    return event_rows(spark, sf_dir).select(
        F.col("seq").alias("event_id"),
        in_slot(F.col("time"), *_DAILY).alias("in_daily"),
        in_slot(F.col("time"), *_HOURLY).alias("in_hourly"),
    )


_DAILY_SQL = "(ts::TIME > TIME '09:30:00' AND ts::TIME < TIME '16:00:00')"
SLOT_FILTER_SQL = f"""
SELECT event_id, {_DAILY_SQL} AS in_daily,
  (ts - date_trunc('hour', ts) > INTERVAL '15 minutes'
   AND ts - date_trunc('hour', ts) < INTERVAL '45 minutes 30 seconds') AS in_hourly
FROM events
"""


def slot_rising_edge(spark, sf_dir):
    rows = event_rows(spark, sf_dir).select("symbol", "time", "seq")
    edges = rising_edge(rows, ["symbol"], ["time", "seq"], in_slot(F.col("time"), *_DAILY))
    return edges.select("symbol", F.col("seq").alias("event_id"), "fires")


SLOT_EDGE_SQL = f"""
WITH t AS (SELECT 'u' || user_id AS symbol, event_id, ts, {_DAILY_SQL} AS c FROM events)
SELECT symbol, event_id,
  c AND NOT coalesce(lag(c) OVER (PARTITION BY symbol ORDER BY ts, event_id), FALSE) AS fires
FROM t
"""


def tf_rising_edge(spark, sf_dir):
    """Events that are the first of their series near the end of a four-hour bar."""
    rows = event_rows(spark, sf_dir).select("symbol", "time", "seq")
    near = tf.near_end(F.unix_millis("time"), "4h", 3600)
    edges = rising_edge(rows, ["symbol"], ["time", "seq"], near)
    return edges.select("symbol", F.col("seq").alias("event_id"), "fires")


TF_EDGE_SQL = """
WITH t AS (SELECT 'u' || user_id AS symbol, event_id, ts, epoch_us(ts) // 1000 AS ms FROM events),
c AS (SELECT *, ms + 3600000 >= ms // 14400000 * 14400000 + 14400000 AS near FROM t)
SELECT symbol, event_id, near AND NOT coalesce(
  lag(near) OVER (PARTITION BY symbol ORDER BY ts, event_id), FALSE) AS fires FROM c
"""


def sentiment_days(spark, sf_dir):
    """Daily records needed from the time of every event to now."""
    return event_rows(spark, sf_dir).select(
        F.col("seq").alias("event_id"),
        tr.whole_days(F.unix_millis("time"), NOW_MS).cast("bigint").alias("days"),
    )


SENTIMENT_DAYS_SQL = """
SELECT event_id, date_diff('day', ts::DATE, DATE '2024-01-31') AS days FROM events
"""

QUERIES = {
    "tf_minutes": (tf_minutes, TF_MINUTES_SQL),
    "tf_round": (tf_round, TF_ROUND_SQL),
    "tf_prev": (tf_prev, TF_PREV_SQL),
    "tf_next": (tf_next, TF_NEXT_SQL),
    "tf_align": (tf_align, TF_ALIGN_SQL),
    "tf_near_boundary": (tf_near_boundary, TF_NEAR_SQL),
    "timerange_parse": (timerange_parse, TIMERANGE_PARSE_SQL),
    "timerange_sanitize": (timerange_sanitize, TIMERANGE_SANITIZE_SQL),
    "timerange_contains": (timerange_contains, TIMERANGE_CONTAINS_SQL),
    "time_parse": (time_parse, TIME_PARSE_SQL),
    "fmt_size": (fmt_size, FMT_SIZE_SQL),
    "slot_filter": (slot_filter, SLOT_FILTER_SQL),
    "slot_rising_edge": (slot_rising_edge, SLOT_EDGE_SQL),
    "tf_rising_edge": (tf_rising_edge, TF_EDGE_SQL),
    "sentiment_days": (sentiment_days, SENTIMENT_DAYS_SQL),
}
