"""Queries over what is kept beside the rows: index, coverage, runs."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.timeframe import bucket_start
from seriesmill.operators.dedupe import keep_first
from seriesmill.plans import coverage, incremental, requests, runs
from seriesmill.queries.inputs import FEEDS, NOW_MS, as_table, event_rows, hourly, rounded_volume, table
from seriesmill.queries.series_queries import EV_SQL, ONE_DAY, bars_sql
from seriesmill.queries.source_queries import VALUES
from seriesmill.schemas import naive, utc
from seriesmill.session import work_path
from seriesmill.sources import documents, feather, manifest, paged, paths, registry
from seriesmill.sources.store import SeriesTable
from seriesmill.streaming import ingest

# -- the index of the series table ---------------------------------------------
def _order_rows(spark, sf_dir):
    """Orders by their day of the year, one daily series per customer over twelve months; days repeat."""
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("c"), F.col("o_custkey")).alias("symbol"),
        utc(F.expr("TIMESTAMP_NTZ '1996-01-01' + make_dt_interval(dayofyear(o_orderdate) - 1)")).alias("time"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderkey").alias("seq"),
    )
    return as_table(rows, "orders", "1d")


def _segment(spark, sf_dir, segment):
    customers = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == segment)
    rows = customers.select(F.concat(F.lit("c"), F.col("c_custkey")).alias("symbol"))
    return as_table(rows, "orders", "1d").select("source", "symbol", "timeframe")


def _order_table(spark, sf_dir):
    """Two overlapping upserts, then one segment's series deleted and one's replaced."""
    rows = _order_rows(spark, sf_dir)
    made = SeriesTable(spark, work_path(spark, "orders"), VALUES)
    made.upsert(rows.filter(F.col("time") < F.lit("1996-06-10").cast("timestamp")), ["seq"])
    made.upsert(rows.filter(F.col("time") >= F.lit("1996-03-20").cast("timestamp")), ["seq"])
    made.delete(_segment(spark, sf_dir, "BUILDING"))
    early = made.read(end="1996-07-31 00:00:00").withColumn("value", F.col("value") * 2)
    made.replace(early.join(_segment(spark, sf_dir, "MACHINERY"), ["source", "symbol", "timeframe"], "left_semi"))
    return made


_ORDERS_SQL = """
k AS (
  SELECT 'c' || o_custkey AS symbol, TIMESTAMP '1996-01-01' + to_days(dayofyear(o_orderdate) - 1) AS time,
    arg_min(o_totalprice, o_orderkey) AS value, any_value(c_mktsegment) AS segment
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey, dayofyear(o_orderdate)
), early AS (SELECT DISTINCT symbol FROM k WHERE segment = 'MACHINERY' AND time < TIMESTAMP '1996-08-01'),
o AS (
  SELECT symbol, time, CASE WHEN segment = 'MACHINERY' AND symbol IN (FROM early) THEN value * 2 ELSE value END AS value
  FROM k WHERE segment <> 'BUILDING'
    AND (segment <> 'MACHINERY' OR time < TIMESTAMP '1996-08-01' OR symbol NOT IN (FROM early))
)"""
_SIZE_SQL = "sum(length('{\"time\":' || epoch_ms(time) || ',\"value\":' || value || '}'))::BIGINT"


def store_index(spark, sf_dir):
    """What the index holds by series and month after upserts, a delete and a replace."""
    return _order_table(spark, sf_dir).index_rows().select(
        "symbol", "month", "row_count", "size_bytes",
        naive("first_time").alias("first_time"), naive("last_time").alias("last_time"),
    )


STORE_INDEX_SQL = f"""
WITH {_ORDERS_SQL}
SELECT symbol, strftime(time, '%Y-%m') AS month, count(*) AS row_count, {_SIZE_SQL} AS size_bytes,
  min(time) AS first_time, max(time) AS last_time
FROM o GROUP BY 1, 2
"""


def store_marks(spark, sf_dir):
    """High-water marks of the changed table, from its index."""
    return _order_table(spark, sf_dir).high_water().select("symbol", "min_ms", "max_ms")


STORE_MARKS_SQL = f"""
WITH {_ORDERS_SQL} SELECT symbol, epoch_ms(min(time)) AS min_ms, epoch_ms(max(time)) AS max_ms FROM o GROUP BY 1
"""


def store_tail_pooled(spark, sf_dir):
    """The last 200 rows over all series, from the newest months."""
    return _order_table(spark, sf_dir).tail(200).select("symbol", naive("time").alias("time"), "value")


STORE_TAIL_POOLED_SQL = f"WITH {_ORDERS_SQL} SELECT * FROM o ORDER BY time DESC, symbol DESC LIMIT 200"


# -- coverage --------------------------------------------------------------------
_DAY_MS = 86_400_000
_START_MS = 1_703_980_800_000  # 2023-12-31


def _hours_had(spark, sf_dir):
    """Every event as the hour it lies in: overlapping, touching and repeated intervals."""
    rows = event_rows(spark, sf_dir)
    hour = bucket_start(F.unix_millis("time"), "1h")
    return rows.select("symbol", hour.alias("start_ms"), (hour + 3_600_000).alias("end_ms"))


def coverage_union(spark, sf_dir):
    """Each user's hours with events, and the two days after each purchase, as maximal intervals."""
    rows = event_rows(spark, sf_dir).filter(F.col("feed") == "purchase")
    at = F.unix_millis("time")
    after = rows.select("symbol", at.alias("start_ms"), (at + 2 * _DAY_MS).alias("end_ms"))
    return coverage.union(_hours_had(spark, sf_dir), after, series=["symbol"])


_HOURS_SQL = """
had AS (
  SELECT 'u' || user_id AS symbol, epoch_ms(date_trunc('hour', ts)) AS a, epoch_ms(date_trunc('hour', ts)) + 3600000 AS z
  FROM events
)"""


def _islands_sql(name: str, source: str) -> str:
    """Maximal intervals by gaps and islands over sorted starts."""
    return f"""
{name}_marked AS (
  SELECT symbol, a, z, max(z) OVER (PARTITION BY symbol ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    AS reached FROM {source}
), {name}_numbered AS (
  SELECT *, count(*) FILTER (WHERE reached IS NULL OR a > reached) OVER (PARTITION BY symbol ORDER BY a, z
    ROWS UNBOUNDED PRECEDING) AS island FROM {name}_marked
), {name} AS (SELECT symbol, min(a) AS a, max(z) AS z FROM {name}_numbered GROUP BY symbol, island)"""


COVERAGE_UNION_SQL = f"""
WITH {_HOURS_SQL}, every AS (
  FROM had UNION ALL SELECT 'u' || user_id, epoch_us(ts) // 1000, epoch_us(ts) // 1000 + {2 * _DAY_MS}
  FROM events WHERE event_type = 'purchase'
), {_islands_sql('runs', 'every')}
SELECT symbol, a AS start_ms, z AS end_ms FROM runs
"""


def fetch_segments(spark, sf_dir):
    """Every customer's January is asked for; some from the 10th on, some with an end."""
    key = F.col("c_custkey")
    asked = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("u"), key).alias("symbol"),
        (F.lit(_START_MS) + F.when(key % 3 == 0, 10 * _DAY_MS).otherwise(0)).alias("start_ms"),
        F.when(key % 4 == 0, F.lit(_START_MS + 20 * _DAY_MS)).when(key % 4 == 1, F.lit(0)).alias("end_ms"),
    )
    return coverage.fetch_segments(asked, _hours_had(spark, sf_dir), ["symbol"], NOW_MS)


FETCH_SEGMENTS_SQL = f"""
WITH {_HOURS_SQL}, asked AS (
  SELECT 'u' || c_custkey AS symbol, {_START_MS} + CASE WHEN c_custkey % 3 = 0 THEN {10 * _DAY_MS} ELSE 0 END AS a,
    CASE WHEN c_custkey % 4 = 0 THEN {_START_MS + 20 * _DAY_MS} ELSE {NOW_MS} END AS z FROM customer
), {_islands_sql('runs', 'had')}, cut AS (
  SELECT q.symbol, greatest(r.a, q.a) AS a, least(r.z, q.z) AS z FROM asked q JOIN runs r ON r.symbol = q.symbol
  WHERE r.z > q.a AND r.a < q.z
), edges AS (
  SELECT symbol, z AS from_ms, lead(a) OVER (PARTITION BY symbol ORDER BY a) AS to_ms FROM cut
  UNION ALL SELECT q.symbol, q.a, min(c.a) FROM asked q LEFT JOIN cut c ON c.symbol = q.symbol GROUP BY q.symbol, q.a
)
SELECT e.symbol, from_ms AS fetch_start_ms, coalesce(to_ms, q.z) AS fetch_end_ms
FROM edges e JOIN asked q ON q.symbol = e.symbol WHERE from_ms < coalesce(to_ms, q.z)
"""


# -- runs ------------------------------------------------------------------------
def _run(spark, sf_dir):
    """Hourly rows before January 20th are stored; a run then gets everything that was landed.

    Of the landed rows, errors carry no value, some signups come without a time and views of
    the first minutes keep their exact time; customers of one segment are not asked for.
    """
    rows = as_table(event_rows(spark, sf_dir).select("symbol", "time", "feed", "seq", "value"), "events", "1h")
    whole = hourly(rows)
    made = SeriesTable(spark, work_path(spark, "series"), VALUES)
    made.upsert(whole.filter(F.col("time") < F.lit("2024-01-20").cast("timestamp")), ["seq"])
    minute = F.minute("time")
    time = F.timestamp_millis(bucket_start(F.unix_millis("time"), "1h"))
    landed = rows.withColumn(
        "value", F.when(F.col("feed") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    ).withColumn(
        "time",
        F.when((F.col("feed") == "signup") & (minute < 6), F.lit(None).cast("timestamp"))
        .when((F.col("feed") == "view") & (minute < 3), F.timestamp_millis(F.unix_millis("time")))
        .otherwise(time),
    )
    key = F.col("c_custkey")
    asked = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    requests = as_table(
        asked.select(
            F.concat(F.lit("u"), key).alias("symbol"),
            F.lit(_START_MS).alias("start_ms"),
            F.when(key % 4 == 0, F.lit(_START_MS + 25 * _DAY_MS)).alias("end_ms"),
        ),
        "events",
        "1h",
    )
    return runs.incremental_run(
        made, requests, landed.drop("feed"), NOW_MS, run_id="r1", folder=work_path(spark, "run"), arrival=["seq"]
    )


def incremental_run(spark, sf_dir):
    """The summary of the run, one row a series."""
    out = _run(spark, sf_dir).summary.drop("source", "timeframe")
    return out.withColumn("first_time", naive("first_time")).withColumn("last_time", naive("last_time"))


def run_set_aside(spark, sf_dir):
    """What the run set aside, with all reasons of each row."""
    out = _run(spark, sf_dir).set_aside
    return out.select("run_id", "symbol", F.array_join("reasons", ", ").alias("reasons"), "seq")


_RUN_SQL = f"""
e AS (
  SELECT 'u' || user_id AS symbol, ts, event_id AS seq, event_type AS feed, value, minute(ts) AS m,
    date_trunc('hour', ts) AS hour FROM events
), stored AS (SELECT symbol, hour FROM e WHERE hour < TIMESTAMP '2024-01-20' GROUP BY ALL),
landed AS (
  SELECT symbol, seq, feed <> 'error' AS has_value,
    CASE WHEN feed = 'signup' AND m < 6 THEN NULL WHEN feed = 'view' AND m < 3 THEN date_trunc('millisecond', ts)
      ELSE hour END AS time FROM e
), plan AS (
  SELECT symbol, CASE WHEN top IS NULL THEN 'initial' WHEN top + 3600000 < z - 3600000 THEN 'extend' ELSE 'none' END AS action,
    CASE WHEN top IS NULL THEN {_START_MS} ELSE top + 3600000 END AS a, z
  FROM (SELECT 'u' || c_custkey AS symbol,
      CASE WHEN c_custkey % 4 = 0 THEN {_START_MS + 25 * _DAY_MS} ELSE {NOW_MS} END AS z
    FROM customer WHERE c_mktsegment <> 'BUILDING')
  LEFT JOIN (SELECT symbol, epoch_ms(max(hour)) AS top FROM stored GROUP BY symbol) USING (symbol)
), marked AS (
  SELECT l.symbol, l.seq, l.time, p.action, concat_ws(', ',
      CASE WHEN l.time IS NULL THEN 'no time' END, CASE WHEN p.symbol IS NULL THEN 'not requested' END,
      CASE WHEN l.time <> date_trunc('hour', l.time) THEN 'off the grid' END,
      CASE WHEN epoch_ms(l.time) + 3600000 > {NOW_MS} THEN 'unfinished' END,
      CASE WHEN NOT has_value THEN 'value is missing' END) AS reasons,
    coalesce(p.action <> 'none' AND epoch_ms(l.time) BETWEEN p.a AND p.z, FALSE) AS due
  FROM landed l LEFT JOIN plan p USING (symbol)
)"""

INCREMENTAL_RUN_SQL = f"""
WITH {_RUN_SQL}, added AS (
  SELECT symbol, time FROM marked WHERE reasons = '' AND due
  EXCEPT SELECT symbol, hour FROM stored
), per AS (
  SELECT symbol, count(*) AS rows_in, count(*) FILTER (WHERE reasons = '' AND NOT due) AS rows_skipped,
    count(*) FILTER (WHERE reasons <> '') AS rows_set_aside FROM marked GROUP BY symbol
), new AS (SELECT symbol, count(*) AS n, min(time) AS first_time, max(time) AS last_time FROM added GROUP BY symbol),
s AS (
  SELECT symbol, action, coalesce(rows_in, 0) AS rows_in, coalesce(n, 0) AS rows_new,
    coalesce(rows_skipped, 0) AS rows_skipped, coalesce(rows_set_aside, 0) AS rows_set_aside, first_time, last_time
  FROM plan FULL JOIN per USING (symbol) LEFT JOIN new USING (symbol)
)
SELECT 'r1' AS run_id, *, rows_in - rows_new - rows_skipped - rows_set_aside AS rows_known,
  CASE WHEN action IS NULL THEN 'unknown' WHEN rows_new > 0 AND rows_set_aside > 0 THEN 'partial'
    WHEN rows_new > 0 THEN 'completed' WHEN rows_set_aside > 0 THEN 'failed'
    WHEN action <> 'none' AND rows_in = 0 THEN 'no data' ELSE 'idle' END AS status
FROM s
"""
RUN_SET_ASIDE_SQL = f"WITH {_RUN_SQL} SELECT 'r1' AS run_id, symbol, reasons, seq FROM marked WHERE reasons <> ''"


# -- an own store ------------------------------------------------------------------
def own_store(spark, sf_dir):
    """Event types as datasets of a store with manifests: saved, appended to, one replaced, one deleted."""
    kind, folder = registry.get_store("manifest"), work_path(spark, "store")
    rows = event_rows(spark, sf_dir).select("symbol", "time", "feed", "value")
    early = F.col("time") < F.lit("2024-01-16").cast("timestamp")
    for feed in FEEDS:
        own = rows.filter(F.col("feed") == feed)
        kind.write(own.filter(early), f"{folder}/{feed}")
        manifest.save(own.filter(~early), f"{folder}/{feed}", append=True)
    kind.write(rows.filter((F.col("feed") == "view") & early), f"{folder}/view")
    kind.delete(spark, f"{folder}/error")
    kept = [kind.read(spark, f"{folder}/{feed}", rows.schema) for feed in FEEDS]
    return reduce(DataFrame.unionByName, kept).withColumn("time", naive("time"))


OWN_STORE_SQL = """
SELECT 'u' || user_id AS symbol, ts AS time, event_type AS feed, value FROM events
WHERE event_type <> 'error' AND (event_type <> 'view' OR ts < TIMESTAMP '2024-01-16')
"""


def own_store_listed(spark, sf_dir):
    """What the store lists of its datasets, and their time ranges, without reading rows."""
    kind, folder = registry.get_store("manifest"), work_path(spark, "store")
    rows = event_rows(spark, sf_dir).select("symbol", "time", "feed", "value")
    for feed in FEEDS:
        kind.write(rows.filter(F.col("feed") == feed), f"{folder}/{feed}")
    kind.delete(spark, f"{folder}/error")
    ranges = [
        kind.time_range(spark, f"{folder}/{feed}", rows.schema).withColumn("id", F.lit(feed)) for feed in FEEDS
    ]
    found = kind.list(spark, folder).select("id", "rows").join(reduce(DataFrame.unionByName, ranges), "id")
    return found.withColumn("start_time", naive("start_time")).withColumn("end_time", naive("end_time"))


OWN_STORE_LISTED_SQL = """
SELECT event_type AS id, count(*) AS rows, min(ts) AS start_time, max(ts) AS end_time
FROM events WHERE event_type <> 'error' GROUP BY event_type
"""


# -- requests by venue ----------------------------------------------------------------
def request_venues(spark, sf_dir):
    """Parts as symbols of a venue, their brand; a request to a brand that is not listed is refused."""
    size = F.col("p_size")
    symbol = F.when(size % 3 == 0, F.concat("p_brand", F.lit(":"), "p_name")).when(
        size % 3 == 1, F.concat(F.lit("SpotDataSource:"), F.col("p_brand"), F.lit(":"), F.col("p_name"))
    ).otherwise(F.col("p_name"))
    asked = table(spark, sf_dir, "part").select(
        "p_partkey", symbol.alias("symbol"), F.lit("1d").alias("timeframe"),
        F.lit(NOW_MS - 3 * _DAY_MS).alias("start_ms"), F.lit(None).cast("bigint").alias("end_ms"),
    )
    checked = requests.validate_requests(asked, NOW_MS, venues=["Binance", "Brand#1", "BRAND#2", "Brand#12", "Brand#23"])
    return checked.select("p_partkey", "valid", "reason")


REQUEST_VENUES_SQL = """
WITH v AS (
  SELECT p_partkey, CASE WHEN p_size % 3 = 2 THEN 'binance' ELSE lower(p_brand) END
    IN ('binance', 'brand#1', 'brand#2', 'brand#12', 'brand#23') AS valid FROM part
)
SELECT *, CASE WHEN valid THEN '' ELSE 'venue not supported' END AS reason FROM v
"""


# -- documents and files by their ranges -------------------------------------------
_RECORD = T.StructType(
    [
        T.StructField("time", T.TimestampType()), T.StructField("feed", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _stored_documents(spark, sf_dir):
    rows = event_rows(spark, sf_dir).select("symbol", "time", "seq", "feed", "value")
    made = documents.to_documents(rows, ["symbol"], ["time", "feed", "value"], ["time", "seq"], rows_per_document=5)
    path = work_path(spark, "documents")
    documents.save_documents(made, ["symbol"], path)
    return documents.load_documents(spark, ["symbol"], path)


def json_records_range(spark, sf_dir):
    """Five days in January from the documents that overlap them."""
    rows = documents.read_range(
        _stored_documents(spark, sf_dir), ["symbol"], _RECORD, start="2024-01-10 06:00:00", end="2024-01-15 18:00:00"
    )
    return rows.withColumn("time", naive("time"))


JSON_RANGE_SQL = """
SELECT 'u' || user_id AS symbol, date_trunc('millisecond', ts) AS time, event_type AS feed, value FROM events
WHERE date_trunc('millisecond', ts) BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-15 18:00:00'
"""


def json_records_last(spark, sf_dir):
    """The last seven rows of every series, from its last documents."""
    rows = documents.read_last(_stored_documents(spark, sf_dir), ["symbol"], _RECORD, 7)
    return rows.withColumn("time", naive("time"))


JSON_LAST_SQL = """
SELECT 'u' || user_id AS symbol, date_trunc('millisecond', ts) AS time, event_type AS feed, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 7
"""


def store_feather_range(spark, sf_dir):
    """Events in order of time as Feather files; four days of purchases' values from the batches that hold them."""
    rows = event_rows(spark, sf_dir).select("symbol", "time", "feed", "value").orderBy("time")
    path = work_path(spark, "feather")
    feather.write_feather(rows, path)
    at = datetime.datetime
    found = feather.read_feather(
        spark, path, rows.schema,
        between={"time": (at(2024, 1, 3), at(2024, 1, 7, 12)), "feed": ("purchase", "purchase")},
    )
    return found.withColumn("time", naive("time"))


STORE_FEATHER_RANGE_SQL = """
SELECT 'u' || user_id AS symbol, ts AS time, event_type AS feed, value FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-07 12:00:00' AND event_type = 'purchase'
"""


# -- pages -----------------------------------------------------------------------
_PAGE = T.StructType(
    [
        T.StructField("symbol", T.StringType()), T.StructField("timeframe", T.StringType()),
        T.StructField("page_no", T.LongType()), T.StructField("time", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _landed(spark, sf_dir):
    """Hourly rows by symbol as a venue would hold them, one row an hour, and its paged source."""
    rows = keep_first(hourly(event_rows(spark, sf_dir)), ["symbol", "time"], ["seq"])
    path = work_path(spark, "venue")
    paged.land_history(rows.select("symbol", "time", "value"), path)
    fetch = paged.landed_pages(paths.qualified(spark, path), ["time", "value"])
    return paged.paged_source("venue", _PAGE, fetch)


def _pages(spark, sf_dir, start_ms, end_ms):
    """Pages of 200 bars for every user with events."""
    users = event_rows(spark, sf_dir).select("symbol").distinct()
    plan = users.select(
        "symbol", F.lit("1h").alias("timeframe"), F.lit(start_ms).alias("fetch_start_ms"), F.lit(end_ms).alias("fetch_end_ms")
    )
    return incremental.bar_pages(plan, ["symbol", "timeframe"], 200)


def paged_batch(spark, sf_dir):
    """January fetched page by page, one task a plan file."""
    source, plan = _landed(spark, sf_dir), work_path(spark, "plan")
    paged.write_plan(_pages(spark, sf_dir, _START_MS, NOW_MS), plan)
    # Pages end where the range ends and overlap; of two rows with one key that of the earlier page counts.
    rows = keep_first(paged.read_pages(spark, source, plan), ["symbol", "time"], ["page_no"])
    return rows.select("symbol", naive("time").alias("time"), "value")


_PAGED_SQL = f"""
SELECT 'u' || user_id AS symbol, date_trunc('hour', ts) AS time, arg_min(value, event_id) AS value
FROM events WHERE epoch_ms(date_trunc('hour', ts)) <= {NOW_MS} GROUP BY 1, 2
"""


def paged_stream(spark, sf_dir):
    """The same as a stream: a plan up to January 20th, then one for the rest, each a round."""
    source, plan, base = _landed(spark, sf_dir), work_path(spark, "plan"), work_path(spark, "paged")
    cut = _START_MS + 20 * _DAY_MS
    for start, end in ((_START_MS, cut), (cut + 1, NOW_MS)):
        paged.write_plan(_pages(spark, sf_dir, start, end), plan)
        stream = paged.stream_pages(spark, source, plan)
        # The second start goes on after the first round.
        ingest.to_parquet(stream, f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    rows = spark.read.schema(_PAGE).parquet(f"{base}/rows")
    rows = keep_first(rows, ["symbol", "time"], ["page_no"])
    return rows.select("symbol", naive("time").alias("time"), "value")


# -- streams ---------------------------------------------------------------------
def stream_first_wins(spark, sf_dir):
    """Hourly events landed in two files, the later arrivals in the file that is read first."""
    rows = hourly(event_rows(spark, sf_dir)).select("symbol", "time", "feed", "seq", "value")
    folder = work_path(spark, "landed")
    # Even event numbers land after odd ones; either file alone has another first row for many keys.
    for i, odd in enumerate((True, False)):
        rows.filter((F.col("seq") % 2 == 1) == F.lit(odd)).write.parquet(f"{folder}/{i}")
    stream = ingest.landing_stream(spark, f"{folder}/*", rows.schema, files_per_batch=1)
    first = ingest.first_wins(stream, ["symbol", "time", "feed"], ["seq"], "60 days")
    # One more row far ahead closes every key of the events.
    ahead = rows.limit(1).withColumn("time", F.lit("2025-01-01").cast("timestamp"))
    ahead.write.parquet(f"{folder}/2")
    base = work_path(spark, "first")
    ingest.to_parquet(first, f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    out = spark.read.schema(first.schema).parquet(f"{base}/rows")
    return out.withColumn("time", naive("time"))


STREAM_FIRST_WINS_SQL = """
SELECT 'u' || user_id AS symbol, date_trunc('hour', ts) AS time, event_type AS feed,
  min(event_id) AS seq, arg_min(value, event_id) AS value
FROM events GROUP BY ALL
"""


def stream_late_rows(spark, sf_dir):
    """Daily bars of a feed whose first half comes a second time, with other values, after its bars were closed."""
    rows = event_rows(spark, sf_dir).select("symbol", "time", "feed", "seq", "value")
    folder = work_path(spark, "landed")
    late = rows.filter(F.col("time") < F.lit("2024-01-15").cast("timestamp")).withColumn("value", F.col("value") * 1000)
    one = rows.limit(1)
    ahead = [one.withColumn("time", F.lit(f"2025-01-01 {hour}:00:00").cast("timestamp")) for hour in ("01", "02")]
    # Rows are late for a batch by the watermark that the batch before it started with.
    for i, own in enumerate((rows, *ahead, late)):
        own.coalesce(1).write.parquet(f"{folder}/{i}")
    base = work_path(spark, "late")
    stream = ingest.landing_stream(spark, f"{folder}/*", rows.schema, files_per_batch=1)
    bars = ingest.closed_bars(stream, ["symbol"], "1d", "1 hour")
    ingest.to_parquet(bars, f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    out = rounded_volume(spark.read.schema(bars.schema).parquet(f"{base}/rows"))
    return out.withColumn("time", naive("time"))


STREAM_LATE_SQL = f"WITH {EV_SQL}, {bars_sql('bars', ONE_DAY)} SELECT * FROM bars"

QUERIES = {
    "store_index": (store_index, STORE_INDEX_SQL),
    "store_marks": (store_marks, STORE_MARKS_SQL),
    "store_tail_pooled": (store_tail_pooled, STORE_TAIL_POOLED_SQL),
    "coverage_union": (coverage_union, COVERAGE_UNION_SQL),
    "fetch_segments": (fetch_segments, FETCH_SEGMENTS_SQL),
    "incremental_run": (incremental_run, INCREMENTAL_RUN_SQL),
    "run_set_aside": (run_set_aside, RUN_SET_ASIDE_SQL),
    "own_store": (own_store, OWN_STORE_SQL),
    "own_store_listed": (own_store_listed, OWN_STORE_LISTED_SQL),
    "paged_batch": (paged_batch, _PAGED_SQL),
    "paged_stream": (paged_stream, _PAGED_SQL),
    "json_records_range": (json_records_range, JSON_RANGE_SQL),
    "json_records_last": (json_records_last, JSON_LAST_SQL),
    "store_feather_range": (store_feather_range, STORE_FEATHER_RANGE_SQL),
    "request_venues": (request_venues, REQUEST_VENUES_SQL),
    "stream_late_rows": (stream_late_rows, STREAM_LATE_SQL),
    "stream_first_wins": (stream_first_wins, STREAM_FIRST_WINS_SQL),
}
