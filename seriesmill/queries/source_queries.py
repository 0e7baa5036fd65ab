"""Sources, stores, catalog, names, membership, run log and streams.

Queries about files first land what they read: Spark derives the files from
the given tables and writes them below the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.functions import names
from seriesmill.operators import audit, membership
from seriesmill.operators.dedupe import keep_first, keep_last
from seriesmill.queries.inputs import (
    FEEDS,
    as_table,
    event_bars,
    event_rows,
    hourly,
    prop_k,
    rounded_volume,
    table,
)
from seriesmill.queries.series_queries import (
    BAR,
    EV_SQL,
    FOUR_HOURS,
    HOURLY_SQL,
    ONE_DAY,
    UPSERT_MERGE_SQL,
    bars_sql,
)
from seriesmill.queries.time_queries import size_sql
from seriesmill.schemas import OHLCV, columns, naive, utc
from seriesmill.session import work_path
from seriesmill.sources import documents, files, landed, registry, store
from seriesmill.streaming import ingest

VALUES = columns(
    time=OHLCV["time"].dataType, value=OHLCV["open"].dataType
)
_ROWS = "symbol, time, value"


def _bar_rows(df):
    return df.select("symbol", naive("time").alias("time"), *BAR)


# -- landed sources ----------------------------------------------------------
def src_ohlcv_from_arrays(spark, sf_dir):
    """Bars landed as pages, one JSON line per symbol and day, and read back."""
    bars = event_bars(spark, sf_dir, "4h").select(
        "symbol",
        F.date_trunc("day", "time").alias("day"),
        F.array(F.unix_millis("time").cast("double"), *BAR).alias("bar"),
    )
    # At most six bars of four hours per symbol and day.
    pages = bars.groupBy("symbol", "day").agg(F.sort_array(F.collect_list("bar")).alias("data"))
    path = work_path(spark, "spot")
    pages.select("symbol", F.lit("4h").alias("timeframe"), "data").write.json(path)
    return _bar_rows(registry.read_source(spark, "spot", path))


BARS_4H_SQL = f"WITH {EV_SQL}, {bars_sql('bars', FOUR_HOURS)} SELECT * FROM bars"
BARS_1D_SQL = f"WITH {EV_SQL}, {bars_sql('bars', ONE_DAY)} SELECT * FROM bars"


def market_normalize(spark, sf_dir):
    """Daily bars landed as CSV with a header in mixed case."""
    path = work_path(spark, "market")
    event_bars(spark, sf_dir, "1d").select(
        F.col("symbol").alias("Symbol "),
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("Date"),
        *[F.col(c).alias(f" {c.title()}") for c in BAR],
    ).write.csv(path, header=True)
    return _bar_rows(registry.read_source(spark, "market", path))


def src_derivatives_feeds(spark, sf_dir):
    """Six feeds landed as overlapping JSON pages of texts, read, aligned and filled."""
    path = work_path(spark, "feeds")
    rows = hourly(event_rows(spark, sf_dir))
    firsts = keep_first(rows, ["symbol", "time", "feed"], ["seq"])
    lasts = keep_last(rows, ["symbol", "time", "feed"], ["seq"])
    wire = landed.DERIVATIVES_FEEDS
    # Two pages a feed: the second overlaps the first from the 10th on, with other values.
    pages = [("page-1", firsts), ("page-2", lasts.filter("time >= '2024-01-10'"))]
    for page, part in pages:
        for feed, event_type in zip(list(wire)[:5], FEEDS, strict=True):
            value, time, _ = wire[feed]
            part.filter(F.col("feed") == event_type).select(
                "symbol",
                F.col("value").cast("string").alias(value),
                F.unix_millis("time").cast("string").alias(time),
            ).write.json(f"{path}/{feed}/{page}")
        # Funding comes with a fraction of a second that is dropped on reading.
        value, time, _ = wire["funding"]
        part.filter(F.col("feed") == "purchase").select(
            "symbol",
            prop_k().alias(value),
            (F.unix_millis("time") + F.lit(417)).cast("string").alias(time),
        ).write.json(f"{path}/funding/{page}")
    read = registry.read_source(spark, "derivatives", path, timeframe="1h")
    return read.withColumn("time", naive("time")).drop("timeframe")


_FEED_COLUMNS = [c for _, _, c in landed.DERIVATIVES_FEEDS.values()]
DERIVATIVES_SQL = (
    f"WITH {EV_SQL}, d AS (SELECT symbol, date_trunc('hour', time) AS time, feed, value, props "
    "FROM ev QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('hour', time), feed "
    "ORDER BY CASE WHEN time >= TIMESTAMP '2024-01-10' THEN -seq ELSE seq END) = 1), wide AS (SELECT symbol, time, "
    + ", ".join(
        f"max(value) FILTER (WHERE feed = '{e}') AS {c}"
        for e, c in zip(FEEDS, _FEED_COLUMNS[:5], strict=True)
    )
    + ", max(CAST(props->>'$.k' AS DOUBLE)) FILTER (WHERE feed = 'purchase') AS funding_rate "
    "FROM d GROUP BY symbol, time) SELECT symbol, time, "
    + ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER past, "
        f"first_value({c} IGNORE NULLS) OVER ahead) AS {c}"
        for c in _FEED_COLUMNS
    )
    + " FROM wide WINDOW past AS (PARTITION BY symbol ORDER BY time ROWS BETWEEN UNBOUNDED "
    "PRECEDING AND CURRENT ROW), ahead AS (PARTITION BY symbol ORDER BY time ROWS BETWEEN "
    "CURRENT ROW AND UNBOUNDED FOLLOWING)"
)


def macro_central_to_utc(spark, sf_dir):
    """Orders as daily observations, landed as JSON and read through the macro source."""
    path = work_path(spark, "macro")
    table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("symbol"),
        F.date_format(utc("o_orderdate"), "yyyy-MM-dd").alias("date"),
        F.col("o_totalprice").alias("value"),
    ).write.json(path)
    return registry.read_source(spark, "macro", path).select(
        "symbol",
        naive("time").alias("time"),
        landed.central_day(F.col("time")).alias("day"),
        "volume",
    )


MACRO_SQL = """
SELECT o_orderkey::VARCHAR AS symbol,
  make_timestamp_ms(epoch_ms(timezone('US/Central', o_orderdate))) AS time,
  strftime(o_orderdate, '%Y-%m-%d') AS day, o_totalprice AS volume
FROM orders
"""


def macro_range(spark, sf_dir):
    """The same source cut to a range given in UTC and applied in whole Central days."""
    path = work_path(spark, "macro")
    table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("symbol"),
        F.date_format(utc("o_orderdate"), "yyyy-MM-dd").alias("date"),
        F.col("o_totalprice").alias("value"),
    ).write.json(path)
    # 1997-07-01T03:00Z is still June 30th in the publisher's zone.
    cut = landed.read_macro(spark, path, start_ms=867726000000, end_ms=899262000000)
    return cut.select("symbol", naive("time").alias("time"), "volume")


MACRO_RANGE_SQL = """
SELECT o_orderkey::VARCHAR AS symbol,
  make_timestamp_ms(epoch_ms(timezone('US/Central', o_orderdate))) AS time,
  o_totalprice AS volume
FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-06-30' AND TIMESTAMP '1998-06-30'
"""


def fgi_shift_day(spark, sf_dir):
    """Events as index records in JSON payloads, read through the sentiment source."""
    path = work_path(spark, "sentiment")
    record = F.struct(
        prop_k().alias("value"),
        F.col("feed").alias("value_classification"),
        F.unix_seconds("time").cast("string").alias("timestamp"),
        F.lit("66568").alias("time_until_update"),
    )
    event_rows(spark, sf_dir).select(F.array(record).alias("data")).write.json(path)
    rows = registry.read_source(spark, "sentiment", path)
    return rows.withColumn("time", naive("time")).select(
        "symbol", "time", "value", "value_classification", "value_int"
    )


FGI_SQL = """
SELECT 'bitcoin_fgi' AS symbol, date_trunc('second', ts) - INTERVAL 1 DAY AS time,
  props->>'$.k' AS value, event_type AS value_classification,
  CAST(props->>'$.k' AS INTEGER) AS value_int FROM events
"""


def json_map_explode(spark, sf_dir):
    """Ticker payloads keyed by name: one object per bar with an entry per price."""
    entries = []
    for name in BAR[:4]:
        entries += [F.lit(name), F.struct(F.col(name).alias("last"), F.lit("USD").alias("unit"))]
    payloads = event_bars(spark, sf_dir, "1d").select(
        "symbol", "time", F.to_json(F.create_map(*entries)).alias("payload")
    )
    return payloads.select(
        "symbol",
        naive("time").alias("time"),
        *landed.explode_keyed(F.col("payload"), "last: double, unit: string", key="id"),
    ).select("symbol", "time", "id", "entry.last", "entry.unit")


JSON_MAP_SQL = f"""
WITH {EV_SQL}, {bars_sql('bars', ONE_DAY)}
SELECT symbol, time, id, last, 'USD' AS unit
FROM bars UNPIVOT (last FOR id IN (open, high, low, close))
"""


def json_doc_extract(spark, sf_dir):
    """A nested summary document per bar, with some of its values taken out by path."""
    quote = F.struct(
        F.col("close").alias("total_market_cap"), F.col("volume").alias("total_volume_24h")
    )
    doc = F.to_json(
        F.struct(
            F.struct(
                F.struct(quote.alias("USD")).alias("quotes"),
                F.unix_seconds("time").alias("last_updated"),
            ).alias("data"),
            F.col("symbol").alias("name"),
        )
    )
    paths = {
        "market_cap": ("$.data.quotes.USD.total_market_cap", "double"),
        "volume_24h": ("$.data.quotes.USD.total_volume_24h", "double"),
        "last_updated": ("$.data.last_updated", "bigint"),
        "absent": ("$.data.quotes.EUR", "string"),
    }
    return event_bars(spark, sf_dir, "1d").select(
        "symbol", *landed.extract_paths(doc, paths)
    )


JSON_DOC_SQL = f"""
WITH {EV_SQL}, {bars_sql('bars', ONE_DAY)}
SELECT symbol, close AS market_cap, volume AS volume_24h,
  epoch_us(time) // 1000000 AS last_updated, NULL::VARCHAR AS absent FROM bars
"""


def load_coerce(spark, sf_dir):
    """Parquet with a timestamp column and whole-number values, coerced on load."""
    path = work_path(spark, "coerce")
    event_rows(spark, sf_dir).select(
        "symbol", F.col("time").alias("timestamp"), prop_k().cast("bigint").alias("value")
    ).write.parquet(path)
    return landed.coerce_loaded(spark.read.parquet(path))


LOAD_COERCE_SQL = f"""
WITH {EV_SQL} SELECT symbol, ms AS timestamp, CAST(props->>'$.k' AS DOUBLE) AS value FROM ev
"""


# -- documents ---------------------------------------------------------------
def _documents(spark, sf_dir):
    rows = event_rows(spark, sf_dir).select("symbol", "time", "seq", "feed", "value")
    return documents.to_documents(
        rows, ["symbol"], ["time", "feed", "value"], ["time", "seq"], rows_per_document=50
    )


def json_records_export(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "symbol",
        "doc_no",
        "payload",
        "n_rows",
        naive("first_time").alias("first_time"),
        naive("last_time").alias("last_time"),
    )


JSON_EXPORT_SQL = f"""
WITH {EV_SQL}, n AS (
  SELECT *, (row_number() OVER (PARTITION BY symbol ORDER BY time, seq) - 1) // 50 AS doc_no
  FROM ev
)
SELECT symbol, doc_no, '[' || string_agg(
    '{{"time":"' || strftime(date_trunc('millisecond', time), '%Y-%m-%dT%H:%M:%S.%g')
    || 'Z","feed":"' || feed || '","value":' || value::VARCHAR || '}}', ',' ORDER BY time, seq
  ) || ']' AS payload,
  count(*) AS n_rows, min(time) AS first_time, max(time) AS last_time
FROM n GROUP BY symbol, doc_no
"""


def json_records_cut(spark, sf_dir):
    """The same documents where every series is cut into pieces: numbers run through."""
    rows = event_rows(spark, sf_dir).select("symbol", "time", "seq", "feed", "value")
    made = documents.to_documents(
        rows, ["symbol"], ["time", "feed", "value"], ["time", "seq"], rows_per_document=50, rows_per_task=20
    )
    return made.withColumn("first_time", naive("first_time")).withColumn("last_time", naive("last_time"))


def json_records_inline(spark, sf_dir):
    payload = columns(
        time=OHLCV["time"].dataType, feed=table(spark, sf_dir, "events").schema["props"].dataType,
        value=OHLCV["open"].dataType,
    )
    rows = documents.from_documents(_documents(spark, sf_dir), ["symbol"], payload)
    return rows.withColumn("time", naive("time"))


JSON_INLINE_SQL = f"""
WITH {EV_SQL} SELECT symbol, date_trunc('millisecond', time) AS time, feed, value FROM ev
"""


# -- stores ------------------------------------------------------------------
def _unique_rows(spark, sf_dir):
    """Hourly series rows, unique by (symbol, time), with the keys of the series table."""
    rows = keep_first(hourly(event_rows(spark, sf_dir)), ["symbol", "time"], ["seq"])
    return as_table(rows.select("symbol", "time", "value"), "events", "1h").select(
        "source", "symbol", "timeframe", "time", "value"
    )


def _first_hour_sql(where: str = "TRUE", shown: str = _ROWS) -> str:
    return (
        f"WITH {HOURLY_SQL} SELECT {shown} FROM (SELECT * FROM h QUALIFY row_number() OVER "
        f"(PARTITION BY symbol, time ORDER BY seq) = 1) WHERE {where}"
    )


def _table(spark, sf_dir, label):
    made = store.SeriesTable(spark, work_path(spark, label), VALUES)
    made.append(_unique_rows(spark, sf_dir))
    return made


def _table_rows(df):
    return df.select("symbol", naive("time").alias("time"), "value")


def store_parquet_roundtrip(spark, sf_dir):
    return _table_rows(_table(spark, sf_dir, "series").read())


def _file_roundtrip(fmt):
    def query(spark, sf_dir):
        rows = event_rows(spark, sf_dir).select("symbol", "time", "value")
        kind = registry.get_store(fmt)
        path = work_path(spark, fmt)
        kind.write(rows, path)
        return _table_rows(kind.read(spark, path, rows.schema))

    return query


ROWS_SQL = f"WITH {EV_SQL} SELECT symbol, time, value FROM ev"
ROWS_MS_SQL = (
    f"WITH {EV_SQL} SELECT symbol, date_trunc('millisecond', time) AS time, value FROM ev"
)


def store_old_times(spark, sf_dir):
    """Orders forty years earlier, from 1952 on, through all four file formats."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("symbol"),
        F.timestamp_millis(F.unix_millis(utc("o_orderdate")) - F.lit(14610 * 86_400_000)).alias("time"),
        F.col("o_totalprice").alias("value"),
    )
    every = []
    for fmt in files.EXTENSIONS:
        path = work_path(spark, fmt)
        files.save_files(rows, path, fmt)
        every.append(files.load_files(spark, path, rows.schema, fmt).withColumn("fmt", F.lit(fmt)))
    both = reduce(DataFrame.unionByName, every)
    return both.withColumn("time", naive("time"))


STORE_OLD_SQL = """
SELECT o_orderkey::VARCHAR AS symbol, o_orderdate - INTERVAL 14610 DAY AS time, o_totalprice AS value, fmt
FROM orders CROSS JOIN (VALUES ('feather'), ('parquet'), ('json'), ('jsongz')) AS f(fmt)
"""


def files_listed(spark, sf_dir):
    """Bars saved as datasets, one of them partitioned, in two folders; what a listing finds."""
    path = work_path(spark, "datasets")
    bars = event_bars(spark, sf_dir, "1d").withColumn("half", F.expr("day(time) <= 15"))
    files.save_files(bars, f"{path}/spot/all_1d.parquet", "parquet", partition_by=["half"])
    files.save_files(bars.filter("half"), f"{path}/spot/first_1d.parquet", "parquet")
    files.save_files(bars.filter("not half"), f"{path}/last_1d.parquet", "parquet")
    listed = files.list_files(spark, path, "parquet")
    return listed.select("id", "sub", (F.col("size_bytes") > 0).alias("filled"))


FILES_LISTED_SQL = f"""
WITH {EV_SQL}, d(id, sub, early) AS (
  VALUES ('all_1d', 'spot', NULL), ('first_1d', 'spot', TRUE), ('last_1d', NULL, FALSE)
)
SELECT id, sub, TRUE AS filled FROM d
WHERE EXISTS (SELECT 1 FROM ev WHERE early IS NULL OR (day(time) <= 15) = early)
"""


def store_tail(spark, sf_dir):
    """The last 30 rows of a series, from the newest months of the table."""
    return _table_rows(_table(spark, sf_dir, "series").tail(30, source="events", symbol="u7", timeframe="1h"))


STORE_TAIL_SQL = _first_hour_sql("symbol = 'u7'") + " ORDER BY time DESC LIMIT 30"


def store_missing_dataset(spark, sf_dir):
    """Events and a dataset that is not there: the latter gives no rows, and no error."""
    rows = event_rows(spark, sf_dir).select("symbol", "time", "value")
    none = [files.load_files(spark, work_path(spark, "none"), rows.schema, f) for f in files.EXTENSIONS]
    absent = store.SeriesTable(spark, work_path(spark, "none"), VALUES).read().select("symbol", "time", "value")
    return _table_rows(reduce(DataFrame.unionByName, [rows, absent, *none]))


def store_load_series(spark, sf_dir):
    """Two series of the table, within a range that prunes partitions."""
    part = _table(spark, sf_dir, "series").read(
        source="events", timeframe="1h", symbols=["u7", "u46"],
        start="2024-01-05 00:00:00", end="2024-01-25 00:00:00",
    )
    return _table_rows(part)


STORE_LOAD_SQL = _first_hour_sql(
    "symbol IN ('u7', 'u46') AND time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'"
)


def store_upsert(spark, sf_dir):
    """Rows before January 20th stored, then everything from the 15th on upserted."""
    rows = event_rows(spark, sf_dir).select("symbol", "time", "seq", "value")
    keyed = as_table(rows, "events", "1h")
    early = hourly(keyed.filter(F.col("time") < F.lit("2024-01-20").cast("timestamp")))
    late = hourly(keyed.filter(F.col("time") >= F.lit("2024-01-15").cast("timestamp")))
    made = store.SeriesTable(spark, work_path(spark, "series"), VALUES)
    made.upsert(early, ["seq"])
    made.upsert(late, ["seq"])
    return _table_rows(made.read())


STORE_UPSERT_SQL = f"SELECT symbol, time, value FROM ({UPSERT_MERGE_SQL})"


def _building(spark, sf_dir):
    """Series of the customers of one market segment."""
    return as_table(
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "BUILDING")
        .select(F.concat(F.lit("u"), F.col("c_custkey")).alias("symbol")),
        "events",
        "1h",
    ).select("source", "symbol", "timeframe")


_BUILDING_SQL = (
    "SELECT 'u' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'"
)


def store_delete_series(spark, sf_dir):
    made = _table(spark, sf_dir, "series")
    made.delete(_building(spark, sf_dir))
    return _table_rows(made.read())


STORE_DELETE_SQL = _first_hour_sql(f"symbol NOT IN ({_BUILDING_SQL})")


def store_delete_report(spark, sf_dir):
    """Every customer is asked for; those without events were missing."""
    made = _table(spark, sf_dir, "series")
    customers = table(spark, sf_dir, "customer").select(F.concat(F.lit("u"), F.col("c_custkey")).alias("symbol"))
    return made.delete(as_table(customers, "events", "1h")).select("symbol", "deleted")


STORE_DELETE_REPORT_SQL = """
SELECT 'u' || c_custkey AS symbol, c_custkey IN (SELECT user_id FROM events) AS deleted FROM customer
"""


def store_replace(spark, sf_dir):
    """The series of one market segment stored anew with doubled values."""
    made = _table(spark, sf_dir, "series")
    doubled = made.read().join(_building(spark, sf_dir), ["source", "symbol", "timeframe"])
    made.replace(doubled.withColumn("value", F.col("value") * 2))
    return _table_rows(made.read())


STORE_REPLACE_SQL = _first_hour_sql(
    shown=f"symbol, time, CASE WHEN symbol IN ({_BUILDING_SQL}) THEN value * 2 ELSE value END "
    "AS value"
)


def store_compact(spark, sf_dir):
    """Every row appended twice, then compacted to one row per key."""
    made = _table(spark, sf_dir, "series")
    made.append(_unique_rows(spark, sf_dir))
    made.compact(source="events", timeframe="1h", month="2024-01")
    return _table_rows(made.read())


def store_exists(spark, sf_dir):
    """Every customer is asked for, through the table."""
    wanted = as_table(
        table(spark, sf_dir, "customer").select(F.concat(F.lit("u"), F.col("c_custkey")).alias("symbol")),
        "events",
        "1h",
    ).select("source", "symbol", "timeframe")
    return _table(spark, sf_dir, "series").exists(wanted).select("symbol", "present")


STORE_EXISTS_SQL = """
SELECT 'u' || c_custkey AS symbol, 'u' || c_custkey IN (SELECT 'u' || user_id FROM events) AS present
FROM customer
"""


# -- catalog -----------------------------------------------------------------
def series_time_range(spark, sf_dir):
    ranges = store.time_ranges(event_rows(spark, sf_dir), ["symbol"])
    return ranges.select(
        "symbol", naive("start_time").alias("start_time"), naive("end_time").alias("end_time")
    )


TIME_RANGE_SQL = f"""
WITH {EV_SQL} SELECT symbol, min(time) AS start_time, max(time) AS end_time
FROM ev GROUP BY symbol
"""


def catalog_list(spark, sf_dir):
    rows = as_table(event_rows(spark, sf_dir), "spot.v2", "1h").select(
        "source", "symbol", "timeframe", "time", "feed", "value"
    )
    listed = store.catalog(rows)
    return (
        listed.withColumn("start_time", naive("start_time"))
        .withColumn("end_time", naive("end_time"))
        .withColumn("column_count", F.col("column_count").cast("bigint"))
    )


CATALOG_SQL = f"""
WITH {EV_SQL}, c AS (
  SELECT symbol, count(*) AS row_count,
    sum(length('{{"time":' || ms || ',"feed":"' || feed || '","value":' || value || '}}'))::BIGINT
      AS size_bytes, min(time) AS start_time, max(time) AS end_time
  FROM ev GROUP BY symbol
)
SELECT symbol || '_1h' AS id, 'spot.v2' AS sub, 'spot_v2_' || symbol || '_1h' AS table_name,
  3::BIGINT AS column_count, row_count, size_bytes, {size_sql('size_bytes')} AS size,
  start_time, end_time FROM c
"""


def data_info_report(spark, sf_dir):
    """Every customer is asked for; those without events have no dataset."""
    wanted = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey")).alias("symbol"), F.lit("1h").alias("timeframe")
    )
    ranges = store.time_ranges(event_rows(spark, sf_dir), ["symbol"])
    return store.info_report(wanted, ranges, ["symbol"])


DATA_INFO_SQL = f"""
WITH {EV_SQL}, r AS (SELECT symbol, min(time) AS a, max(time) AS z FROM ev GROUP BY symbol)
SELECT 'u' || c_custkey || '_1h' AS data_name, 'u' || c_custkey AS symbol, '1h' AS timeframe,
  coalesce(strftime(a, '%Y-%m-%d %H:%M:%S'), '无法获取') AS start_time,
  coalesce(strftime(z, '%Y-%m-%d %H:%M:%S'), '无法获取') AS end_time
FROM customer LEFT JOIN r ON r.symbol = 'u' || c_custkey
"""


# -- names -------------------------------------------------------------------
def _instruments(spark, sf_dir):
    """Parts as instrument names of every form, and some that are no instrument."""
    base = F.upper(F.substring_index("p_name", " ", 1))
    quote = F.upper(F.substring_index("p_name", " ", -1))
    pair = F.concat(base, F.lit("/"), quote)
    size = F.col("p_size")
    form = (
        F.when(size <= 10, pair)
        .when(size <= 20, F.concat(pair, F.lit(":"), quote))
        .when(size <= 30, F.concat(pair, F.lit(":"), base, F.lit("-"), size + 211200))
        .when(
            size <= 40,
            F.concat(
                pair, F.lit(":"), base, F.lit("-211225-"), F.col("p_retailprice").cast("int"),
                F.lit("-P"),
            ),
        )
        .when(size <= 43, base)
        .when(size <= 46, F.concat(pair, F.lit(":A:B")))
        .otherwise(F.concat(pair, F.lit("/X")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", form.alias("symbol"))


_INSTRUMENT_SQL = """
p AS (
  SELECT p_partkey, p_size, upper(split_part(p_name, ' ', 1)) AS b,
    upper(split_part(p_name, ' ', -1)) AS q, CAST(trunc(p_retailprice) AS INT) AS strike FROM part
), s AS (
  SELECT *, CASE WHEN p_size <= 10 THEN b || '/' || q
    WHEN p_size <= 20 THEN b || '/' || q || ':' || q
    WHEN p_size <= 30 THEN b || '/' || q || ':' || b || '-' || (p_size + 211200)
    WHEN p_size <= 40 THEN b || '/' || q || ':' || b || '-211225-' || strike || '-P'
    WHEN p_size <= 43 THEN b
    WHEN p_size <= 46 THEN b || '/' || q || ':A:B'
    ELSE b || '/' || q || '/X' END AS symbol FROM p
)"""


def instrument_dim(spark, sf_dir):
    """Distinct symbols as an instrument dimension; malformed ones are marked."""
    symbols = _instruments(spark, sf_dir).select("symbol").distinct()
    parsed = symbols.withColumn("i", names.parse_instrument(F.col("symbol")))
    fields = ["unified", "base", "quote", "settlement", "identifier", "strike", "option_type"]
    return parsed.select(
        "symbol",
        F.col("i").isNotNull().alias("is_valid"),
        *[F.col(f"i.{f}").alias(f) for f in fields],
    )


INSTRUMENT_DIM_SQL = f"""
WITH {_INSTRUMENT_SQL}
SELECT DISTINCT symbol, p_size <= 40 AS is_valid,
  CASE WHEN p_size <= 40 THEN b || '/' || q END AS unified,
  CASE WHEN p_size <= 40 THEN b END AS base, CASE WHEN p_size <= 40 THEN q END AS quote,
  CASE WHEN p_size <= 10 THEN '' WHEN p_size <= 20 THEN q WHEN p_size <= 40 THEN b END
    AS settlement,
  CASE WHEN p_size <= 20 THEN '' WHEN p_size <= 30 THEN (p_size + 211200)::VARCHAR
    WHEN p_size <= 40 THEN '211225' END AS identifier,
  CASE WHEN p_size <= 30 THEN '' WHEN p_size <= 40 THEN strike::VARCHAR END AS strike,
  CASE WHEN p_size <= 30 THEN '' WHEN p_size <= 40 THEN 'P' END AS option_type
FROM s
"""


def symbol_route(spark, sf_dir):
    """Instruments with a venue, with a data source and a venue, or with neither."""
    rows = _instruments(spark, sf_dir).join(
        table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type"), "p_partkey"
    )
    text = (
        F.when(F.col("p_type") == "ECONOMY", F.concat("p_brand", F.lit(":"), "symbol"))
        .when(
            F.col("p_type") == "SMALL", F.concat(F.lit("MyDataSource:"), F.col("symbol"))
        )
        .otherwise(F.col("symbol"))
    )
    route = names.route_symbol(F.col("text"))
    return (
        rows.select("p_partkey", text.alias("text"))
        .withColumn("r", route)
        .select("p_partkey", "text", F.col("r.venue").alias("venue"),
                F.col("r.symbol").alias("symbol"))
    )


SYMBOL_ROUTE_SQL = f"""
WITH {_INSTRUMENT_SQL}, t AS (
  SELECT s.p_partkey, CASE p_type WHEN 'ECONOMY' THEN p_brand || ':' || symbol
    WHEN 'SMALL' THEN 'MyDataSource:' || symbol ELSE symbol END AS text
  FROM s JOIN part ON part.p_partkey = s.p_partkey
), c AS (SELECT *, string_split(text, ':') AS x FROM t)
SELECT p_partkey, text,
  CASE WHEN len(x) = 3 THEN lower(x[2])
    WHEN len(x) = 2 AND NOT contains(lower(x[1]), 'datasource') THEN lower(x[1])
    ELSE 'binance' END AS venue,
  CASE WHEN len(x) = 3 THEN x[3] WHEN len(x) = 2 THEN x[2] ELSE text END AS symbol
FROM c
"""


def name_normalize(spark, sf_dir):
    symbols = _instruments(spark, sf_dir)
    dataset = names.dataset_id(F.col("symbol"), F.lit("1d"))
    numbered = F.concat(F.col("p_partkey"), F.lit("^"), dataset)
    return symbols.select(
        "p_partkey",
        names.file_name(dataset).alias("file_name"),
        names.table_name(dataset).alias("table_name"),
        names.table_name(numbered).alias("numbered_name"),
        names.table_name(dataset, F.lit("Spot/v.2")).alias("prefixed_name"),
        names.key_name(dataset, F.lit("Spot/v.2")).alias("key_name"),
    )


_TABLE_NAME = "lower(regexp_replace({x}, '[-/.=:^]', '_', 'g'))"
NAME_NORMALIZE_SQL = f"""
WITH {_INSTRUMENT_SQL}, d AS (SELECT p_partkey, symbol || '_1d' AS id FROM s)
SELECT p_partkey, replace(id, '/', '_') AS file_name,
  {_TABLE_NAME.format(x='id')} AS table_name,
  'tbl_' || {_TABLE_NAME.format(x="p_partkey || '^' || id")} AS numbered_name,
  'spot_v_2_' || {_TABLE_NAME.format(x='id')} AS prefixed_name,
  'Spot_v_2:' || regexp_replace(id, '[-/.]', '_', 'g') AS key_name
FROM d
"""


def name_collisions(spark, sf_dir):
    """Instruments whose table names fall together; quote and settlement swap places."""
    symbols = _instruments(spark, sf_dir).select("symbol").distinct()
    variants = symbols.select(
        F.explode(
            F.array(F.col("symbol"), F.translate("symbol", "/", "-"), F.lower("symbol"))
        ).alias("dataset")
    )
    named = variants.withColumn("table_name", names.table_name(F.col("dataset")))
    return membership.name_collisions(named, "table_name").select(
        "table_name", "dataset", "n_datasets"
    )


NAME_COLLISIONS_SQL = f"""
WITH {_INSTRUMENT_SQL}, v AS (
  SELECT DISTINCT unnest([symbol, replace(symbol, '/', '-'), lower(symbol)]) AS dataset FROM s
), n AS (SELECT dataset, {_TABLE_NAME.format(x='dataset')} AS table_name FROM v)
SELECT table_name, dataset, count(*) OVER (PARTITION BY table_name) AS n_datasets
FROM n QUALIFY n_datasets > 1
"""


# -- membership --------------------------------------------------------------
def _universe(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    ).select(F.concat(F.lit("u/"), F.col("c_custkey")).alias("symbol"))


_UNIVERSE_SQL = (
    "SELECT 'u' || c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')"
)


def universe_semi(spark, sf_dir):
    rows = event_rows(spark, sf_dir).select("symbol", F.col("seq").alias("event_id"), "value")
    return membership.supported(rows, _universe(spark, sf_dir))


def universe_anti(spark, sf_dir):
    rows = event_rows(spark, sf_dir).select("symbol", F.col("seq").alias("event_id"), "value")
    return membership.rejected(rows, _universe(spark, sf_dir))


def _universe_sql(negate: str) -> str:
    return (
        f"WITH {EV_SQL} SELECT symbol, seq AS event_id, value FROM ev "
        f"WHERE symbol {negate} IN ({_UNIVERSE_SQL})"
    )


def catalogue_join(spark, sf_dir):
    """Series with the nation and region of their customer as catalogue columns."""
    customers = table(spark, sf_dir, "customer")
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    catalogue = customers.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("u"), F.col("c_custkey")).alias("symbol"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
    )
    rows = event_rows(spark, sf_dir).select("symbol", F.col("seq").alias("event_id"))
    return membership.describe(rows, catalogue, ["symbol"])


CATALOGUE_SQL = f"""
WITH {EV_SQL}
SELECT symbol, seq AS event_id, c_name AS name, n_name AS nation, r_name AS region
FROM ev LEFT JOIN customer ON symbol = 'u' || c_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
"""


def macro_catalogue_join(spark, sf_dir):
    """Orders as observations of the macro series, each with its catalogue entry."""
    catalogue = membership.macro_catalogue(spark).select("id", "key", "freq", "name")
    numbered = table(spark, sf_dir, "orders").select(
        F.element_at(F.array(F.lit("IORB"), F.lit("EFFR"), F.lit("NONE")), F.expr("int(o_orderkey % 3) + 1")).alias("id"),
        "o_orderkey",
    )
    return membership.describe(numbered, catalogue, ["id"]).select(
        "o_orderkey", "id", "key", "freq", "name"
    )


MACRO_CATALOGUE_SQL = """
SELECT o_orderkey, id, key, freq, name FROM (
  SELECT o_orderkey, ['IORB', 'EFFR', 'NONE'][(o_orderkey % 3 + 1)::INT] AS id FROM orders
) LEFT JOIN (VALUES
  ('IORB', 'IORB', 'Daily', 'Interest Rate Overnight Reverse Repurchase Agreements'),
  ('EFFR', 'EFFR', 'Daily', 'Federal Funds Effective Rate')
) AS c(id, key, freq, name) USING (id)
"""


# -- run log -----------------------------------------------------------------
def _runs(spark, sf_dir):
    """Events as a run log: one task per user, the event type stands for the status."""
    status = (
        F.when(F.col("feed") == "view", "running")
        .when(F.col("feed") == "error", "failed")
        .when(F.col("feed") == "signup", "created")
        .otherwise("completed")
    )
    return event_rows(spark, sf_dir).select(
        F.col("symbol").alias("task"),
        "time",
        "seq",
        status.alias("status"),
        F.when(F.col("feed") == "error", F.col("props")).alias("error"),
    )


_RUNS_SQL = f"""WITH {EV_SQL}, runs AS (
  SELECT symbol AS task, time, seq, CASE feed WHEN 'view' THEN 'running'
    WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'created' ELSE 'completed' END AS status,
    CASE WHEN feed = 'error' THEN props END AS error FROM ev
)"""


def run_status_counts(spark, sf_dir):
    return audit.status_counts(_runs(spark, sf_dir))


STATUS_COUNTS_SQL = _RUNS_SQL + """
SELECT status, count(*) AS n_runs, count(*) FILTER (WHERE status = 'running') AS n_running
FROM runs GROUP BY status
"""


def run_latest_state(spark, sf_dir):
    state = audit.latest_state(_runs(spark, sf_dir), ["task"], time="time", seq="seq")
    return state.withColumn("last_run_time", naive("last_run_time"))


LATEST_STATE_SQL = _RUNS_SQL + """
, n AS (SELECT *, count(*) OVER (PARTITION BY task) AS run_count FROM runs
  QUALIFY row_number() OVER (PARTITION BY task ORDER BY time DESC, seq DESC) = 1)
SELECT task, run_count, time AS last_run_time, status AS last_status, error AS last_error FROM n
"""


def run_status_changes(spark, sf_dir):
    changed = audit.status_changes(_runs(spark, sf_dir), ["task"], ["time", "seq"])
    return changed.select(
        "task", naive("time").alias("time"), F.col("seq").alias("event_id"),
        "old_status", "new_status",
    )


STATUS_CHANGES_SQL = _RUNS_SQL + """
, l AS (SELECT *, lag(status) OVER (PARTITION BY task ORDER BY time, seq) AS old FROM runs)
SELECT task, time, seq AS event_id, old AS old_status, status AS new_status FROM l
WHERE old <> status
"""


# -- streams -----------------------------------------------------------------
def _event_stream(spark, sf_dir):
    raw = ingest.landing_stream(
        spark, sf_dir, table(spark, sf_dir, "events").schema, glob="events.parquet"
    )
    return raw.select(
        F.concat(F.lit("u"), F.col("user_id")).alias("symbol"),
        utc("ts").alias("time"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("feed"),
        "value",
    )


def _ingested(spark, sf_dir):
    rows = as_table(hourly(_event_stream(spark, sf_dir)), "events", "1h")
    base = work_path(spark, "ingest")
    made = store.SeriesTable(spark, f"{base}/table", VALUES)
    query = ingest.ingest(
        rows, made, f"{base}/checkpoint", arrival=["seq"], audit_path=f"{base}/audit"
    )
    query.awaitTermination()
    return made, base


def stream_ingest(spark, sf_dir):
    made, _ = _ingested(spark, sf_dir)
    return _table_rows(made.read())


def stream_audit(spark, sf_dir):
    """The log of two runs over the same rows, the second from a checkpoint of its own."""
    made, base = _ingested(spark, sf_dir)
    rows = as_table(hourly(_event_stream(spark, sf_dir)), "events", "1h")
    ingest.ingest(
        rows, made, f"{base}/checkpoint-2", arrival=["seq"], audit_path=f"{base}/audit"
    ).awaitTermination()
    log = spark.read.schema(ingest.AUDIT).parquet(f"{base}/audit")
    return log.select(
        (F.col("run_id") == ingest.run_of(spark, f"{base}/checkpoint")).alias("first_run"),
        "batch_id",
        "symbol",
        "rows_in",
        "rows_new",
        naive("first_time").alias("first_time"),
        naive("last_time").alias("last_time"),
        "status",
    )


STREAM_AUDIT_SQL = f"""
WITH {HOURLY_SQL}, a AS (
  SELECT symbol, count(*) AS rows_in, count(DISTINCT time) AS rows_new,
    min(time) AS first_time, max(time) AS last_time FROM h GROUP BY symbol
)
SELECT TRUE AS first_run, 0::BIGINT AS batch_id, *, 'completed' AS status FROM a
UNION ALL
SELECT FALSE, 0, symbol, rows_in, 0, first_time, last_time, 'idle' FROM a
"""


def _streamed(spark, rows, label):
    base = work_path(spark, label)
    ingest.to_parquet(rows, f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/rows")


def stream_dedupe(spark, sf_dir):
    """One row a key with all its columns; a row is one of those that came, whole."""
    rows = hourly(_event_stream(spark, sf_dir)).select("symbol", "time", "feed", "seq", "value")
    first = ingest.first_arrivals(rows, ["symbol", "time", "feed"], "1 hour")
    kept = _streamed(spark, first, "dedupe").withColumn("time", naive("time"))
    came = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("value").alias("came"))
    return kept.join(came, "seq").select("symbol", "time", "feed", (F.col("value") == F.col("came")).alias("whole"))


STREAM_DEDUPE_SQL = f"""
WITH {EV_SQL} SELECT DISTINCT symbol, date_trunc('hour', time) AS time, feed, TRUE AS whole FROM ev
"""


def stream_closed_bars(spark, sf_dir):
    bars = ingest.closed_bars(_event_stream(spark, sf_dir), ["symbol"], "1d", "1 hour")
    return _bar_rows(rounded_volume(_streamed(spark, bars, "bars")))


# The watermark is an hour behind the last event; a bar is emitted once it has passed its end.
STREAM_BARS_SQL = f"""
WITH {EV_SQL}, {bars_sql('bars', ONE_DAY)}
SELECT * FROM bars
WHERE time + INTERVAL 1 DAY <= (SELECT max(time) - INTERVAL 1 HOUR FROM ev)
"""

QUERIES = {
    "src_ohlcv_from_arrays": (src_ohlcv_from_arrays, BARS_4H_SQL),
    "market_normalize": (market_normalize, BARS_1D_SQL),
    "src_derivatives_feeds": (src_derivatives_feeds, DERIVATIVES_SQL),
    "macro_central_to_utc": (macro_central_to_utc, MACRO_SQL),
    "macro_range": (macro_range, MACRO_RANGE_SQL),
    "fgi_shift_day": (fgi_shift_day, FGI_SQL),
    "json_map_explode": (json_map_explode, JSON_MAP_SQL),
    "json_doc_extract": (json_doc_extract, JSON_DOC_SQL),
    "load_coerce": (load_coerce, LOAD_COERCE_SQL),
    "json_records_export": (json_records_export, JSON_EXPORT_SQL),
    "json_records_inline": (json_records_inline, JSON_INLINE_SQL),
    "store_parquet_roundtrip": (store_parquet_roundtrip, _first_hour_sql()),
    "store_feather_roundtrip": (_file_roundtrip("feather"), ROWS_SQL),
    "store_json_roundtrip": (_file_roundtrip("json"), ROWS_MS_SQL),
    "store_jsongz_roundtrip": (_file_roundtrip("jsongz"), ROWS_MS_SQL),
    "store_plain_parquet_roundtrip": (_file_roundtrip("parquet"), ROWS_SQL),
    "store_old_times": (store_old_times, STORE_OLD_SQL),
    "files_listed": (files_listed, FILES_LISTED_SQL),
    "store_tail": (store_tail, STORE_TAIL_SQL),
    "store_missing_dataset": (store_missing_dataset, ROWS_SQL),
    "json_records_cut": (json_records_cut, JSON_EXPORT_SQL),
    "macro_catalogue_join": (macro_catalogue_join, MACRO_CATALOGUE_SQL),
    "store_load_series": (store_load_series, STORE_LOAD_SQL),
    "store_upsert": (store_upsert, STORE_UPSERT_SQL),
    "store_delete_series": (store_delete_series, STORE_DELETE_SQL),
    "store_delete_report": (store_delete_report, STORE_DELETE_REPORT_SQL),
    "store_replace": (store_replace, STORE_REPLACE_SQL),
    "store_compact": (store_compact, _first_hour_sql()),
    "store_exists": (store_exists, STORE_EXISTS_SQL),
    "series_time_range": (series_time_range, TIME_RANGE_SQL),
    "catalog_list": (catalog_list, CATALOG_SQL),
    "data_info_report": (data_info_report, DATA_INFO_SQL),
    "instrument_dim": (instrument_dim, INSTRUMENT_DIM_SQL),
    "symbol_route": (symbol_route, SYMBOL_ROUTE_SQL),
    "name_normalize": (name_normalize, NAME_NORMALIZE_SQL),
    "name_collisions": (name_collisions, NAME_COLLISIONS_SQL),
    "universe_semi": (universe_semi, _universe_sql("")),
    "universe_anti": (universe_anti, _universe_sql("NOT")),
    "catalogue_join": (catalogue_join, CATALOGUE_SQL),
    "run_status_counts": (run_status_counts, STATUS_COUNTS_SQL),
    "run_latest_state": (run_latest_state, LATEST_STATE_SQL),
    "run_status_changes": (run_status_changes, STATUS_CHANGES_SQL),
    "stream_ingest": (stream_ingest, _first_hour_sql()),
    "stream_audit": (stream_audit, STREAM_AUDIT_SQL),
    "stream_dedupe": (stream_dedupe, STREAM_DEDUPE_SQL),
    "stream_closed_bars": (stream_closed_bars, STREAM_BARS_SQL),
}
