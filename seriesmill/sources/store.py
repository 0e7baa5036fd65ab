"""The series table: all series of all sources in one partitioned Parquet table.

Partitions are (source, timeframe, month); inside a file rows are sorted by
(symbol, time), so symbol and time filters skip row groups.  One writer at a
time is assumed; readers may run alongside.

What the table holds by series and month lies in an index beside it (see
``series_index``), so ends, counts and sizes are read without data files, and a
series is looked for in the months that hold it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.fixed_values import NO_DATASET_TEXT, NO_END_TEXT, NO_START_TEXT
from seriesmill.functions.names import dataset_id, format_size, table_name
from seriesmill.functions.timerange import between
from seriesmill.operators.dedupe import keep_first
from seriesmill.operators.matching import null_safe_join
from seriesmill.operators.membership import exists
from seriesmill.operators.merge import rows_to_add
from seriesmill.schemas import SERIES_KEYS, check_schema, keyed
from seriesmill.session import remove, require_utc, scratch, shared_folder, written, written_at
from seriesmill.sources.series_index import MONTH, PARTITIONS, SeriesIndex, merged

ROW_KEYS = [*SERIES_KEYS, "time"]
# Up to this many partitions are named in a filter; more are matched by a join.
_LISTED = 1000


def month_of(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM")


class SeriesTable:
    """A series table at ``path`` whose rows have the columns of ``payload``."""

    def __init__(self, spark: SparkSession, path: str, payload: T.StructType):
        require_utc(spark)
        self.spark, self.path = spark, path
        self.schema = keyed(payload, source=True)
        self._stored = T.StructType([*self.schema.fields, T.StructField(MONTH, T.StringType())])
        payload = [c for c in self.schema.fieldNames() if c not in SERIES_KEYS]
        self.index = SeriesIndex(spark, path, lambda rows: record_size(rows, payload))

    # -- reading -------------------------------------------------------------
    def _scan(self) -> DataFrame:
        # Months are those of UTC; under another zone a read would prune the wrong ones.
        require_utc(self.spark)
        try:
            return self.spark.read.schema(self._stored).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self._stored)

    def read(self, *, source=None, symbols=None, timeframe=None, start=None, end=None):
        """Rows of some series within an inclusive time range; no filter means all.

        A range also prunes the month partitions it does not touch.
        """
        df = self._scan()
        if source is not None:
            df = df.filter(F.col("source") == source)
        if timeframe is not None:
            df = df.filter(F.col("timeframe") == timeframe)
        if symbols is not None:
            df = df.filter(F.col("symbol").isin(symbols))
        if start is not None:
            df = df.filter(F.col(MONTH) >= month_of(F.lit(start).cast("timestamp")))
        if end is not None:
            df = df.filter(F.col(MONTH) <= month_of(F.lit(end).cast("timestamp")))
        return df.filter(between(F.col("time"), start, end)).drop(MONTH)

    # -- writing -------------------------------------------------------------
    def _write(self, df: DataFrame, mode: str) -> None:
        """Range-partitioned by the stored order: full files, however uneven the series."""
        by = [*PARTITIONS, "symbol", "time"]
        (
            df.repartitionByRange(*by)
            .sortWithinPartitions(*by)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITIONS)
            .parquet(self.path)
        )

    def _prepared(self, df: DataFrame, extra: list[str] = ()) -> DataFrame:
        require_utc(self.spark)
        check_schema(df, self.schema, "rows to store")
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        return df.select(*columns, *extra).withColumn(MONTH, month_of(F.col("time")))

    def append(self, df: DataFrame) -> None:
        """Add rows known to be new."""
        with scratch(self.spark):
            self.add_rows(written(self._prepared(df), "staged"))

    def upsert(self, new: DataFrame, arrival: list[str] | None = None) -> DataFrame:
        """Add the rows whose (series, time) is not stored; returns the rows added.

        ``new`` is read once: what is looked at again is a staged copy, so an input that
        is not the same twice adds what it first was.
        """
        check_schema(new, self.schema, "rows to store")
        names = list(dict.fromkeys([*self.schema.fieldNames(), *(arrival or [])]))
        incoming, path = written_at(new.select(*names), "incoming")
        try:
            added = self.new_rows(incoming, arrival)
            self.add_rows(added)
        finally:
            remove(self.spark, path)
        return added.drop(MONTH)

    def new_rows(self, new: DataFrame, arrival: list[str] | None = None) -> DataFrame:
        """The rows an upsert adds, kept in the shared folder until :meth:`add_rows` stores them.

        Stored rows win, so nothing stored is rewritten, and running the same
        batch again adds nothing.  Of new rows with one key the first by
        ``arrival`` wins, and of those that tie, or without ``arrival``, the
        least by all columns.  Of the table only the key columns are read, and
        only in partitions the batch touches.  ``new`` is evaluated twice, so it should
        be a stored table; :meth:`upsert` stages it.
        """
        shared_folder(self.spark)
        fields = self.schema.fieldNames()
        extra = [c for c in arrival or [] if c not in fields]
        order = [*(arrival or []), *(c for c in fields if c not in ROW_KEYS)]
        incoming = self._prepared(new, extra)
        stored = self._within(incoming, PARTITIONS)
        return written(rows_to_add(stored, incoming, ROW_KEYS, order).drop(*extra), "added")

    def add_rows(self, added: DataFrame) -> None:
        """Store rows that :meth:`new_rows` found; the index follows by their counts."""
        self.settle()
        note = self.index.begin(added)
        self._write(added.select(*self._stored.fieldNames()), "append")
        self.index.add(self.index.deltas(note))
        self.index.end(note)

    def replace(self, df: DataFrame) -> bool:
        """Store ``df`` in place of whatever its series held; an empty frame changes nothing."""
        with scratch(self.spark):
            prepared = written(self._prepared(df), "replacing")
            if not prepared.isEmpty():
                self._rewrite(prepared.select(*SERIES_KEYS).distinct(), prepared)
        return True

    def delete(self, keys: DataFrame) -> DataFrame:
        """Remove series; returns the requested keys with ``deleted`` (False: was missing)."""
        shared_folder(self.spark)
        requested = keys.select(*SERIES_KEYS).distinct().checkpoint()
        report = self.exists(requested).withColumnRenamed("present", "deleted").checkpoint()
        self._rewrite(requested, None)
        return report

    def compact(self, *, source: str, timeframe: str, month: str) -> None:
        """Rewrite one partition into full, sorted files, one row per (series, time)."""
        part = self._scan().filter(
            (F.col("source") == source)
            & (F.col("timeframe") == timeframe)
            & (F.col(MONTH) == month)
        )
        # Nothing says which of several rows came first; the least by all columns stays.
        kept = keep_first(part, ROW_KEYS, [c for c in self.schema.fieldNames() if c not in ROW_KEYS])
        self.settle()
        self._overwrite(kept.select(*self._stored.fieldNames()), part.select(*PARTITIONS).limit(0))

    def _within(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        """Stored rows of the partitions that ``rows`` lie in."""
        return self._scan().filter(self._lying(rows, columns))

    def _lying(self, rows: DataFrame, columns: list[str]) -> Column:
        """A test for the partitions that ``rows`` lie in.

        The partition values become literals, so all other folders are
        skipped while a scan of the table, or of its index, is planned.
        """
        wanted = rows.select(*columns).distinct()
        listed = wanted.limit(_LISTED + 1).collect()
        if len(listed) > _LISTED:
            return self._spanned(wanted, columns)
        folders: dict[tuple, list] = {}
        for *folder, last in listed:
            folders.setdefault(tuple(folder), []).append(last)
        test = F.lit(False)
        for folder, lasts in folders.items():
            one = F.col(columns[-1]).isin([v for v in lasts if v is not None])
            if None in lasts:
                one = one | F.col(columns[-1]).isNull()
            for name, value in zip(columns, folder, strict=False):
                one = one & (F.col(name).isNull() if value is None else F.col(name) == value)
            test = test | one
        return test

    def _spanned(self, wanted: DataFrame, columns: list[str]) -> Column:
        """A test for a superset of many partitions: their months, by source and time frame if these are few."""
        *folder, last = columns
        low, high = F.min(last).alias("low"), F.max(last).alias("high")
        spans = wanted.groupBy(*folder).agg(low, high, F.count_if(F.col(last).isNull()).alias("nulls"))
        listed = spans.limit(_LISTED + 1).collect()
        if len(listed) > _LISTED:
            folder, listed = [], wanted.agg(low, high, F.count_if(F.col(last).isNull()).alias("nulls")).collect()
        test = F.lit(False)
        for row in listed:
            one = F.col(last).between(row["low"], row["high"])
            if row["nulls"]:
                one = one | F.col(last).isNull()
            for name in folder:
                one = one & F.col(name).eqNullSafe(F.lit(row[name]))
            test = test | one
        return test

    def _rewrite(self, keys: DataFrame, extra: DataFrame | None) -> None:
        """Rewrite the partitions that hold ``keys`` without them, with ``extra`` added.

        The index tells which partitions these are; no others are read.
        """
        shared_folder(self.spark)
        self.settle()
        near = self.index_rows().filter(self._lying(keys, PARTITIONS[:2]))
        holding = null_safe_join(near, keys, SERIES_KEYS, "left_semi")
        # One row per table partition.
        affected = holding.select(*PARTITIONS).distinct().checkpoint()
        touched = affected
        if extra is not None:
            touched = affected.unionByName(extra.select(*PARTITIONS).distinct())
        # A partition is replaced as a whole: what other series hold in it comes along.
        wanted = (
            self._within(touched, PARTITIONS)
            .transform(null_safe_join, keys, SERIES_KEYS, "left_anti")
            .select(*self._stored.fieldNames())
        )
        if extra is not None:
            wanted = wanted.unionByName(extra.select(*self._stored.fieldNames()))
        self._overwrite(wanted, affected)

    def _overwrite(self, df: DataFrame, affected: DataFrame) -> None:
        """Replace the partitions of ``df``, which may be read from this table, and empty other ``affected`` ones.

        The new rows are staged first; once the note is left, the swap is done again
        from them if it is cut short.
        """
        staged, path = written_at(df, "staged")
        filled = staged.select(*PARTITIONS).distinct()
        emptied = null_safe_join(affected, filled, PARTITIONS, "left_anti")
        self._swap(self.index.begin(staged, path, emptied))

    def _swap(self, note: dict) -> None:
        self._write(self.spark.read.schema(self._stored).parquet(note["staged"]), "overwrite")
        self.index.replace(self.index.deltas(note))
        emptied = self.index.emptied(note)
        for path in (self.path, self.index.path):
            self._drop_partitions(path, emptied)
        self.index.end(note)

    def settle(self) -> None:
        """Finish writes that were cut short, and build the index of a table that has none.

        Called before every write; one writer at a time is assumed.
        """
        for note in self.index.notes():
            if note["staged"]:
                self._swap(note)
            else:
                touched = self.index.touched(note).checkpoint()
                self.index.replace(self.index.counted(self._within(touched, PARTITIONS)))
                self.index.end(note)
        if self.index.stored() is None:
            self.index.add(self.index.counted(self._scan()))

    def index_rows(self) -> DataFrame:
        """One row per series and month: first and last time, rows and bytes.

        A table without an index, written by other means, is counted from its rows.
        """
        if self.index.stored() is None:
            return self.index.counted(self._scan())
        return self.index.known(lambda parts: self.index.counted(self._within(parts, PARTITIONS)))

    def _drop_partitions(self, table: str, partitions: DataFrame) -> None:
        """A dynamic overwrite leaves a partition without new rows alone; its folder is removed.

        That is a call to the file system for each folder, not a Spark job.
        """
        conf = self.spark._jsc.hadoopConfiguration()
        for row in partitions.toLocalIterator():
            folder = "/".join(f"{name}={_escaped(row[name])}" for name in PARTITIONS)
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{folder}")
            path.getFileSystem(conf).delete(path, True)

    # -- catalog -------------------------------------------------------------
    def exists(self, keys: DataFrame) -> DataFrame:
        """The requested series with ``present``, from the index of their sources and time frames."""
        return exists(keys, self.index_rows().filter(self._lying(keys, PARTITIONS[:2])), SERIES_KEYS)

    def series(self, **wanted) -> DataFrame:
        """Per series: first and last time, rows and bytes; ``wanted`` as in :meth:`read`.

        Whole series are added up from the index.  Where a range is asked for, the
        rows of the range are counted.
        """
        if wanted.get("start") is None and wanted.get("end") is None:
            rows = self.index_rows()
            for name in ("source", "timeframe"):
                if wanted.get(name) is not None:
                    rows = rows.filter(F.col(name) == wanted[name])
            if wanted.get("symbols") is not None:
                rows = rows.filter(F.col("symbol").isin(wanted["symbols"]))
        else:
            rows = self.index.counted(self.read(**wanted).withColumn(MONTH, month_of(F.col("time"))))
        return merged(rows, SERIES_KEYS)

    def catalog(self, **wanted) -> DataFrame:
        """One row per series, ordered by name; ``wanted`` as in :meth:`read` names some of them."""
        return catalogued(self.series(**wanted), len(self.schema) - len(SERIES_KEYS))

    def time_ranges(self, **wanted) -> DataFrame:
        return self.series(**wanted).select(
            *SERIES_KEYS, F.col("first_time").alias("start_time"), F.col("last_time").alias("end_time")
        )

    def high_water(self, **wanted) -> DataFrame:
        """First and last stored time of every series in milliseconds, as an incremental plan takes them."""
        return self.series(**wanted).select(
            *SERIES_KEYS, F.unix_millis("first_time").alias("min_ms"), F.unix_millis("last_time").alias("max_ms")
        )

    def tail(
        self, n: int, *, source: str | None = None, symbol: str | None = None, timeframe: str | None = None
    ) -> DataFrame:
        """The last ``n`` rows of a series, or over all series of those named, from the newest months alone.

        The index tells how many rows each month holds, so just the months that the
        rows lie in are read.
        """
        wanted = {"source": source, "timeframe": timeframe, "symbols": None if symbol is None else [symbol]}
        rows = self.index_rows()
        for name, value in (("source", source), ("timeframe", timeframe), ("symbol", symbol)):
            if value is not None:
                rows = rows.filter(F.col(name) == value)
        months = rows.filter(F.col(MONTH).isNotNull()).groupBy(MONTH).agg(F.sum("row_count").alias("n"))
        start, held = None, 0
        # One row per calendar month.
        for month in months.orderBy(F.col(MONTH).desc()).collect():
            start, held = f"{month[MONTH]}-01 00:00:00", held + month["n"]
            if held >= n:
                break
        own = self.read(**wanted, start=start if held >= n else None)
        ties = [F.col(c).desc() for c in self.schema.fieldNames() if c != "time"]
        return own.orderBy(F.col("time").desc(), *ties).limit(n)


# Characters that Spark writes as %XX in partition folder names.
_ESCAPED = set('"#%\'*/:=?\\\x7f{[]^') | {chr(i) for i in range(1, 32)}


def _escaped(value: str | None) -> str:
    if not value:
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def time_ranges(df: DataFrame, series: list[str], time: str = "time") -> DataFrame:
    return df.groupBy(*series).agg(
        F.min(time).alias("start_time"), F.max(time).alias("end_time")
    )


def record_size(df: DataFrame, columns: list[str]) -> Column:
    """Bytes of a row as a JSON record, times as epoch milliseconds."""
    fields = [
        F.unix_millis(c).alias(c)
        if isinstance(df.schema[c].dataType, T.TimestampType)
        else F.col(c)
        for c in columns
    ]
    return F.octet_length(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))


def catalog(df: DataFrame, series: list[str] | None = None) -> DataFrame:
    """One row per series: names, counts, exact JSON size and time range, ordered by name."""
    keys = series or SERIES_KEYS
    payload = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(
        F.count("*").alias("row_count"),
        F.sum(record_size(df, payload)).alias("size_bytes"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
    )
    return catalogued(grouped, len(payload))


def catalogued(counts: DataFrame, column_count: int) -> DataFrame:
    """Names and sizes of series from what they hold, ordered by name."""
    name = dataset_id(F.col("symbol"), F.col("timeframe"))
    return counts.select(
        name.alias("id"),
        F.col("source").alias("sub"),
        table_name(name, F.col("source")).alias("table_name"),
        F.lit(column_count).alias("column_count"),
        "row_count",
        "size_bytes",
        format_size(F.col("size_bytes")).alias("size"),
        F.col("first_time").alias("start_time"),
        F.col("last_time").alias("end_time"),
    ).orderBy("table_name", "id")


def info_report(requested: DataFrame, ranges: DataFrame, series: list[str]) -> DataFrame:
    """Every requested series with its range as text; stand-in texts where there is none."""

    def text(column: str, missing: str) -> Column:
        shown = F.coalesce(
            F.date_format(column, "yyyy-MM-dd HH:mm:ss"), F.lit(missing)
        )
        return F.when(F.col("_found"), shown).otherwise(F.lit(NO_DATASET_TEXT)).alias(column)

    found = ranges.withColumn("_found", F.lit(True))
    return requested.join(found, series, "left").select(
        dataset_id(F.col("symbol"), F.col("timeframe")).alias("data_name"),
        "symbol",
        "timeframe",
        text("start_time", NO_START_TEXT),
        text("end_time", NO_END_TEXT),
    )
