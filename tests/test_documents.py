"""Ranges and last rows from stored documents, by their index."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.sources import documents

RECORD = T.StructType([T.StructField("time", T.TimestampType()), T.StructField("value", T.LongType())])


@pytest.fixture
def stored(spark, tmp_path):
    rows = spark.range(100).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("symbol"),
        F.timestamp_micros(F.col("id") * 3_600_000_000 + F.col("id")).alias("time"),
        F.col("id").alias("value"),
    )
    made = documents.to_documents(rows, ["symbol"], ["time", "value"], ["time"], rows_per_document=4)
    documents.save_documents(made, ["symbol"], str(tmp_path / "docs"))
    return documents.load_documents(spark, ["symbol"], str(tmp_path / "docs"))


@pytest.mark.parametrize("start, end", [("1970-01-01 10:00:00", "1970-01-02 20:00:00"), (None, "1970-01-01 03:00:00"),
                                        ("1970-01-05 00:00:00", None), (None, None), ("1971-01-01", None)])
def test_ranges(spark, stored, start, end):
    found = documents.read_range(stored, ["symbol"], RECORD, start=start, end=end)
    every = documents.from_documents(stored, ["symbol"], RECORD)
    if start:
        every = every.filter(F.col("time") >= F.lit(start).cast("timestamp"))
    if end:
        every = every.filter(F.col("time") <= F.lit(end).cast("timestamp"))
    assert sorted(map(repr, found.collect())) == sorted(map(repr, every.collect()))


def test_the_index_reaches_the_scan(stored, plan_of):
    """The overlap test is pushed down and applied below the parsing of payloads."""
    plan = plan_of(documents.read_range(stored, ["symbol"], RECORD, start="1970-01-02", end="1970-01-03"))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    # The plan's text cuts the list of pushed filters short; the filter below the parsing names both ends.
    assert "GreaterThanOrEqual(last_time" in pushed
    below = plan[: plan.index("FileScan")]
    assert "Generate" in below and below.index("Generate") < below.index("first_time")


@pytest.mark.parametrize("n", [0, 1, 5, 9, 1000])
def test_last_rows(stored, n):
    got = {}
    for r in documents.read_last(stored, ["symbol"], RECORD, n).collect():
        got.setdefault(r.symbol, []).append(r.value)
    wanted = {s: [v for v in range(100) if v % 3 == k][-n:] if n else [] for k, s in ((0, None), (1, "s1"), (2, "s2"))}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in wanted.items() if v}
