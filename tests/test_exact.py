"""Sums that are the same for any order and any partitioning."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from seriesmill.functions.exact import exact_sum
from seriesmill.operators.bars import bars_from_events


def total(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return df.agg(exact_sum("x").alias("s")).first()["s"]


def test_any_partitioning_gives_the_same_bits(spark):
    rng = random.Random(4)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 14) for _ in range(3000)]
    found = set()
    for parts in (1, 3, 7):
        rng.shuffle(values)
        found.add(total(spark, values, parts))
    assert len(found) == 1
    true = float(sum(Fraction(v) for v in values))
    assert math.isclose(found.pop(), true, rel_tol=4e-16, abs_tol=3000 * 2**-60)


@pytest.mark.parametrize(
    "values, wanted",
    [
        ([], None),
        ([None, None], None),
        ([1e16, 1.0, -1e16], 1.0),
        ([0.1] * 10, 1.0),
        ([-0.25, 0.75, -3.5], -3.0),
        ([2.0**62, 2.0**62, 5e36, -5e36, 0.5], 2.0**63),
        ([float("inf"), 1.0], float("inf")),
        ([float("inf"), float("-inf")], math.nan),
        ([float("nan"), 1.0, None], math.nan),
    ],
)
def test_values(spark, values, wanted):
    got = total(spark, values, 2)
    if wanted is None or isinstance(wanted, float) and math.isnan(wanted):
        assert got is None if wanted is None else math.isnan(got)
    else:
        assert math.isclose(got, wanted, rel_tol=1e-15)


def test_bars_are_hash_aggregated_and_exact(spark, plan_of):
    rng = random.Random(1)
    rows = [("a", rng.randrange(0, 90_000), rng.uniform(0, 1), i) for i in range(400)] + [("a", 5, 0.5, -3), ("a", 5, 0.25, 9**18)]
    events = spark.createDataFrame(rows, "symbol string, s long, value double, seq long").withColumn(
        "time", F.timestamp_seconds("s")
    )
    plan = plan_of(bars_from_events(events, ["symbol"], "1d"))
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    seen = {repr(sorted(bars_from_events(events.repartition(n, "seq"), ["symbol"], "1d").collect())) for n in (1, 2, 5)}
    assert len(seen) == 1
    # The least (time, seq) opens the bar, the greatest closes it; other types of tie breaks do as well.
    named = events.withColumn("seq", F.col("seq").cast("string"))
    ordered = sorted((s, i, v) for _, s, v, i in rows if s < 86_400)
    first = bars_from_events(events, ["symbol"], "1d").filter("time < '1970-01-02'").first()
    assert (first.open, first.close) == (ordered[0][2], ordered[-1][2])
    assert bars_from_events(named, ["symbol"], "1d").count() == 2
