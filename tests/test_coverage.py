"""Interval sets against sets of single milliseconds."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from seriesmill.plans import coverage

SCHEMA = "symbol string, start_ms long, end_ms long"
interval = st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 30), st.integers(0, 30))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def points(rows):
    out = {}
    for symbol, a, z in rows:
        out.setdefault(symbol, set()).update(range(a, z))
    return out


def runs(sets):
    out = []
    for symbol, own in sets.items():
        for at in sorted(own):
            if out and out[-1][0] == symbol and out[-1][2] == at:
                out[-1][2] = at + 1
            else:
                out.append([symbol, at, at + 1])
    return sorted(map(repr, map(tuple, out)))


def got(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("rows_per_task", [None, 4])
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(interval, max_size=25), st.lists(interval, max_size=25))
def test_union_and_difference(spark, rows_per_task, left, right):
    a, b = frame(spark, left), frame(spark, right)
    assert got(coverage.union(a, b, series=["symbol"], rows_per_task=rows_per_task)) == runs(points(left + right))
    had = points(right)
    rest = {k: v - had.get(k, set()) for k, v in points(left).items()}
    assert got(coverage.difference(a, b, series=["symbol"], rows_per_task=rows_per_task)) == runs(rest)


def test_a_plan_asks_for_head_holes_and_tail(spark):
    asked = frame(spark, [("a", 0, 100), ("b", 10, None), ("c", 5, 0), ("d", 0, 50)])
    had = frame(spark, [("a", 20, 40), ("a", 40, 50), ("a", 60, 70), ("a", 65, 68), ("d", 0, 90), ("e", 0, 9)])
    out = coverage.fetch_segments(asked, had, ["symbol"], 90)
    assert got(out) == sorted(map(repr, [
        ("a", 0, 20), ("a", 50, 60), ("a", 70, 90), ("b", 10, 90), ("c", 5, 90)
    ]))


def test_no_rows(spark):
    none, some = frame(spark, []), frame(spark, [("a", 3, 3), ("a", 5, 2)])
    assert got(coverage.union(none, some, series=["symbol"])) == []
    assert got(coverage.difference(some, none, series=["symbol"])) == []


def test_one_sort_per_sweep_and_no_join(spark, plan_of):
    """Both sweeps run over rows grouped by series; nothing is joined to itself."""
    plan = plan_of(coverage.difference(frame(spark, [("a", 0, 9)]), frame(spark, []), series=["symbol"], rows_per_task=None))
    assert "Join" not in plan and plan.count("Window [") + plan.count("Window(") <= 4
