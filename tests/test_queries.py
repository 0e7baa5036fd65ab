"""Every registered query against its SQL, and the shape of the plans."""

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect
from seriesmill.queries import ALL, kept_queries, series_queries, source_queries, time_queries

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_names_are_unique():
    groups = (m.QUERIES for m in (time_queries, series_queries, source_queries, kept_queries))
    assert sum(len(g) for g in groups) == len(ALL)
    assert set(entry.queries()) == set(ALL) | set(entry.LLM_QUERIES)
    assert not set(ALL) & set(entry.LLM_QUERIES)


@pytest.mark.parametrize("name", list(ALL))
def test_query_equals_its_sql(spark, duck, name):
    assert name in ORACLES
    result = compare(spark, duck, entry.queries()[name], ORACLES[name], SF)
    assert result.startswith("ok"), result


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["symbol", "time", *series_queries.ALL_FEEDS]
    assert df.count() > 0


@pytest.mark.parametrize(
    "name",
    [n for n in ALL if not n.startswith(("stream_", "store_", "files_"))],
)
def test_no_query_multiplies_rows_by_rows(spark, plan_of, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
