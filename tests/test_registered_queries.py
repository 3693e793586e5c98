import compare
import pytest

import __spark_entry__ as entry
from quintacube.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.sql_connection(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(entry.oracle_sql()) & set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(name, spark, con):
    assert compare.difference(name, spark, con, SF) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_no_query_pairs_rows_without_a_key(spark):
    for name in QUERIES:
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
