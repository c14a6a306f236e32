"""Every registered query against its SQL."""

import pytest
from check_queries import connect, difference
from helpers import TESTDATA, plan_of

import __spark_entry__ as entry_points
from prefspark.catalog.oracles import ORACLES as SQL
from prefspark.catalog.queries import QUERIES

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if not name.endswith(("_worker", "_tokens")):
        assert "Python" not in plan and "InPandas" not in plan
    assert difference(df, con, SQL[name]) is None


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 20
    assert {r.status for r in df.collect()} <= {"accepted", "left", "invalid"}
