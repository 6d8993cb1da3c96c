"""Every named query against its SQL."""

import pytest
from compare import differences

import __spark_entry__ as entry
from tidegate import plans

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLES)


@pytest.mark.parametrize("name", list(plans.QUERIES))
def test_query_matches_sql(spark, name):
    df = plans.QUERIES[name](spark, SF)
    assert differences(df, SF, plans.ORACLES[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
