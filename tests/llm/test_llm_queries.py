"""Every query of the package that has SQL against it."""

import pytest
from compare import differences

from tidegate.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), SF, ORACLES[name]) == []
