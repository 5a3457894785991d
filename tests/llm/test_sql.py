"""The operators' queries against their DuckDB SQL, on the smallest tables."""

import pytest

from kestrel.llm.catalog import QUERIES
from kestrel.llm.sql import ORACLE
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    ok, why = compare(QUERIES[name](spark, SF).toPandas(), duck(ORACLE[name], SF))
    assert ok, why
