"""The operators' queries against their SQL on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points
from ledgerloom.llm.check_sql import CHECK_SQL
from ledgerloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = set(entry_points.queries())
    assert names >= QUERIES.keys() | {"pipeline"} and CHECK_SQL.keys() <= QUERIES.keys()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(CHECK_SQL))
def test_query(spark, name):
    assert differences(spark, connect(SF_DIR), QUERIES[name], CHECK_SQL[name], SF_DIR) == []
