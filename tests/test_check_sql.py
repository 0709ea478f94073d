"""Every registered query against its SQL on the test tables."""

import pytest
from compare import connect, differences
from conftest import TESTDATA

import __spark_entry__ as entry_points
from ledgerloom.catalog.check_sql import CHECK_SQL
from ledgerloom.catalog.queries import registered

# The smallest tables have no product short of stock.
LARGER = {"stockout_risk"}


@pytest.fixture(scope="module")
def connections():
    cache = {}

    def get(sf_dir):
        if sf_dir not in cache:
            cache[sf_dir] = connect(sf_dir)
        return cache[sf_dir]
    return get


def test_every_query_has_sql():
    assert registered().keys() == CHECK_SQL.keys()
    assert entry_points.queries().keys() >= registered().keys()


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, connections, name):
    sf_dir = f"{TESTDATA}/{'sf0.01' if name in LARGER else 'sf0.001'}"
    query, sql = registered()[name], CHECK_SQL[name]
    assert differences(spark, connections(sf_dir), query, sql, sf_dir) == []


def test_entry(spark):
    flagship = entry_points.entry(spark)
    assert flagship.columns == ["category_en", "revenue", "gross_margin", "margin_pct"]
    assert flagship.count() > 0
