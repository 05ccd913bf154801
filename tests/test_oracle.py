from __future__ import annotations

import pytest
from oracle_check import connect, differences

import __spark_entry__ as driver
from casestar.catalog import registry

SMALL, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
# every longitude is out of range in the small tables
NEED_LONGITUDES = ["clean_bbox", "dq_coordinate_audit", "dim_location", "geo_points", "join_null_safe"]


@pytest.fixture(scope="module")
def small():
    return connect(SMALL)


@pytest.fixture(scope="module")
def large():
    return connect(LARGE)


def test_every_query_has_its_sql():
    assert set(registry.queries()) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_its_sql(spark, small, name):
    frame = driver.queries()[name](spark, SMALL)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in plan
    assert differences(frame, small, driver.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", NEED_LONGITUDES)
def test_query_equals_its_sql_with_longitudes(spark, large, name):
    assert differences(driver.queries()[name](spark, LARGE), large, driver.oracle_sql()[name]) == []


def test_entry_point(spark):
    frame = driver.entry(spark)
    assert frame.count() == 25
    assert "fatality_rank_within_year" in frame.columns
