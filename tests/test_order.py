"""Order as a checked property: every query that promises one keeps it."""

from __future__ import annotations

import random

import pytest
from oracle_check import connect

import __spark_entry__ as driver
from casestar.catalog import registry
from casestar.operators.ordering import order_violations

SMALL = "/root/testdata/sf0.001"


def after(one, other, order):
    """Whether a row comes after another: nulls first ascending, last descending."""
    for at, name in enumerate(order):
        a, b = one[at], other[at]
        if a != b:
            if name.startswith("-"):
                return a is None or (b is not None and a < b)
            return b is None or (a is not None and a > b)
    return False


@pytest.mark.parametrize("order", [["a", "-b"], ["-a"], ["-b", "a"], ["b"]])
def test_violations_are_counted_over_partitions(spark, order):
    draw = random.Random(2)
    rows = [(draw.choice([None, 1, 2, 3]), draw.choice([None, "x", "é", ""])) for _ in range(200)]
    at = {"a": 0, "b": 1}
    keys = [tuple(row[at[name.lstrip("-")]] for name in order) for row in rows]
    wanted = sum(after(x, y, order) for x, y in zip(keys, keys[1:]))
    for parts in (1, 7, 200):
        # slices of a local table keep its order; more slices than rows leave empty partitions
        frame = spark.createDataFrame(spark.sparkContext.parallelize(rows, parts),
                                      "a int, b string")
        assert order_violations(frame, order).first() == (200, wanted)


def test_a_sorted_frame_has_none_and_an_empty_one_neither(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    frame = spark.range(5000).selectExpr("id % 97 as a", "id * 7 % 101 as b").repartition(9)
    ordered = frame.orderBy("a", frame.b.desc())
    assert order_violations(ordered, ["a", "-b"]).first() == (5000, 0)
    assert order_violations(ordered, ["-a"]).first().violations > 0
    assert order_violations(frame.limit(0), ["a"]).first() == (0, 0)


@pytest.mark.parametrize("name", sorted(registry.ORDERS))
def test_a_query_keeps_the_order_it_promises(spark, name):
    frame = driver.queries()[name](spark, SMALL)
    found = order_violations(frame, registry.ORDERS[name]).first()
    assert found.violations == 0 and found.row_count == frame.count() > 0


@pytest.mark.parametrize("name", sorted(set(registry.ORDERS) - {"dash_top10_rates"}))
def test_rows_come_in_the_order_of_the_sql(spark, name):
    """The promised order settles every row, so both engines give the same sequence."""
    frame = driver.queries()[name](spark, SMALL)
    order = registry.ORDERS[name]
    keys = [column.lstrip("-") for column in order]
    by = ", ".join(f'"{column.lstrip("-")}" ' + (
        "DESC NULLS LAST" if column.startswith("-") else "ASC NULLS FIRST") for column in order)
    wanted = connect(SMALL).execute(
        f"SELECT {', '.join(f'CAST("{k}" AS VARCHAR)' for k in keys)} "
        f"FROM ({driver.oracle_sql()[name]}) ORDER BY {by}").fetchall()
    found = [tuple(None if v is None else str(v) for v in row)
             for row in frame.select(*keys).collect()]
    assert found == wanted
