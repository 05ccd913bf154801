from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from samples import raw_frame

from casestar.catalog import fixture
from casestar.catalog.fixture import RULES
from casestar.config import QuestionRules
from casestar.operators import rollup, windows
from casestar.plans import questions as ask
from casestar.plans import report as show
from casestar.plans.etl import build_warehouse

SF = "/root/testdata/sf0.001"
PLAIN = [ask.crashes_by_borough, ask.pedestrian_peak_hours, ask.pedestrian_heatmap,
         ask.severity_by_vehicle]
RULED = [ask.fatality_rates, ask.cyclist_months, ask.cyclist_periods, ask.severe_crash_factors,
         ask.located_points]


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("ratio", [0, 4, 10**9])
@pytest.mark.parametrize("limit", [0, 60_000])
def test_every_join_route_gives_the_same_answers(spark, monkeypatch, ratio, limit):
    """Broadcast, summed before the join, and joined row by row."""
    warehouse = fixture.warehouse(spark, SF)
    monkeypatch.setattr(rollup, "PREAGGREGATE_RATIO", ratio)
    forced = replace(warehouse, broadcast_limit=limit)
    for plan in PLAIN:
        assert rows(plan(forced)) == rows(plan(warehouse)), plan.__name__
    for plan in RULED:
        assert rows(plan(forced, RULES)) == rows(plan(warehouse, RULES)), plan.__name__


def test_a_large_dimension_is_joined_after_summing(spark, conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(rollup, "PREAGGREGATE_RATIO", 0)
    forced = replace(fixture.warehouse(spark, SF), broadcast_limit=0)
    plan = ask.fatality_rates(forced, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    below_join = plan[plan.index("SortMergeJoin"):]
    assert "HashAggregate(keys=[location_key" in below_join


def test_averages_combine_with_nulls(spark, tmp_path, monkeypatch):
    raw = raw_frame(spark, *[{"cyclists_injured": x, "borough": b, "crash_date": "01/01/2019"}
                             for x, b in (("1", "A"), (None, "A"), ("4", "A"), (None, "B"))])
    warehouse = build_warehouse(spark, raw, str(tmp_path))
    wanted = rollup.Rollup(keys={"borough": ("dim_location", F.col("borough"))},
                           count="n", sums={"total": "cyclists_injured"},
                           averages={"mean": "cyclists_injured"})
    monkeypatch.setattr(rollup, "PREAGGREGATE_RATIO", 0)
    for limit in (0, 10**9):
        found = rollup.star_rollup(replace(warehouse, broadcast_limit=limit), wanted)
        assert sorted(rows(found)) == [("A", 3, 5, 2.5), ("B", 1, None, None)]


def test_rank_ties_leave_a_gap(spark):
    df = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1)], "k string, v int")
    ranked = windows.rank_within(df.withColumn("y", F.lit(1)), ["y"], [F.desc("v")], "r")
    assert sorted((r.k, r.r) for r in ranked.collect()) == [("a", 1), ("b", 1), ("c", 3)]


def test_change_goes_by_row_not_by_calendar(spark):
    df = spark.createDataFrame([(2020, 1, 5), (2020, 3, 9)], "y int, m int, v long")
    found = windows.change_from_previous(df, ["y", "m"], "v", "before", "change")
    assert [(r.before, r.change) for r in found.orderBy("m").collect()] == [(None, None), (5, 4)]


# published monthly results: year, month, total, total of the month before
def test_month_labels_and_periods(spark, tmp_path):
    raw = raw_frame(spark, *[{"crash_date": d, "cyclists_injured": n} for d, n in (
        ("07/01/2012", "450"), ("08/01/2012", "508"), ("09/01/2012", "434"), ("01/01/2019", "7"),
        ("12/31/2011", "9"))])
    warehouse = build_warehouse(spark, raw, str(tmp_path))
    assert rows(ask.cyclist_months(warehouse)) == [
        (2012, 7, 450, "Pre-2019", None, None, "2012-07"),
        (2012, 8, 508, "Pre-2019", 450, 58, "2012-08"),
        (2012, 9, 434, "Pre-2019", 508, -74, "2012-09"),
        (2019, 1, 7, "Post-2019", 434, -427, "2019-01")]
    assert rows(ask.cyclist_periods(warehouse)) == [
        ("Post-2019", 7, 7.0), ("Pre-2019", 1392, 464.0)]


def test_points_stop_at_the_limit(spark):
    warehouse = fixture.warehouse(spark, "/root/testdata/sf0.01")
    few = ask.located_points(warehouse, QuestionRules(geo_limit=20))
    many = ask.located_points(warehouse, QuestionRules(geo_limit=2000))
    assert few.count() == 20 and many.count() == 2000
    assert rows(few) == rows(many)[:20]


def test_pivot_fills_or_leaves_gaps(spark):
    heat = spark.createDataFrame([(1, 0, 5), (2, 23, 7)],
                                 "day_of_week int, hour int, total_pedestrian_injuries long")
    filled = {r.day_of_week: r for r in show.heatmap_matrix(heat).collect()}
    assert (filled[1].h0, filled[1].h23, filled[2].h23) == (5, 0, 7)
    gaps = {r.day_of_week: r for r in show.heatmap_matrix(heat, fill=None).collect()}
    assert gaps[1].h23 is None


def test_report_leaves_out_empty_results_and_adds_commentary(spark):
    rates = spark.createDataFrame([("X", 2024, 4.084), ("Y", 2023, 4.084)],
                                  f"borough string, year int, {show.RATE} double")
    months = spark.createDataFrame([(2020,)], "year int")
    none = spark.createDataFrame([], "contributing_factor string, time_of_day string, crash_count long")
    lines = show.insight_rows(
        {"Q1 Interpretation": rates, "Q4 Interpretation": months, "Q5 Interpretation": none},
        {"Q4 Interpretation": ["A note with 100% in it."]})
    assert [r.line for r in lines.orderBy("section_no", "line_no").collect()] == [
        "Q1 Interpretation",
        "- The highest borough-year fatality rate was X in 2024, with 4.08 fatalities per 1000 crashes.",
        "", "Q4 Interpretation", "- A note with 100% in it.", ""]
