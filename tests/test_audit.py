"""The audit a build writes, and ids proved unique without a shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from samples import raw_frame

from casestar.catalog import fixture, registry
from casestar.operators import observed, quality
from casestar.plans import etl
from casestar.plans.audit import recounted_audit
from casestar.plans.etl import build_warehouse

SF = "/root/testdata/sf0.001"
FACT = "id long, k long"


def items(frame):
    return {(r.section, r.item): r.observed for r in frame.collect()}


def test_observed_counts_equal_a_recount(spark):
    warehouse = fixture.warehouse(spark, SF)
    found = items(warehouse.audit())
    assert {k: v for k, v in found.items() if k[0] != "integrity"} == items(
        recounted_audit(fixture.raw_zone(spark, SF), warehouse))
    assert found["integrity", "fact_rows"] == warehouse.rows["fact_crash"]
    assert found["integrity", "duplicate_ids"] == found["integrity", "null_date_key"] == 0


def test_a_build_reads_the_raw_table_once_and_the_audit_not_at_all(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(text):
        seen.add(1)
        return True

    touched = F.udf(count, "boolean").asNondeterministic()
    raw = raw_frame(spark, *[{"borough": str(n % 3)} for n in range(50)], {"collision_id": " "},
                    {"collision_id": "7", "latitude": "0", "longitude": "0"},
                    {"crash_date": "2000-01-15"}, {"persons_injured": "21"})
    raw.write.parquet(str(tmp_path / "raw"))
    stored = spark.read.schema(raw.schema).parquet(str(tmp_path / "raw"))
    built = build_warehouse(spark, stored.where(touched("COLLISION_ID")), str(tmp_path / "root"))
    audit = built.audit()
    found = items(audit)
    assert seen.value == 54
    assert all("/audit/" in name for name in audit.inputFiles())
    assert [found["1 missing key", n] for n in ("rows_before", "rows_removed", "rows_after")] == [
        54, 1, 53]
    assert found["2 duplicate key", "rows_removed"] == found["3 invalid date", "rows_removed"] == 1
    assert found["coordinates", "both_zero_rows"] in (0, 1)  # which copy of id 7 stays
    assert found["flags", "injury_count_flagged_rows"] == 1


def test_an_empty_build_has_an_audit_of_zeros(spark, tmp_path):
    empty = raw_frame(spark, {}).limit(0)
    found = items(build_warehouse(spark, empty, str(tmp_path)).audit())
    assert set(found.values()) == {0} and len(found) == 28


def test_counts_before_the_shuffle_are_recounted_after_a_rerun(spark, tmp_path, monkeypatch):
    raw = raw_frame(spark, {}, {}, {"collision_id": None})
    monkeypatch.setattr(observed, "stage_ran_again", lambda *_: True)
    monkeypatch.setattr(etl, "key_metrics", lambda key: {
        "rows_read": F.count(F.lit(1)) + 0, "rows_keyed": F.count_if(~F.col(key).isNull())})
    found = items(build_warehouse(spark, raw, str(tmp_path)).audit())
    assert found["1 missing key", "rows_before"] == 3
    assert found["1 missing key", "rows_removed"] == 1


def test_coordinates_are_recounted_from_the_columns_up_to_them(spark):
    raw = raw_frame(
        spark, {"collision_id": "1", "latitude": "0", "longitude": "0", "factor_1": "z"},
        {"collision_id": "1", "latitude": "0", "longitude": "0", "factor_1": "a"},
        {"collision_id": "1", "latitude": "0", "longitude": "9", "factor_1": None},
        {"collision_id": "2", "latitude": "50"}, {"collision_id": "2", "latitude": None},
        {"collision_id": "3", "borough": "B", "latitude": "1"},
        {"collision_id": "3", "borough": None, "latitude": "n/a", "longitude": "-80"},
        {"collision_id": " ", "latitude": "50"}, {"collision_id": None, "latitude": "50"})
    found = etl.unique_coordinates(raw)
    whole = etl.typed_coordinates(etl.unique_records(raw))
    assert sorted(found.collect(), key=str) == sorted(
        whole.select(*found.columns).collect(), key=str)
    assert {r.collision_id: (r.latitude, r.longitude) for r in found.collect()} == {
        "1": (0.0, 0.0), "2": (None, -73.9), "3": (None, -80.0)}


def test_coordinate_audit_reads_no_column_behind_them(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")
    raw_frame(spark, {}, {}).write.parquet(path)
    monkeypatch.setattr(fixture, "raw_zone", lambda spark, sf_dir: spark.read.parquet(path))
    audit = registry.queries()["dq_coordinate_audit"](spark, SF)
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert "LONGITUDE" in plan
    assert "NUMBER OF" not in plan and "VEHICLE" not in plan


def test_a_stage_is_known_to_have_run_once(spark, tmp_path):
    watch = observed.Watch(spark)
    with watch.running():
        watch.on(spark.range(100).repartition(3), {"n": observed.row_count()}).write.parquet(
            str(tmp_path / "t"))
    assert watch.values() == {"n": 100} and watch.is_exact()
    assert spark.sparkContext._jsc.sc().statusTracker().getJobIdsForTag(watch._tag)


def frame(spark, ids):
    return spark.createDataFrame([(i, 1) for i in ids], FACT).repartition(4)


def test_equal_ids_are_proved_without_a_shuffle_of_ids(spark, monkeypatch):
    fact, base = frame(spark, range(500)), frame(spark, reversed(range(500)))
    plan = quality.key_sums(fact, base, "id", ["k"])._jdf.queryExecution().toString()
    assert "hashpartitioning(id" not in plan and "hashpartitioning(k" not in plan
    exact = quality.fact_integrity(fact, base, "id", ["k"]).first()
    monkeypatch.setattr(F, "countDistinct", None)  # not to be called
    found = quality.fact_integrity(fact, base, "id", ["k"], base_is_unique=True)
    assert found.first() == exact and found.columns == list(exact.asDict())
    assert (exact.row_inflation, exact.duplicate_ids, exact.null_id) == (0, 0, 0)


@pytest.mark.parametrize("ids, inflation, duplicates, nulls", [
    ([*range(499), 7], 0, 1, 0),          # one id lost, one doubled
    ([*range(500), 3, 3], 2, 2, 0),
    ([*range(499), None], 0, 1, 1),       # a null is no distinct id
    ([*range(499), 1000], 0, 0, 0),       # another id: nothing repeats
])
def test_planted_differences_are_counted_exactly(spark, ids, inflation, duplicates, nulls):
    found = quality.fact_integrity(frame(spark, ids), frame(spark, range(500)), "id", ["k"],
                                   base_is_unique=True).first()
    assert (found.row_inflation, found.duplicate_ids, found.null_id) == (
        inflation, duplicates, nulls)
