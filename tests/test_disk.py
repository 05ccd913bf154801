"""Shuffle files of a build: a share of the rows at a time, gone when their job is done."""

from __future__ import annotations

import os
import re
import time

import pytest
from pyspark.sql import functions as F
from samples import raw_frame
from test_warehouse import given_tables, rows

from casestar.catalog import fixture
from casestar.config import RawColumns
from casestar.operators.observed import added
from casestar.operators.quality import GateFailure
from casestar.plans import etl
from casestar.schemas import WAREHOUSE
from casestar.session import MOST_PASSES, PASS_BYTES, RELEASE, passes_for, released_shuffles


def shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(re.findall(r"shuffle_\w+\.data", blocks.getAllFiles().mkString("|")))


def left_over(spark, before: set[str], seconds: float = 20) -> set[str]:
    """Shuffle files that are new and stay; removing them is not waited for by the action."""
    until = time.time() + seconds
    while (found := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return found


def messy(spark):
    """Ids with copies that differ, missing and blank ids, invalid dates, many places and times."""
    records = [{"collision_id": str(n % 150), "borough": f"B{n % 7}", "crash_time": f"{n % 24}:00",
                "latitude": f"40.{40 + n % 30}", "persons_injured": str(n % 30),
                "crash_date": "13/13/2020" if n % 31 == 0 else f"{1 + n % 12:02d}/05/2020"}
               for n in range(400)]
    records += [{"collision_id": None}, {"collision_id": "  "}, {"collision_id": None}]
    return raw_frame(spark, *records).repartition(5)


def test_a_build_leaves_no_shuffle_file(spark, tmp_path):
    raw = messy(spark)
    before, setting = shuffle_files(spark), spark.conf.get(RELEASE, None)
    etl.build_warehouse(spark, raw, str(tmp_path))
    assert not left_over(spark, before)
    assert spark.conf.get(RELEASE, None) == setting


def test_the_landed_raw_zone_leaves_no_shuffle_file(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    sf = given_tables(spark, str(tmp_path))
    before = shuffle_files(spark)
    assert fixture.raw_zone(spark, sf).inputFiles()
    assert not left_over(spark, before)


def test_the_setting_is_put_back_after_a_failure(spark, conf):
    conf(RELEASE, "false")
    with pytest.raises(GateFailure), released_shuffles(spark):
        assert spark.conf.get(RELEASE) == "true"
        raise GateFailure("refused")
    assert spark.conf.get(RELEASE) == "false"


def test_the_number_of_passes_changes_no_row_key_or_count(spark, tmp_path):
    raw = messy(spark)
    once = etl.build_warehouse(spark, raw, str(tmp_path / "once"), passes=1)
    more = etl.build_warehouse(spark, raw, str(tmp_path / "more"), passes=3)
    assert more.rows == once.rows and more.payload_bytes == once.payload_bytes
    for name in WAREHOUSE:
        assert rows(more.table(name)) == rows(once.table(name)), name
    assert rows(more.audit()) == rows(once.audit())
    assert rows(more.folders()) == rows(once.folders())


def test_passes_cover_each_raw_row_once_and_keep_copies_together(spark, tmp_path):
    raw = messy(spark)
    shares = [etl.share_of_ids(raw, RawColumns(), at, 3) for at in range(3)]
    assert sorted((r for share in shares for r in rows(share)), key=repr) == rows(raw)
    ids = [{r[0] for r in share.select("COLLISION_ID").collect()} for share in shares]
    assert all(ids) and sum(map(len, ids)) == len(set.union(*ids)) == 152
    staged = etl.stage_clean(raw, str(tmp_path), passes=3)
    assert len(staged.parts) == 3 and staged.counts["rows_read"] == 403
    assert sorted((r for part in staged.parts for r in rows(part)), key=repr) == rows(staged.clean)
    assert max(part.count() for part in staged.parts) < staged.clean.count() / 2


def test_ids_that_clash_once_typed_are_found_across_passes(spark, tmp_path):
    spellings = ["7", "07", " 7", "7.0", "+7", "007", "7 ", "0007"]
    raw = raw_frame(spark, *[{"collision_id": text} for text in spellings])
    used = [share for at in range(4) if (share := rows(etl.share_of_ids(raw, RawColumns(), at, 4)))]
    assert len(used) > 1
    with pytest.raises(GateFailure, match="duplicate_ids=1"):
        etl.stage_clean(raw, str(tmp_path), passes=4)


def test_a_pass_without_rows_is_fine(spark, tmp_path):
    built = etl.build_warehouse(spark, raw_frame(spark, {}), str(tmp_path), passes=4)
    assert built.rows["fact_crash"] == built.table("fact_crash").count() == 1
    empty = etl.stage_clean(raw_frame(spark, {}).limit(0), str(tmp_path), passes=2)
    assert empty.clean.count() == 0 and empty.counts["base_rows"] == 0


def test_a_pass_filters_the_lines_before_the_joins(spark, conf, tmp_path):
    """Else each pass would shuffle all lines."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    raw = fixture.raw_records(spark, given_tables(spark, str(tmp_path)))
    plan = etl.share_of_ids(raw, RawColumns(), 1, 4)._jdf.queryExecution().optimizedPlan().toString()
    hashed = [at for at, line in enumerate(plan.splitlines()) if "xxhash64" in line]
    lines = next(at for at, line in enumerate(plan.splitlines()) if "l_orderkey" in line
                 and "Relation" in line)
    assert hashed and hashed[-1] == lines - 1 and "Filter" in plan.splitlines()[lines - 1]


def test_passes_follow_the_size_of_the_lines(spark, monkeypatch, tmp_path):
    assert [passes_for(n) for n in (0, PASS_BYTES - 1, PASS_BYTES, 2 * PASS_BYTES)] == [1, 1, 2, 3]
    assert passes_for(10 ** 15) == MOST_PASSES
    sf = given_tables(spark, str(tmp_path))
    listed = sum(f.stat().st_size for f in os.scandir(f"{sf}/lineitem.parquet")
                 if f.name.endswith(".parquet"))
    assert fixture.build_passes(spark, sf) == 1
    monkeypatch.setattr("casestar.session.PASS_BYTES", listed // 2)
    assert fixture.build_passes(spark, sf) >= 3
    staged = fixture.star(spark, sf)
    assert len(staged.parts) >= 3 and fixture.warehouse(spark, sf).rows["fact_crash"] == 60
    assert fixture.warehouse(spark, sf).table("fact_crash").agg(
        F.countDistinct("collision_id")).first()[0] == 60
    assert fixture.raw_zone(spark, sf).count() == 140


def test_counts_of_passes_add_up_as_whole_numbers():
    big = 10 ** 30
    assert added([{"a": 1, "b": big}, {"a": 2, "b": 1}, {"b": -big}]) == {"a": 3, "b": 1}
    assert added([]) == {}
