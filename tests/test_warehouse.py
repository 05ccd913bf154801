from __future__ import annotations

import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from samples import raw_frame

from casestar.catalog import fixture
from casestar.operators.facts import fits_broadcast
from casestar.operators.keys import KeyedTable, assign_dense_key
from casestar.operators.quality import GateFailure
from casestar.operators.rollup import FOREIGN_KEYS, star_base
from casestar.plans import etl
from casestar.plans.etl import build_warehouse
from casestar.schemas import WAREHOUSE
from casestar.sources.warehouse import open_warehouse

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dense_keys_do_not_depend_on_partitioning(spark, conf, tmp_path):
    values = [(None, "x")] + [(n, t) for n in range(700) for t in ("a", None)]
    random.Random(1).shuffle(values)
    wanted = {v: i for i, v in enumerate(
        sorted(values, key=lambda v: (v[0] is not None, v[0] or 0, v[1] is not None, v[1] or "")), 1)}
    for parts in ("1", "3", "7"):
        conf("spark.sql.shuffle.partitions", parts)
        df = spark.createDataFrame(values, "n int, t string").repartition(5)
        table = assign_dense_key(df, ["n", "t"], "key", str(tmp_path / parts))
        assert table.rows == len(values)
        assert {(r.n, r.t): r.key for r in table.frame.collect()} == wanted


def test_an_empty_dimension_has_no_keys(spark, tmp_path):
    empty = spark.createDataFrame([], "n int, t string")
    table = assign_dense_key(empty, ["n"], "key", str(tmp_path / "empty"))
    assert (table.rows, table.payload_bytes, table.frame.count()) == (0, 0, 0)


def test_payload_counts_every_text_byte(spark, tmp_path):
    df = spark.createDataFrame([(1, "x" * 1000), (2, None), (3, "é" * 10)], "n int, t string")
    table = assign_dense_key(df, ["n"], "key", str(tmp_path / "sized"))
    assert table.payload_bytes >= 1020 + 3 * 3 * 8
    assert fits_broadcast(table, limit=table.payload_bytes)
    assert not fits_broadcast(table, limit=table.payload_bytes - 1)


def test_same_warehouse_from_other_partitioning_and_order(spark, conf, tmp_path):
    raw = fixture.raw_zone(spark, SF)
    first = build_warehouse(spark, raw, str(tmp_path / "a"))
    conf("spark.sql.shuffle.partitions", "3")
    conf("spark.sql.adaptive.enabled", "false")
    second = build_warehouse(spark, raw.repartition(11), str(tmp_path / "b"), partition_by=(),
                             broadcast=())
    for name in WAREHOUSE:
        assert rows(first.table(name)) == rows(second.table(name)), name


def test_invariants(spark):
    warehouse = fixture.warehouse(spark, SF)
    clean = fixture.star(spark, SF).clean
    fact = warehouse.table("fact_crash")
    assert fact.count() == clean.count() == 4538
    assert (clean.agg(F.sum("persons_injured"), F.sum("persons_killed")).first()
            == fact.agg(F.sum("persons_injured"), F.sum("persons_killed")).first()
            == star_base(warehouse).agg(F.sum("persons_injured"), F.sum("persons_killed")).first())
    for name, key in FOREIGN_KEYS.items():
        dim = warehouse.table(name)
        assert dim.filter(F.col(key).isNull()).count() == 0
        assert fact.join(dim, key, "left_anti").count() == 0
        assert dim.join(fact, key, "left_anti").count() == 0
    assert len(star_base(warehouse).columns) == 35


@pytest.mark.parametrize("sf, facts, dates, places, vehicles, factors", [
    ("0.001", 4538, 4516, 3101, 97, 30), ("0.01", 45648, 45310, 30842, 179, 30)])
def test_expected_sizes(spark, sf, facts, dates, places, vehicles, factors):
    assert fixture.warehouse(spark, f"/root/testdata/sf{sf}").rows == {
        "fact_crash": facts, "dim_date": dates, "dim_location": places,
        "dim_vehicle": vehicles, "dim_factor": factors}


def test_padded_text_shares_a_row_and_blank_is_not_missing(spark, tmp_path):
    raw = raw_frame(spark, {"borough": " X"}, {"borough": "X"}, {"borough": "  "}, {"borough": None})
    warehouse = build_warehouse(spark, raw, str(tmp_path))
    found = {r.collision_id: r for r in star_base(warehouse, ["dim_location"], [
        "collision_id", "location_key", "borough"]).collect()}
    assert found[1].location_key == found[2].location_key
    assert found[1].borough == " X"
    assert found[3].borough == "  " and found[4].borough is None
    assert found[3].location_key != found[4].location_key


def test_a_failed_gate_leaves_the_earlier_version_readable(spark, tmp_path):
    root = str(tmp_path)
    build_warehouse(spark, raw_frame(spark, {}, {}), root)
    # two texts, one number: both survive as ids and clash once cast
    clash = raw_frame(spark, {"collision_id": "1"}, {"collision_id": " 1"}, {"collision_id": "x"})
    with pytest.raises(GateFailure, match="null_collision_id=1.*duplicate_ids"):
        build_warehouse(spark, clash, root)
    assert open_warehouse(spark, root).table("fact_crash").count() == 2


def test_latest_version_wins(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        open_warehouse(spark, root)
    build_warehouse(spark, raw_frame(spark, {}), root)
    newest = build_warehouse(spark, raw_frame(spark, {}, {}, {}), root)
    opened = open_warehouse(spark, root)
    assert opened.path == newest.path and opened.rows == newest.rows
    assert opened.payload_bytes == newest.payload_bytes


def test_unmeasured_tables_are_not_broadcast(spark):
    warehouse = fixture.warehouse(spark, SF)
    assert warehouse.fits_broadcast("dim_factor")
    assert not warehouse.fits_broadcast("fact_crash")
    assert not fits_broadcast(KeyedTable(None, 1, 10), limit=9)


def test_a_rebuild_keeps_the_keys_it_published(spark, tmp_path):
    root = str(tmp_path)
    first = build_warehouse(spark, raw_frame(
        spark, {"borough": "M"}, {"borough": " Z"}, {"borough": None, "crash_time": None}), root,
        keep_keys=True)
    # A comes before M and Z, an earlier spelling of Z turns up, the null borough is gone
    more = raw_frame(spark, {"borough": "A"}, {"borough": "  Z"}, {"borough": "M"},
                     {"borough": "Q", "crash_date": "01/01/1999"})
    second = build_warehouse(spark, more, root, keep_keys=True)
    for name, key in FOREIGN_KEYS.items():
        old = rows(first.table(name))
        assert set(old) <= set(rows(second.table(name))), name
        keys = sorted(r[key] for r in second.table(name).select(key).collect())
        assert keys == list(range(1, second.rows[name] + 1)), name
    places = {r.borough: r.location_key for r in second.table("dim_location").collect()}
    assert places == {"M": 1, None: 2, " Z": 3, "A": 4, "Q": 5}
    found = {r.collision_id: (r.location_key, r.borough) for r in star_base(
        second, ["dim_location"], ["collision_id", "location_key", "borough"]).collect()}
    assert found == {1: (4, "A"), 2: (3, " Z"), 3: (1, "M"), 4: (5, "Q")}
    assert second.payload_bytes["dim_location"] > first.payload_bytes["dim_location"]
    # without the option the keys follow the data alone
    fresh = build_warehouse(spark, more, root)
    assert {r.borough: r.location_key for r in fresh.table("dim_location").collect()} == {
        "A": 1, "M": 2, "Q": 3, "  Z": 4}


def test_a_rebuild_of_the_same_records_changes_no_key(spark, conf, tmp_path):
    raw = fixture.raw_zone(spark, SF)
    first = build_warehouse(spark, raw, str(tmp_path), keep_keys=True)
    conf("spark.sql.shuffle.partitions", "3")
    second = build_warehouse(spark, raw.repartition(5), str(tmp_path), keep_keys=True)
    for name in WAREHOUSE:
        assert rows(first.table(name)) == rows(second.table(name)), name


def given_tables(spark, folder: str) -> str:
    """Twenty orders in the columns the raw records are made of. Part 1 makes a record without an
    id, part 2 a blank one, part 3 a malformed date, part 4 a copy of the id of part 0."""
    tables = {
        "region": ([(0, "ASIA")], "r_regionkey bigint, r_name string"),
        "nation": ([(0, 0)], "n_nationkey bigint, n_regionkey bigint"),
        "customer": ([(0, 0, "M")], "c_custkey bigint, c_nationkey bigint, c_mktsegment string"),
        "orders": ([(o, 0, "1-URGENT") for o in range(20)],
                   "o_orderkey bigint, o_custkey bigint, o_orderpriority string"),
        "part": ([(p, f"t{p}", "b", p) for p in range(7)],
                 "p_partkey bigint, p_type string, p_brand string, p_size int"),
        "supplier": ([(s, f"s{s}") for s in range(3)], "s_suppkey bigint, s_name string"),
        "lineitem": ([(o, p, (o + p) % 3, p % 4, 5.0, date(1996, 1, 1 + o)) for o in range(20)
                      for p in range(7)],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                     "l_quantity double, l_shipdate date"),
    }
    for name, (values, schema) in tables.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_the_warehouse_needs_no_landed_raw_zone(spark, tmp_path):
    sf = given_tables(spark, str(tmp_path / "alone"))
    alone = fixture.warehouse(spark, sf)
    assert not [f for f in os.listdir(fixture.work_path(spark, sf)) if f.startswith("raw_zone")]
    sf = given_tables(spark, str(tmp_path / "after"))
    landed = fixture.raw_zone(spark, sf)
    assert "raw_zone" in fixture.raw_once(spark, sf).inputFiles()[0]
    assert (landed.count(), alone.rows["fact_crash"]) == (140, 60)
    after = fixture.warehouse(spark, sf)
    for name in WAREHOUSE:
        assert rows(alone.table(name)) == rows(after.table(name)), name
    assert rows(alone.audit()) == rows(after.audit())


def test_ids_are_checked_again_only_if_typing_respells_them(spark, tmp_path, monkeypatch):
    checked, check = [], etl.check_ids
    monkeypatch.setattr(etl, "check_ids", lambda clean: checked.append(1) or check(clean))
    plain = raw_frame(spark, {"collision_id": "7"}, {"collision_id": "7"}, {"collision_id": "-8"})
    assert etl.stage_clean(plain, str(tmp_path)).clean.count() == 2 and not checked
    spelled = raw_frame(spark, {"collision_id": "07"}, {"collision_id": "8"})
    assert etl.stage_clean(spelled, str(tmp_path)).clean.count() == 2 and len(checked) == 1
    for text in ("07", " 7", "7.0", "+7"):
        with pytest.raises(GateFailure, match="duplicate_ids=1"):
            etl.stage_clean(raw_frame(spark, {"collision_id": "7"}, {"collision_id": text}),
                            str(tmp_path))
    with pytest.raises(GateFailure, match="null_collision_id=1"):
        etl.stage_clean(raw_frame(spark, {"collision_id": "x"}), str(tmp_path))
    assert len(checked) == 6
