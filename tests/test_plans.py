from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from samples import DEFAULTS, raw_frame

from casestar.catalog import fixture, registry
from casestar.catalog.fixture import RULES
from casestar.config import RAW_TO_PUBLISHED
from casestar.operators.facts import build_fact, hot_natural_keys
from casestar.operators.quality import step_audit
from casestar.operators.skew import hot_hashes
from casestar.plans import etl
from casestar.plans import questions as ask
from casestar.plans.ingest import size_shuffles
from casestar.session import scale_settings, shared_folder
from casestar.sources.writers import write_partitioned

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_questions_prune_folders(spark):
    warehouse = fixture.warehouse(spark, SF)
    for frame in (ask.fatality_rates(warehouse, RULES), ask.cyclist_months(warehouse, RULES)):
        assert "PartitionFilters: [isnotnull(partition_year" in plan(frame)


def test_month_question_reads_no_dimension(spark):
    text = plan(ask.cyclist_months(fixture.warehouse(spark, SF), RULES))
    assert "Join" not in text
    assert "ReadSchema: struct<cyclists_injured:int>" in text


def test_questions_read_only_their_columns(spark):
    text = plan(ask.crashes_by_borough(fixture.warehouse(spark, SF)))
    assert "ReadSchema: struct<location_key:bigint>" in text
    assert "ReadSchema: struct<location_key:bigint,borough:string>" in text
    assert "PushedFilters: [IsNotNull(borough)" in text


def test_copies_are_dropped_before_the_shuffle(spark):
    text = plan(etl.unique_records(fixture.raw_zone(spark, SF)))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1


def test_cleaning_shuffles_once(spark):
    assert plan(etl.clean_records(fixture.raw_zone(spark, SF))).count("Exchange") == 1


def test_small_dimensions_join_before_anything_is_shuffled(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(fixture.star(spark, SF).fact(("dim_vehicle", "dim_factor")))
    joins = [line for line in text.splitlines() if "Join" in line and "LeftOuter" in line]
    # printed from the top: the last joins run first
    assert ["SortMergeJoin" in line for line in joins] == [True, True, False, False]


def test_a_hot_natural_key_is_split_in_the_fact_join(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10000")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    # several map tasks, or there is nothing to split a partition by
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.files.openCostInBytes", "0")
    conf("spark.sql.files.maxPartitionBytes", "50000")
    # a third of the records share one location, the rest are spread
    raw = spark.range(0, 60_000, 1, 8).select(*[F.lit(DEFAULTS.get(name)).cast("string").alias(name)
                                                for name in RAW_TO_PUBLISHED], "id")
    raw = raw.withColumns({
        "COLLISION_ID": F.col("id").cast("string"),
        "ZIP CODE": F.when(F.col("id") % 3 > 0, F.col("id").cast("string")),
    }).drop("id")
    star = etl.stage_star(raw, str(tmp_path))
    found = build_fact(star.base(), star.dims, star.keyed)  # hot keys not looked up
    rows = found.collect()
    assert "SortMergeJoin(skew=true)" in plan(found)
    assert sorted(rows) == sorted(star.fact().collect())
    assert len(rows) == len({r.collision_id for r in rows}) == 60_000
    assert len({r.location_key for r in rows}) == 40_001


def test_fact_base_builds_no_dimension(spark, monkeypatch, tmp_path):
    raw = raw_frame(spark, {"borough": " X"}, {"borough": None}, {"collision_id": None},
                    {"crash_date": "13/40/2020"}, {"collision_id": "2", "borough": "Y"})
    monkeypatch.setattr(fixture, "raw_records", lambda spark, sf_dir: raw)
    built = []
    build = etl.build_dimensions
    monkeypatch.setattr(etl, "build_dimensions", lambda *given: built.append(1) or build(*given))
    base = registry.queries()["fact_base"](spark, str(tmp_path))
    rows = sorted(base.collect())
    assert [(row.collision_id, row.j_borough) for row in rows] == [(1, "X"), (2, "UNKNOWN_BOROUGH")]
    assert not built
    star = fixture.star(spark, str(tmp_path))
    assert built == [1]
    assert sorted(star.base().collect()) == rows


def test_dimension_build_sorts_and_shuffles_once_after_the_distinct(spark, tmp_path):
    star = fixture.star(spark, SF)
    dim = star.dims["dim_location"]
    variants = star.clean.select(*dim.sources()).distinct()
    grouped = (variants.select(*dim.natural_columns(), *dim.attributes)
               .repartitionByRange(*dim.natural_names).groupBy(*dim.natural_names)
               .agg(F.min("borough")).sortWithinPartitions(*dim.natural_names))
    assert plan(grouped).count("Exchange") == 2


def test_a_hot_partition_is_split_when_written(spark, conf, tmp_path):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "20000")
    df = spark.range(200_000).select("id", F.when(F.col("id") % 10 < 9, 2020).otherwise(2021)
                                     .alias("partition_year")).repartition(16)
    write_partitioned(df, str(tmp_path / "t"), ["partition_year"])
    assert len(list((tmp_path / "t/partition_year=2020").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_staging_uses_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert fixture.warehouse(spark, SF).path.startswith(folder)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Cluster:
        conf = {}
        sparkContext = type("Context", (), {"master": "yarn", "applicationId": "app"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Cluster)


def test_shuffle_partitions_grow_with_the_data():
    width = "spark.sql.shuffle.partitions"
    assert scale_settings(10**9)[width] == "200"
    assert int(scale_settings(10**12)[width]) == 7451
    assert 40_000 < int(scale_settings(100 * 10**12)[width]) <= 100_000


def test_shuffle_width_follows_the_listing(spark, conf):
    for name, value in scale_settings(0, 8).items():
        conf(name, value)
    size_shuffles(spark, f"{SF}/lineitem.parquet")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    conf("spark.sql.shuffle.partitions", "300")
    size_shuffles(spark, f"{SF}/lineitem.parquet")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "300"


def test_step_audit_reads_key_and_date_only(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("1", "01/02/2020", "x", "y")] * 3,
                          "id string, day string, hour string, street string").write.parquet(path)
    text = plan(step_audit(spark.read.parquet(path), "id", "day", "MM/dd/yyyy"))
    assert "ReadSchema: struct<id:string,day:string>" in text


def half_hot(spark, rows=40_000):
    """Half of the records share one location; the zip of the others is their id."""
    raw = spark.range(0, rows, 1, 8).select(*[F.lit(DEFAULTS.get(name)).cast("string").alias(name)
                                              for name in RAW_TO_PUBLISHED], "id")
    return raw.withColumns({
        "COLLISION_ID": F.col("id").cast("string"),
        "ZIP CODE": F.when(F.col("id") % 2 > 0, F.col("id").cast("string")),
    }).drop("id")


def test_hot_natural_keys_are_spread_without_the_adaptive_planner(spark, conf, tmp_path):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.shuffle.partitions", "16")
    star = etl.stage_star(half_hot(spark), str(tmp_path))
    base = star.base()
    location = {"dim_location": star.dims["dim_location"]}
    hot = hot_natural_keys(base, location, location)
    assert len(hot["dim_location"]) == 1

    def tasks(**options):
        fact = build_fact(base, location, star.keyed, columns=["collision_id", "location_key"],
                          **options)
        assert "SortMergeJoin" in plan(fact)
        sizes = [r["n"] for r in fact.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("*").alias("n")).collect()]
        return fact, sorted(sizes)

    uneven, sizes = tasks()
    assert sizes[-1] > 10 * sizes[len(sizes) // 2]
    even, sizes = tasks(hot=hot)
    assert len(sizes) == 16 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    assert even.exceptAll(uneven).count() == 0 and even.count() == 40_000


def test_hot_key_summary_misses_none_and_is_bounded(spark):
    frame = spark.range(100_000).select(F.when(F.col("id") % 10 < 3, "hot").when(
        F.col("id") % 10 < 5, F.lit(None)).otherwise(F.col("id").cast("string")).alias("a"))
    found = hot_hashes(frame, {"x": ["a"]}, 0.1)["x"]
    wanted = {r.h for r in frame.where("a is null or a = 'hot'").select(
        F.xxhash64("a").alias("h")).distinct().collect()}
    assert set(found) == wanted
    assert hot_hashes(frame.limit(0), {"x": ["a"]}, 0.1) == {"x": []}
    assert hot_hashes(frame, {}, 0.1) == {}
