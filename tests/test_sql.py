"""SQL text with arguments, and folders pruned by a dimension or answered from their names."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import types as T
from samples import raw_frame

from casestar.catalog import fixture
from casestar.operators.quality import partition_summary
from casestar.plans import questions, sql
from casestar.plans.etl import build_warehouse

SF = "/root/testdata/sf0.001"
YEARS = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("tag", T.StringType())])


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name, answer", [
    ("crashes_by_borough", questions.crashes_by_borough),
    ("pedestrian_peak_hours", questions.pedestrian_peak_hours),
    ("severity_by_vehicle", questions.severity_by_vehicle),
    ("cyclist_months", lambda w: questions.cyclist_months(w, fixture.RULES)),
    ("severe_crash_factors", lambda w: questions.severe_crash_factors(w, fixture.RULES)),
])
def test_text_and_frames_answer_alike_and_in_the_same_order(spark, name, answer):
    warehouse = fixture.warehouse(spark, SF)
    wanted = answer(warehouse)
    found = sql.question_sql(warehouse, name, fixture.RULES).select(*wanted.columns)
    assert found.collect() == wanted.collect()
    assert [f.dataType for f in found.schema] == [f.dataType for f in wanted.schema]


def test_arguments_change_a_question_and_are_values_only(spark):
    warehouse = fixture.warehouse(spark, SF)
    odd = "it's; DROP VIEW analytics_base --\" :fatal"
    found = sql.question_sql(warehouse, "severity_by_vehicle", fatal=odd).collect()
    assert {r.crash_severity for r in found} == {odd, "Non-Fatal"}
    rates = sql.question_sql(warehouse, "fatality_rates", fixture.RULES, first_year=1999)
    assert {r.year for r in rates.collect()} == {1999, 2000}


def test_a_filter_on_the_dimension_prunes_folders(spark):
    warehouse = fixture.warehouse(spark, SF)
    days = sql.run_sql(warehouse, sql.SEVERITY_OF_DAYS, first_day=date(1997, 3, 5),
                       last_day=date(1997, 3, 9), fatal_from=1, fatal="x", not_fatal="y")
    assert "dynamicpruning" in plan(days)
    days.collect()
    scan = next(line for line in _metrics(days) if "numPartitions" in line)
    assert scan["numPartitions"] == 1
    year = sql.run_sql(warehouse, "SELECT count(*) FROM analytics_base WHERE year = 1997")
    text = plan(year)
    assert "PartitionFilters" in text and "partition_year#" in text.split("PartitionFilters: [")[1]


def _metrics(frame):
    """The metrics of all scans of a query that has run."""
    found = []

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            visit(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            visit(node.plan())
        if name == "FileSourceScanExec":
            metrics = node.metrics()
            names = [k for k in ("numPartitions", "numFiles") if metrics.contains(k)]
            found.append({k: metrics.apply(k).value() for k in names})
        children = node.children()
        for at in range(children.size()):
            visit(children.apply(at))

    visit(frame._jdf.queryExecution().executedPlan())
    return found


def test_coverage_comes_from_the_listing(spark):
    warehouse = fixture.warehouse(spark, SF)
    folders = warehouse.folders()
    text = plan(folders).lower()
    assert "binaryfile" in text and "parquet" not in text.replace(warehouse.path, "")
    fact = warehouse.table("fact_crash").select("partition_year", "partition_month")
    assert folders.collect() == fact.distinct().orderBy(*fact.columns).collect()
    assert folders.schema.simpleString() == "struct<partition_year:int,partition_month:int>"


def test_odd_names_nulls_and_empty_folders(spark, tmp_path):
    path = str(tmp_path / "year=1" / "t")  # a folder above the table may look like one of its own
    rows = [(1, "a b"), (1, "x/y=%"), (None, "c+d"), (2, None), (2, "é")]
    spark.createDataFrame(rows, "year int, tag string").selectExpr("1 as v", "*").write.partitionBy(
        "year", "tag").parquet(path)
    (tmp_path / "year=1/t/year=9/tag=empty").mkdir(parents=True)
    assert {tuple(r) for r in partition_summary(spark, path, YEARS).collect()} == set(rows)


def test_a_flat_fact_has_no_folders(spark, tmp_path):
    flat = build_warehouse(spark, raw_frame(spark, {}), str(tmp_path), partition_by=())
    with pytest.raises(Exception, match="not partitioned by partition_year"):
        flat.folders().collect()
