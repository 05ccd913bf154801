"""Raw incident records derived from the given tables, and the places queries share.

Every order line becomes one raw text record with planted nulls, blanks, padded texts,
duplicate ids and malformed values, spread by arithmetic on the keys.
"""

from __future__ import annotations

import hashlib
import uuid
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.config import RAW_TO_PUBLISHED, QuestionRules, RawColumns
from casestar.operators.dimensions import build_dimension
from casestar.operators.keys import KeyedTable
from casestar.operators.quality import file_audit
from casestar.plans.etl import (
    StagedClean,
    StagedStar,
    publish_star,
    share_of_ids,
    stage_clean,
    stage_dimensions,
)
from casestar.schemas import RAW
from casestar.session import passes_for, released_shuffles, shared_folder
from casestar.sources.readers import read_table
from casestar.sources.warehouse import Warehouse
from casestar.sources.writers import write_table

# the driver tables cover 1995 to 2001
RULES = QuestionRules(rate_years=(1996, 2000), trend_first_year=1995, period_split_year=1998)

_lock = Lock()
_built: dict[tuple, object] = {}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table. Orders meet customers before they meet lines, so only orders are shuffled
    for it, and each join carries just the columns the record needs. Lines and orders grow
    together, so neither is a side to broadcast: they merge, and a hot key is split there."""
    customers = (
        given(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        .join(given(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"),
              F.col("c_nationkey") == F.col("n_nationkey"))
        .join(given(spark, sf_dir, "region").select("r_regionkey", "r_name"),
              F.col("n_regionkey") == F.col("r_regionkey"))
    )
    orders = (given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
              .join(customers, F.col("o_custkey") == F.col("c_custkey")))
    lines = (given(spark, sf_dir, "lineitem")
             .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
             .join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
             .join(given(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size"),
                   F.col("l_partkey") == F.col("p_partkey"))
             .join(given(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
                   F.col("l_suppkey") == F.col("s_suppkey")))
    return lines.select(*[text.cast("string").alias(name)
                          for name, text in _record_columns().items()])


def _record_columns() -> dict[str, Column]:
    part, supplier, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    day, name, priority = F.col("l_shipdate"), F.col("s_name"), F.col("o_orderpriority")

    def every(number: Column, step: int, rest: int = 0) -> Column:
        return number % step == rest

    def padded(number: Column) -> Column:
        return F.lpad(number.cast("string"), 2, "0")

    def unless(test: Column, value: Column, instead=None) -> Column:
        return F.when(test, F.lit(instead)).otherwise(value)

    def late_line(value: Column) -> Column:
        return unless(line <= 4, value.cast("string"), "0")

    ident = (F.col("l_orderkey") * 10 + line).cast("string")
    columns = {name: F.lit(None) for name in RAW_TO_PUBLISHED}
    columns |= {name: F.lit("0") for name in RAW_TO_PUBLISHED if name.startswith("NUMBER OF")}
    columns |= {
        "COLLISION_ID": unless(every(part, 997, 1), unless(every(part, 991, 2), ident, "  ")),
        "CRASH DATE": unless(every(part, 499, 3), F.concat_ws(
            "/", padded(F.month(day)), padded(F.dayofmonth(day)), F.year(day).cast("string")),
            "2000-01-15"),
        "CRASH TIME": unless(every(part, 101, 4), F.concat_ws(
            ":", (part % 24).cast("string"), padded(supplier % 60))),
        "BOROUGH": unless(every(part, 13), F.col("r_name")),
        "ZIP CODE": F.col("c_nationkey"),
        "ON STREET NAME": unless(every(supplier, 11), F.when(
            every(supplier, 5), F.concat(F.lit(" "), name, F.lit(" "))).otherwise(name)),
        "LATITUDE": unless(every(part, 17), unless(every(part, 19), unless(
            every(part, 223, 6), F.concat(F.lit("40."), padded(30 + part % 70)), "n/a"), "0"), "0.0"),
        "LONGITUDE": unless(every(part, 17),
                            F.concat(F.lit("-73."), padded(60 + supplier % 40)), "0.0"),
        "NUMBER OF PERSONS INJURED": unless(every(part, 211, 5), unless(
            every(part, 227, 3), late_line(F.col("l_quantity").cast("int") % 26), "3.0")),
        "NUMBER OF PERSONS KILLED": F.when(every(part, 50, 7), "1").otherwise("0"),
        "NUMBER OF PEDESTRIANS INJURED": late_line(supplier % 3),
        "NUMBER OF CYCLIST INJURED": unless(every(part, 223, 6),
                                            late_line((part + supplier) % 4), "n/a"),
        "VEHICLE TYPE CODE 1": unless(every(part, 29), F.col("p_type")),
        "VEHICLE TYPE CODE 2": unless(every(F.col("p_size"), 3), F.col("p_brand")),
        "CONTRIBUTING FACTOR VEHICLE 1": F.when(
            every(supplier, 7), F.concat(F.lit(" "), priority)).otherwise(priority),
        "CONTRIBUTING FACTOR VEHICLE 2": unless(every(F.col("o_orderkey"), 2),
                                                F.col("c_mktsegment")),
    }
    return columns


def work_path(spark: SparkSession, sf_dir: str, label: str = "") -> str:
    """The shared place of this application for one input folder."""
    source = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
    path = f"{shared_folder(spark)}/casestar/{spark.sparkContext.applicationId}/{source}"
    return f"{path}/{label}" if label else path


def scratch_path(spark: SparkSession, sf_dir: str, label: str) -> str:
    """A place nothing was written to before."""
    return work_path(spark, sf_dir, f"{label}-{uuid.uuid4().hex}")


def _once(spark: SparkSession, sf_dir: str, label: str, build):
    """Build a shared table once per application and input folder."""
    place = (spark.sparkContext.applicationId, sf_dir, label)
    with _lock:
        if place not in _built:
            _built[place] = build()
        return _built[place]


def raw_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table as landed: written once per application, for the queries on raw records."""
    def land() -> str:
        path = scratch_path(spark, sf_dir, "raw_zone")
        raw, passes = raw_records(spark, sf_dir), build_passes(spark, sf_dir)
        with released_shuffles(spark):
            for at in range(passes):
                write_table(share_of_ids(raw, RawColumns(), at, passes), path,
                            mode="append" if at else "overwrite")
        return path

    return read_table(spark, _once(spark, sf_dir, "raw_zone", land), RAW)


def raw_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table for the build: as landed if a query asked for the raw zone before, else
    straight from the joins, so its text columns are not written only to be read back."""
    landed = (spark.sparkContext.applicationId, sf_dir, "raw_zone") in _built
    return raw_zone(spark, sf_dir) if landed else raw_records(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> StagedClean:
    """The clean table alone, staged once per application."""
    raw = raw_once(spark, sf_dir)
    return _once(spark, sf_dir, "cleaned", lambda: stage_clean(
        raw, work_path(spark, sf_dir, "warehouse"), passes=build_passes(spark, sf_dir)))


def build_passes(spark: SparkSession, sf_dir: str) -> int:
    """From the listed bytes of the lines, the largest table under the raw one; 1 without them."""
    try:
        lines = file_audit(spark, f"{sf_dir}/lineitem.parquet")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 1
    with released_shuffles(spark):
        return passes_for(lines.agg(F.coalesce(F.sum("size_bytes"), F.lit(0))).first()[0])


def star(spark: SparkSession, sf_dir: str) -> StagedStar:
    """Clean table and dimensions, staged once per application."""
    table = cleaned(spark, sf_dir)
    return _once(spark, sf_dir, "star",
                 lambda: stage_dimensions(table, work_path(spark, sf_dir, "warehouse")))


def null_safe_location(spark: SparkSession, sf_dir: str) -> KeyedTable:
    """The location dimension with null kept as a value, staged once per application."""
    staged = star(spark, sf_dir)
    return _once(spark, sf_dir, "null_safe_location", lambda: build_dimension(
        staged.clean, staged.dims["dim_location"],
        scratch_path(spark, sf_dir, "null_safe_location"), null_safe=True))


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The published warehouse, built once per application by the library's own ETL."""
    staged = star(spark, sf_dir)
    return _once(spark, sf_dir, "warehouse",
                 lambda: publish_star(staged, work_path(spark, sf_dir, "warehouse")))
