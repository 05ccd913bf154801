"""The published warehouse: five Parquet tables under one version folder, and a manifest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casestar.config import PARTITION_COLUMNS
from casestar.operators.dimensions import PublishedDimension
from casestar.operators.facts import BROADCAST_LIMIT_BYTES
from casestar.operators.quality import partition_summary
from casestar.schemas import WAREHOUSE

MANIFEST = T.StructType([
    T.StructField("published_at", T.LongType()),
    T.StructField("version", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("payload_bytes", T.LongType()),
])

AUDIT = T.StructType([
    T.StructField("section", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("observed", T.LongType()),
])


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    path: str
    rows: dict[str, int]
    payload_bytes: dict[str, int]
    broadcast_limit: int = BROADCAST_LIMIT_BYTES

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(WAREHOUSE[name]).parquet(f"{self.path}/{name}")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in WAREHOUSE}

    def dimension(self, name: str) -> PublishedDimension:
        return PublishedDimension(self.table(name),
                                  self.payload_bytes.get(name, self.broadcast_limit + 1))

    def folders(self, columns=PARTITION_COLUMNS) -> DataFrame:
        """The folders of the fact that hold rows, from the listing alone."""
        schema = T.StructType([WAREHOUSE["fact_crash"][name] for name in columns])
        return partition_summary(self.spark, f"{self.path}/fact_crash", schema)

    def audit(self) -> DataFrame:
        """What the build counted while it wrote: ``section``, ``item``, ``observed``."""
        return self.spark.read.schema(AUDIT).json(f"{self.path}/audit")

    def fits_broadcast(self, name: str) -> bool:
        """By the size measured when the table was built; an unmeasured table does not fit."""
        return self.payload_bytes.get(name, self.broadcast_limit + 1) <= self.broadcast_limit

    def facts_per_row(self, name: str) -> float:
        return self.rows.get("fact_crash", 0) / max(self.rows.get(name, 0), 1)

    def join_side(self, name: str) -> DataFrame:
        table = self.table(name)
        return F.broadcast(table) if self.fits_broadcast(name) else table


def publish(warehouse: Warehouse, root: str, version: str, published_at: int) -> None:
    """Make a version visible. Readers follow the manifest, so they never see half a build."""
    rows = [(published_at, version, name, count, warehouse.payload_bytes.get(name))
            for name, count in warehouse.rows.items()]
    (warehouse.spark.createDataFrame(rows, MANIFEST).coalesce(1)
     .write.mode("append").json(f"{root}/manifest"))


def latest_warehouse(spark: SparkSession, root: str) -> Warehouse | None:
    """The version published last, or None before the first one."""
    try:
        return open_warehouse(spark, root)
    except FileNotFoundError:
        return None


def open_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """The version published last under ``root``."""
    try:
        entries = spark.read.schema(MANIFEST).json(f"{root}/manifest")
        latest = entries.agg(F.max(F.struct("published_at", "version")).alias("m")).first().m
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        latest = None
    if latest is None:
        raise FileNotFoundError(f"nothing published under {root}")
    # five rows per version
    tables = entries.filter(F.col("version") == latest.version).collect()
    return Warehouse(
        spark, f"{root}/{latest.version}",
        rows={t.table_name: t.row_count for t in tables},
        payload_bytes={t.table_name: t.payload_bytes for t in tables if t.payload_bytes is not None},
    )
