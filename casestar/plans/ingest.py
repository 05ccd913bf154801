"""Checks on a raw file and its landing in the raw zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.config import RawColumns
from casestar.operators.quality import file_audit
from casestar.session import scale_settings
from casestar.sources.landing import land_observed, raw_lines
from casestar.sources.readers import read_raw_csv


class RejectedFile(RuntimeError):
    """A raw file that failed a required check."""


def size_shuffles(spark: SparkSession, path: str) -> None:
    """Fit the session's scan pieces and shuffle width to the bytes below ``path``. More shuffle
    partitions than that stay as they are set. Only the listing is read."""
    total = file_audit(spark, path).agg(F.coalesce(F.sum("size_bytes"), F.lit(0))).first()[0]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, value in scale_settings(total, least).items():
        spark.conf.set(name, value)


def validate_raw(spark: SparkSession, path: str, columns: RawColumns = RawColumns(),
                 key: str = "COLLISION_ID") -> DataFrame:
    """One row per check: name, observed value, verdict, and whether a failure rejects the file.

    Extension and required columns reject. Size, shape, encoding and duplicate keys are
    reported only. The lines are read once, for their encoding and as records.
    """
    raw = raw_lines(spark, path)
    header = F.col("value") == F.lit(raw.header)
    named = raw.parsed()[key] if key in raw.names else F.lit(None).cast("string")
    by_key = raw.lines.groupBy(F.when(raw.is_filled(), named).alias("key")).agg(
        F.count_if(raw.is_filled()).alias("filled"),
        F.count_if(header).alias("headers"),
        F.count_if(~F.is_valid_utf8("value")).alias("broken"))
    # one header line per file is no record; further lines like it are
    copies = F.col("filled") - F.when(F.col("headers") < raw.files, F.col("headers")).otherwise(
        raw.files)
    profile = by_key.withColumn("copies", copies).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.greatest(F.col("copies") - 1, F.lit(0))), F.lit(0)).alias(
            "duplicate_rows"),
        F.coalesce(F.sum("broken"), F.lit(0)).alias("broken"))
    return _file_checks(_listing(spark, path), profile, raw.names, columns, key)


def _listing(spark: SparkSession, path: str) -> DataFrame:
    return file_audit(spark, path).agg(
        F.count_if(~F.col("is_accepted")).alias("refused"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size"))


def _file_checks(files: DataFrame, profile: DataFrame, names: list[str], columns: RawColumns,
                 key: str) -> DataFrame:
    absent = [name for name in columns.required if name not in names]
    copies, broken = F.col("duplicate_rows"), F.col("broken")
    unique = [("duplicate keys", copies, copies == 0, False)] if key in names else []
    return _checks(files,
                   ("files with another extension", F.col("refused"), F.col("refused") == 0, True),
                   ("bytes", F.col("size"), F.lit(True), False)).unionByName(_checks(
        profile,
        ("rows", F.col("row_count"), F.col("row_count") > 0, False),
        ("columns", F.lit(len(names)), F.lit(True), False),
        ("required columns missing", F.lit(len(absent)), F.lit(not absent), True), *unique,
        ("lines that are not UTF-8", broken, broken == 0, False)))


def _checks(metrics: DataFrame, *checks) -> DataFrame:
    """Several checks on one row of metrics, so the input behind it is read once."""
    rows = [F.struct(F.lit(name).alias("check_name"), observed.cast("bigint").alias("observed"),
                     passed.alias("passed"), F.lit(required).alias("is_required"))
            for name, observed, passed, required in checks]
    return metrics.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def ingest(spark: SparkSession, path: str, raw_zone: str,
           columns: RawColumns = RawColumns()) -> DataFrame:
    """Check, land and verify: the report of ``ingest_checked``."""
    return ingest_checked(spark, path, raw_zone, columns)[0]


def ingest_checked(spark: SparkSession, path: str, raw_zone: str,
                   columns: RawColumns = RawColumns(),
                   key: str = "COLLISION_ID") -> tuple[DataFrame, DataFrame]:
    """The landing report and the checks of ``validate_raw``, from one scan of the source.

    Raises before landing if a required check fails; those need the listing and the header only.
    """
    names = read_raw_csv(spark, path).columns
    files = _listing(spark, path).first()
    failed = ["files with another extension"] * bool(files.refused)
    failed += ["required columns missing"] * any(n not in names for n in columns.required)
    if failed:
        raise RejectedFile(f"{path}: " + ", ".join(failed))
    landed = land_observed(spark, path, raw_zone, key)
    listing = spark.createDataFrame([files], "refused bigint, size bigint")
    profile = spark.createDataFrame(
        [(landed.source["rows"], landed.landed.get("duplicate_rows", 0),
          landed.source["broken_lines"])],
        "row_count bigint, duplicate_rows bigint, broken bigint")
    return landed.report(spark), _file_checks(listing, profile, names, columns, key)
