"""Dense surrogate keys without a single-partition sort."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casestar.functions import text_bytes

# monotonically_increasing_id() holds the partition number above this bit, the row number below
ROW_BITS = 33
_SLOT = "_slot"


@dataclass(frozen=True)
class KeyedTable:
    """A staged table with its dense key, and its exact size."""

    frame: DataFrame
    rows: int
    payload_bytes: int


def assign_dense_key(df: DataFrame, order_cols, key: str, stage_path: str) -> KeyedTable:
    """Number the rows 1..n in the order of ``order_cols``, which have to be unique."""
    return number_ranged(df.repartitionByRange(*order_cols), order_cols, key, stage_path)


def number_ranged(df: DataFrame, order_cols, key: str, stage_path: str) -> KeyedTable:
    """As ``assign_dense_key``, for a frame that is range-partitioned by ``order_cols`` already.

    Range partitions are written once with each row's place in its partition. Partition
    boundaries are sampled and could move if the plan ran again, so the rest only ever reads
    that written table. The offsets are summed over a small table of one row per partition; only
    the two totals come back to the driver.
    """
    spark = df.sparkSession
    placed = df.sortWithinPartitions(*order_cols).withColumn(_SLOT, F.monotonically_increasing_id())
    placed.write.mode("overwrite").parquet(stage_path)
    staged = spark.read.schema(placed.schema).parquet(stage_path)

    part = F.shiftright(_SLOT, ROW_BITS)
    texts = [F.col(f.name) for f in df.schema if isinstance(f.dataType, T.StringType)]
    counted = staged.groupBy(part.alias("_part")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(text_bytes(texts)).alias("text"))
    counted.write.mode("overwrite").parquet(f"{stage_path}_parts")
    parts = spark.read.schema(counted.schema).parquet(f"{stage_path}_parts")
    none = F.lit(0).cast("long")
    total = parts.agg(F.coalesce(F.sum("rows"), none).alias("rows"),
                      F.coalesce(F.sum("text"), none).alias("text")).first()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("rows").over(before), none).alias("_offset"))
    # 16 bytes per partition of the range shuffle
    keyed = (staged.withColumn("_part", part)
             .join(F.broadcast(offsets), "_part")
             .withColumn(key, F.col("_offset") + F.col(_SLOT).bitwiseAND((1 << ROW_BITS) - 1) + 1)
             .select(key, *df.columns))
    # every field takes 8 bytes in a row, texts come on top, rounded up to 8
    per_row = 16 + 8 * (len(df.columns) + 1) + 8 * len(texts)
    return KeyedTable(keyed, total.rows, total.rows * per_row + total.text)
