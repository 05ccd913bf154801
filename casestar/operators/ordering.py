"""Whether a result is in the order it promises, checked where its rows are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AT, _PART, _KEY = "_at", "_part", "_key"


def order_violations(df: DataFrame, order: list[str]) -> DataFrame:
    """``row_count`` and ``violations``, the rows that stand before their predecessor in ``order``.

    ``order`` names columns, with a leading minus for descending ones; nulls come first in an
    ascending column and last in a descending one, as sorts put them. Each row is compared with
    the one before it in its partition, and the first row of a partition with the last one before
    it: one row per partition meets in one task, never the result.
    """
    names = [name.lstrip("-") for name in order]
    numbered = df.select(F.struct(*[F.col(f"`{n}`").alias(f"k{i}") for i, n in enumerate(names)])
                         .alias(_KEY),
                         F.monotonically_increasing_id().alias(_AT))
    # a row's number holds its partition above this bit
    placed = numbered.withColumn(_PART, F.shiftright(_AT, 33))
    inside = Window.partitionBy(_PART).orderBy(_AT)
    wrong = _stands_after(F.col("_before"), F.col(_KEY), order)
    parts = (placed.withColumn("_before", F.lag(_KEY).over(inside))
             .groupBy(_PART).agg(
                 F.count(F.lit(1)).alias("rows"), F.count_if(wrong).alias("wrong"),
                 F.min_by(_KEY, _AT).alias("_first"), F.max_by(_KEY, _AT).alias("_last")))
    borders = parts.withColumn("_before", F.lag("_last").over(Window.orderBy(_PART)))
    return borders.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        (F.coalesce(F.sum("wrong"), F.lit(0)) + F.count_if(
            _stands_after(F.col("_before"), F.col("_first"), order))).alias("violations"))


def _stands_after(one: Column, other: Column, order: list[str]) -> Column:
    """Whether ``one`` comes after ``other``; false if there is no such row."""
    result = F.lit(False)
    for at in reversed(range(len(order))):
        a, b = one.getField(f"k{at}"), other.getField(f"k{at}")
        if order[at].startswith("-"):
            later = (a.isNull() & b.isNotNull()) | F.coalesce(a < b, F.lit(False))
        else:
            later = (a.isNotNull() & b.isNull()) | F.coalesce(a > b, F.lit(False))
        result = F.when(later, True).when(a.eqNullSafe(b), result).otherwise(False)
    return one.isNotNull() & result
