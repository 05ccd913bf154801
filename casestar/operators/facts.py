"""Fact base, fact build and the broadcast rule."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casestar.config import COUNT_COLUMNS, PARTITION_COLUMNS
from casestar.operators.dimensions import Dimension
from casestar.operators.keys import KeyedTable
from casestar.operators.skew import hot_hashes, key_hash
from casestar.schemas import FACT_CRASH

# A table is broadcast only when its measured rows take no more memory than this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def fits_broadcast(table: KeyedTable, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return table.payload_bytes <= limit


def fact_base(clean: DataFrame, dims: Iterable[Dimension], null_safe: bool = False) -> DataFrame:
    """Measures, flags and partition columns of each clean row, with the natural keys to join on."""
    keys = [column for dim in dims for column in dim.natural_columns(null_safe)]
    return clean.select(
        "collision_id", *keys, *COUNT_COLUMNS,
        "property_damage_only", "injury_count_flagged", *PARTITION_COLUMNS,
    )


def build_fact(base: DataFrame, dims: dict[str, Dimension], keyed: dict[str, KeyedTable],
               null_safe: bool = False, broadcast: Iterable[str] = (),
               columns: list[str] | None = None,
               hot: dict[str, list[int]] | None = None) -> DataFrame:
    """Swap natural keys for surrogate keys with one left join per dimension.

    Names in ``broadcast`` are hinted only if their measured size allows it. Every other join
    shuffles. ``hot`` names the hashes of its hot natural keys (see ``hot_natural_keys``): their
    few dimension rows are broadcast, and the facts that find one there are spread evenly over
    the shuffle, in which they match nothing. What is left to the adaptive planner is small.
    Smaller dimensions go first: they turn wide texts into one number while the rows are
    still in the scan, so the joins that do shuffle carry narrow rows.
    Natural keys are unique in the dimension, so no join can add rows.
    """
    hinted = set(broadcast)
    joined = base
    for name, dim in sorted(dims.items(), key=lambda item: keyed[item[0]].payload_bytes):
        side = keyed[name].frame.select(
            dim.key, *[F.col(n).alias(f"d_{n}") for n in dim.natural_names])
        tests = [F.col(n).eqNullSafe(F.col(f"d_{n}")) if null_safe else F.col(n) == F.col(f"d_{n}")
                 for n in dim.natural_names]
        match, extra = reduce(and_, tests), [f"d_{n}" for n in dim.natural_names]
        if name in hinted and fits_broadcast(keyed[name]):
            joined = joined.join(F.broadcast(side), match, "left").drop(*extra)
        elif hot and hot.get(name):
            joined = _join_with_hot_keys(joined, side, dim, match, extra, hot[name])
        else:
            joined = joined.join(side, match, "left").drop(*extra)
    return joined.select(*(columns or FACT_CRASH.names))


def _join_with_hot_keys(facts: DataFrame, side: DataFrame, dim: Dimension, match: Column,
                        extra: list[str], hashes: list[int]) -> DataFrame:
    found = f"hot_{dim.key}"
    # at most MOST_HOT hashes
    few = side.where(key_hash(f"d_{n}" for n in dim.natural_names).isin(hashes))
    spread = F.when(F.col(found).isNotNull(), F.xxhash64("collision_id")).otherwise(F.lit(0))
    marked = (facts.join(F.broadcast(few.withColumnRenamed(dim.key, found)), match, "left")
              .drop(*extra).withColumn("spread", spread))
    # 0 for every key; a plain literal would be folded out of the join keys
    rest = side.withColumn("d_spread", F.least(F.col(dim.key), F.lit(0)))
    return (marked.join(rest, match & (F.col("spread") == F.col("d_spread")), "left")
            .withColumn(dim.key, F.coalesce(found, dim.key))
            .drop(found, "spread", "d_spread", *extra))


def hot_natural_keys(base: DataFrame, dims: dict[str, Dimension], names: Iterable[str],
                     share: float | None = None) -> dict[str, list[int]]:
    """Hashes of the natural keys with which a shuffled join of these dimensions would be uneven:
    those that own ``share`` of the facts or more, by default what one shuffle partition gets."""
    width = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return hot_hashes(base, {name: dims[name].natural_names for name in names},
                      1 / width if share is None else share)
