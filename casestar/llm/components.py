"""Connected components of links between longs, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casestar.llm.common import staged


def components(edges: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """``node`` and ``root``, the smallest node that it is connected with, for each linked node.

    Each round hooks the larger neighbours of a node to its smallest neighbour, then the smaller
    ones, until nothing changes; the rounds grow with the logarithm of the longest chain. The
    state of a round is written to the shared folder. Null or looping links are ignored.
    """
    now = staged(edges.where(F.col(a) != F.col(b))
                 .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), label)
    mark = _mark(now)
    while mark[0]:
        now = staged(_small_star(_large_star(now)), label)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    # every link is now one from a node to its root
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """What tells two sets of links apart: their number and a sum of hashes."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("w"), F.least("m", "u").alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("w"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    hooked = edges.join(least, F.col("u") == F.col("w"))
    return (hooked.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(hooked.select("u", F.col("m").alias("v")))
            .where(F.col("u") != F.col("v")).distinct())
