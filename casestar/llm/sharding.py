"""Sharding by Karmarkar-Karp differencing over indivisible groups of equal texts.

Method. A partial partition holds one sum per shard. It starts with one item in one shard; then
the two partial partitions with the largest spread (largest minus smallest sum) are combined,
the largest sums of one with the smallest of the other, until one is left.

What is differenced is bounded: a group of at least 1/``items`` of all bytes is an item of its
own (there are at most ``items`` of them), all smaller groups share ``items`` hash bins. One
task combines these at most ``2 * items`` items whatever the corpus size; the bins are so fine
that the shards still end within a fraction of a bin of each other. A group larger than a
shard's fair share takes a shard of its own, and the others share the rest.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casestar.llm.common import running_start, staged

ROW_BYTES = 8


def differenced(sizes: list[int], shards: int) -> list[int]:
    """The shard of each item, by largest differencing over ``shards`` sums."""
    # a partial partition: sums in falling order, and for each sum the items below it, as a tree
    heap = [(-size, number, [size] + [0] * (shards - 1), [(number,)] + [()] * (shards - 1))
            for number, size in enumerate(sizes)]
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, sums, trees = heapq.heappop(heap)
        _, _, more, others = heapq.heappop(heap)
        both = sorted(((s + m, t, o) for s, m, t, o in
                       zip(sums, reversed(more), trees, reversed(others))),
                      key=lambda x: -x[0])
        sums = [x[0] for x in both]
        trees = [(t, o) if t and o else t or o for _, t, o in both]
        heapq.heappush(heap, (sums[-1] - sums[0], order, sums, trees))
        order += 1
    placed = [0] * len(sizes)
    for shard, tree in enumerate(heap[0][3] if heap else []):
        stack = [tree]
        while stack:
            top = stack.pop()
            if len(top) == 2:
                stack += top
            elif top:
                placed[top[0]] = shard
    return placed


def balanced_shards(docs: DataFrame, shards: int = 24, items: int = 32_768,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size`` (UTF-8 bytes of the text plus 8; a null
    text has none), ``text_crc32`` (of a null text: 0), ``shard`` and ``slot``, the row's place
    in its shard without gaps; and the columns of ``docs`` in ``keep``, each with its own row.

    Equal texts share a shard, null texts too. Rows that repeat take a slot each. Null ids sort
    first. Other columns are ignored. Kept columns are joined back by a row number at the end,
    so they are shuffled once.
    """
    text = F.col("text").cast("binary")
    rows = staged(docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long")
        .alias("size"), F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("_group"),
        F.monotonically_increasing_id().alias("_row"),
        *[F.col(f"`{name}`").alias(f"_keep_{name}") for name in keep]), "sized")
    kept = rows.select("_row", *[F.col(f"_keep_{name}").alias(name) for name in keep])
    rows = rows.drop(*[f"_keep_{name}" for name in keep])
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_bytes"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    item = F.when(F.col("_bytes") * items >= F.lit(total).cast("decimal(38,0)"),
                  F.struct(F.lit(1).alias("own"), F.col("_group").alias("key"))).otherwise(
        F.struct(F.lit(0).alias("own"), F.pmod(F.xxhash64("_group"), F.lit(items)).alias("key")))
    grouped = staged(groups.withColumn("_item", item), "groups")

    def combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [f for f in frames if len(f)]
        if frames:
            found = pd.concat(frames).sort_values(["bytes", "own", "key"],
                                                  ascending=[False, True, True])
            found["shard"] = differenced(found["bytes"].tolist(), shards)
            yield found[["own", "key", "shard"]]

    # at most 2 * items rows meet here
    placed = staged(
        grouped.groupBy("_item").agg(F.sum("_bytes").alias("bytes"))
        .select("_item.own", "_item.key", "bytes").repartition(1)
        .mapInPandas(combine, "own int, key long, shard int"), "items")
    by_group = grouped.join(
        F.broadcast(placed), (F.col("_item.own") == F.col("own"))
        & (F.col("_item.key") == F.col("key"))).select("_group", "shard")
    sharded = rows.join(by_group, "_group").select("doc_id", "size", "text_crc32", "shard", "_row",
                                                   F.lit(1).alias("_one"))
    placed_rows = running_start(sharded, ["shard"], ["doc_id", "text_crc32", "size", "_row"],
                                "_one", "slot").drop("_one")
    if keep:
        placed_rows = placed_rows.join(kept, "_row")
    return placed_rows.drop("_row")
