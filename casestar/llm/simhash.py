"""SimHash near-duplicates: fingerprints, a grid over per-segment bit counts, exact links.

Method. A fingerprint of 64 bits is embedded as the bit counts of its 32 segments of two bits.
The Manhattan distance of two embeddings is a lower bound of the Hamming distance, so a pair
within ``max_bits`` bits is within ``max_bits`` there too. The grid join: the 32 dimensions are
cut into ``blocks`` blocks; at most ``max_bits`` of them can differ, hence any such pair falls
into the same cell of at least one choice of ``blocks - max_bits`` blocks. The pairs of a cell
are filtered by the Manhattan distance of the block totals and verified on the fingerprints.

A wider corpus takes more blocks: 6 give 15 choices with some 2**15 cells each, 8 give 70 choices
with 2**22. The number follows from the measured count of distinct fingerprints; the answer is
the same for any number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casestar.llm.common import byte_values, ids_of, runs, staged
from casestar.llm.components import components

SEED = 42
SEGMENT_BITS = 2
SEGMENTS = 64 // SEGMENT_BITS
# A cell with more fingerprints than this is compared in several tasks, chunk against chunk.
CELL_ROWS = 20_000
# Two bits meet the same count with chance 1/16 + 1/4 + 1/16: this many bits of a cell a segment.
SEGMENT_ENTROPY = 1.415
# Sending a fingerprint to a cell costs about as much as this many comparisons.
ROW_COST = 100
MOST_BLOCKS = 12


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The 64-bit SimHash of the word shingles of ``text``, repeats included."""
    words = text.lower().split()  # of bytes: only A-Z, and only ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    take = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    left, right = starts[: len(words) - take + 1].tolist(), ends[take - 1:].tolist()
    counts, total = np.zeros(64, np.int64), len(left)
    for i in range(0, total, 1 << 16):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(left[i:i + (1 << 16)], right[i:i + (1 << 16)])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(counts * 2 > total, bitorder="little")
    return int(packed.view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's 64 bits as a signed long), one row per row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle)
                              for t in byte_values(ids_of(batch, "text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [ids_of(batch, "doc_id"), pa.array(found.view(np.int64), pa.int64())],
                names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(
        each, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def segment_counts(fp: Column) -> Column:
    """The embedding: each two bits of the result count the bits of two bits of ``fp``."""
    odd = F.lit(0x5555555555555555)
    low, high = fp.bitwiseAND(odd), F.shiftrightunsigned(fp, 1).bitwiseAND(odd)
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _blocks(blocks: int) -> list[tuple[int, int]]:
    edges = [round(i * SEGMENTS / blocks) for i in range(blocks + 1)]
    return list(zip(edges[:-1], edges[1:]))


def _masks(blocks: int) -> list[int]:
    return [sum(3 << (2 * s) for s in range(a, b)) for a, b in _blocks(blocks)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def blocks_for(prints: int, max_bits: int) -> int:
    """The number of blocks that costs least for so many distinct fingerprints: each one goes to
    a cell per choice of blocks, and meets there what falls into the same cell by chance. At least
    two blocks are chosen; the cells of one are too crowded from some 10,000 prints on."""
    def cost(blocks: int) -> float:
        cell_bits = SEGMENT_ENTROPY * SEGMENTS * (blocks - max_bits) / blocks
        return comb(blocks, max_bits) * (ROW_COST + prints / 2 ** cell_bits)

    return min(range(max_bits + 2, max(MOST_BLOCKS, max_bits + 2) + 1), key=cost)


def cells(prints: DataFrame, blocks: int, max_bits: int) -> DataFrame:
    """``fp`` and ``cell`` for each choice of blocks: the bit counts of the chosen segments."""
    masks = _masks(blocks)
    choices = [sum(masks[i] for i in c) for c in combinations(range(blocks), blocks - max_bits)]
    counts = F.col("_counts")
    keys = [F.xxhash64(F.lit(i), counts.bitwiseAND(F.lit(_signed(m))))
            for i, m in enumerate(choices)]
    return (prints.withColumn("_counts", segment_counts(F.col("fp")))
            .select("fp", F.explode(F.array(*keys)).alias("cell")))


def _neighbours(prints: np.ndarray, totals: np.ndarray, max_bits: int) -> list[np.ndarray]:
    """Links that connect what is within ``max_bits`` in one cell: each print is visited once,
    from the print that reached it, and leaves the list then; a dense group costs its size."""
    links, left = [], np.arange(len(prints))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            bound = np.abs(totals[left] - totals[at]).sum(axis=1) <= max_bits
            near = left[bound]
            near = near[np.bitwise_count(prints[near] ^ prints[at]) <= max_bits]
            if len(near):
                links.append(np.column_stack((np.full(len(near), prints[at]), prints[near])))
                left = np.setdiff1d(left, near, assume_unique=True)
                queue.extend(near)
    return links


def links_in_cells(prints: np.ndarray, cell: np.ndarray, blocks: int, max_bits: int) -> np.ndarray:
    """Verified links (two columns of prints) that connect the prints of each run of a cell."""
    at, to = runs(cell)
    out = []
    totals = np.column_stack([np.bitwise_count(prints & np.uint64(m)) for m in _masks(blocks)]
                             ).astype(np.int8)
    small = (to - at >= 2) & (to - at <= 64)
    if small.any():
        # all small cells at once: each row against the row `step` further, if in the same cell
        rows = np.concatenate([np.arange(a, b) for a, b in zip(at[small], to[small])])
        p, c, t = prints[rows], cell[rows], totals[rows]
        for step in range(1, int((to - at)[small].max())):
            same = np.flatnonzero(c[step:] == c[:-step])
            same = same[np.abs(t[same + step] - t[same]).sum(axis=1) <= max_bits]
            same = same[np.bitwise_count(p[same + step] ^ p[same]) <= max_bits]
            if len(same):
                out.append(np.column_stack((p[same], p[same + step])))
    for a, b in zip(at[to - at > 64], to[to - at > 64]):
        out += _neighbours(prints[a:b], totals[a:b], max_bits)
    return np.concatenate(out) if out else np.empty((0, 2), np.uint64)


def links(prints: DataFrame, blocks: int = 6, max_bits: int = 4,
          cell_rows: int = CELL_ROWS) -> DataFrame:
    """``a < b``: links between distinct fingerprints ``fp`` that connect every pair within
    ``max_bits`` differing bits, directly or through other links.

    Cells are sorted and compared in tasks. A cell of more than ``cell_rows`` prints is cut
    into chunks, and each pair of chunks is compared on its own."""
    gridded = cells(prints, blocks, max_bits)
    crowded = staged(gridded.groupBy("cell").count().where(F.col("count") > cell_rows)
                     .select("cell", F.ceil(F.col("count") / (cell_rows // 2)).alias("chunks")),
                     "crowded")
    mine = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks"))
    other = F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0).cast("long")))
                      .otherwise(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = (gridded.join(crowded, "cell", "left")
             .select("fp", "cell", F.coalesce(mine, F.lit(0)).alias("_mine"), other.alias("_other"))
             .select("fp", F.xxhash64("cell", F.least("_mine", "_other"),
                                      F.greatest("_mine", "_other")).alias("cell")))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_prints, kept_cells = np.empty(0, np.uint64), np.empty(0, np.int64)

        def result(found: np.ndarray) -> pa.RecordBatch:
            found = np.unique(np.sort(found.view(np.int64), axis=1), axis=0)
            return pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

        for batch in batches:
            prints = np.concatenate((kept_prints, np.asarray(batch.column(0)).view(np.uint64)))
            cell = np.concatenate((kept_cells, np.asarray(batch.column(1))))
            done = np.searchsorted(cell, cell[-1]) if len(cell) else 0  # the last may go on
            if done:
                yield result(links_in_cells(prints[:done], cell[:done], blocks, max_bits))
            kept_prints, kept_cells = prints[done:], cell[done:]
        if len(kept_cells) > 1:
            yield result(links_in_cells(kept_prints, kept_cells, blocks, max_bits))

    return (dealt.repartition("cell").sortWithinPartitions("cell")
            .mapInArrow(compared, "a long, b long").distinct())


SALTS = 16


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4,
                    blocks: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` and ``component_id``, the smallest
    ``doc_id`` that links of at most ``max_bits`` differing bits lead to. Unless given, ``blocks``
    is the cheapest number for the distinct fingerprints that there are.

    A null text counts as empty, and an empty one has the fingerprint zero, which links like any
    other. Rows that repeat share fingerprint and component. A null ``doc_id`` takes part, but
    names a component only if the whole component has no id. Other columns are ignored.
    """
    each = staged(fingerprints(docs, shingle), "fingerprints")
    prints = staged(each.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    if blocks is None:
        blocks = blocks_for(prints.count(), max_bits)
    roots = components(links(prints.select("fp"), blocks, max_bits), "a", "b", "links")
    named = staged(prints.join(roots, prints["fp"] == roots["node"], "left")
                   .select("fp", "first_id", "root"), "rooted")
    alone = named.where("root is null").select("fp", F.col("first_id").alias("component_id"))
    # the prints of a component, which may be a third of all, meet its smallest id in SALTS parts
    linked = named.where("root is not null").withColumn(
        "part", F.pmod(F.xxhash64("fp", F.lit(2)), F.lit(SALTS)).cast("int"))
    first = (linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    labels = (linked.join(first, ["root", "part"]).select("fp", "component_id")
              .unionByName(alone))
    return each.join(labels, "fp").select("doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, a null id last;
    of several with that id, the one whose text hashes lowest. Rows that repeat id and text are one
    document, different texts under one id, or without an id, are not."""
    content = F.xxhash64("text")
    named = docs.select(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id",
                                 content.alias("content")).alias("doc_id"), "text")
    kept = (near_duplicates(named, shingle, max_bits).select("component_id.*").distinct()
            .select(F.col("doc_id").alias("_kept_id"), F.col("content").alias("_kept_content")))
    marked = docs.withColumn("_content_hash", content)
    return (marked.join(kept, marked["doc_id"].eqNullSafe(kept["_kept_id"])
                        & (marked["_content_hash"] == kept["_kept_content"]), "left_semi")
            .dropDuplicates(["doc_id", "_content_hash"]).select(*docs.columns))
