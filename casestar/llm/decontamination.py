"""Benchmark decontamination by pigeonhole edit matching.

Method. A test item may differ by ``k`` edits, one for each ``chars_per_edit`` characters. It is
split into ``k + 1`` pieces; whatever k edits do, one piece stays whole. All pieces of all items
are searched in the document in one pass (Aho-Corasick), each hit gives the stretch where its
item would lie, and the least edit distance of the item to any part of that stretch is found
with Myers' bit-parallel recurrence.

Both sides are compared in lower case with white space runs as one space.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from casestar.llm.common import byte_values, ids_of

CHARS_PER_EDIT = 20
# Items go to the tasks in blocks of at most about this many bytes of text.
BLOCK_BYTES = 8 << 20


def normalized(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` consecutive pieces of nearly equal length, with their offsets."""
    edges = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def least_distance(item: str, text: str) -> int:
    """The least edit distance of ``item`` to any substring of ``text`` (Myers 1999)."""
    size = len(item)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    best = score
    for c in text:
        equal = masks.get(c, 0)
        across = equal | down
        equal = (((equal & up) + up) ^ up) | equal
        rise, fall = (down | ~(equal | up)) & full, up & equal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = (fall | ~(across | rise)) & full, rise & across
        if score < best:
            best = score
    return best


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], chars_per_edit: int = CHARS_PER_EDIT):
        self.items = []
        at: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item_id, raw in items:
            if item := normalized(raw or ""):
                edits = len(item) // chars_per_edit
                for offset, piece in pieces(item, edits):
                    at[piece].append((len(self.items), offset))
                self.items.append((item_id, item, edits))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        if at:
            self.automaton.make_automaton()

    def found(self, text: str) -> list[tuple[int, int]]:
        """Items within their budget, with the least distance to any part of the text."""
        text = normalized(text)
        if not self.items or not text:
            return []
        stretches: dict[int, list[list[int]]] = defaultdict(list)
        for end, (size, places) in self.automaton.iter(text):
            for number, offset in places:
                _, item, edits = self.items[number]
                start = end + 1 - size - offset
                low, high = max(0, start - edits), start + len(item) + edits
                mine = stretches[number]
                if mine and low <= mine[-1][1] and low >= mine[-1][0]:
                    mine[-1][1] = max(mine[-1][1], high)
                else:
                    mine.append([low, high])
        out = []
        for number, mine in stretches.items():
            item_id, item, edits = self.items[number]
            best = edits + 1
            for low, high in mine:
                part = text[low:high]
                best = min(best, 0 if item in part else least_distance(item, part))
                if not best:
                    break
            if best <= edits:
                out.append((item_id, best))
        return out


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[list]:
    """The items in blocks of bounded size. A test set is far smaller than a corpus, but its size
    is measured, not assumed: each block is one pass over the documents."""
    items = benchmark.select("item_id", "text").where(F.length("text") > 0)
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-total // block_bytes)
    numbered = items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    return [[(r["item_id"], r["text"]) for r in
             numbered.where(F.col("_block") == b).orderBy("item_id", "text").collect()]
            for b in range(blocks)]


def _scan(docs: DataFrame, items: list, chars_per_edit: int, schema, each_batch) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)  # at most a block

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, chars_per_edit)
        for batch in batches:
            texts = [t.decode() for t in byte_values(ids_of(batch, "text"))]
            yield each_batch(batch, [matcher.found(t) for t in texts])

    return docs.mapInArrow(each, schema)


def leaks(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """``doc_id, item_id, distance`` for each row of ``docs`` and each item that some part of its
    text is within the item's budget of.

    Null or blank texts and items match nothing. Rows that repeat, on either side, match each;
    so does a null ``doc_id`` or ``item_id``; ids keep their type. Texts of any length are searched
    whole, in time proportional to the length, and held one at a time in their task. Of equally
    near parts of a text one row comes out, with their distance. Other columns are ignored.
    """
    columns = docs.select("doc_id", "text")
    kinds = [docs.schema["doc_id"].dataType.simpleString(),
             benchmark.schema["item_id"].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int"
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)

    def hits(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        rows = [(i, item, d) for i, mine in enumerate(found) for item, d in mine]
        return pa.RecordBatch.from_arrays(
            [ids_of(batch, "doc_id").take(pa.array([r[0] for r in rows], pa.int64())),
             pa.array([r[1] for r in rows], item_type), pa.array([r[2] for r in rows], pa.int32())],
            names=["doc_id", "item_id", "distance"])

    parts = [_scan(columns, block, chars_per_edit, schema, hits)
             for block in item_blocks(benchmark)]
    out = parts[0] if parts else docs.sparkSession.createDataFrame([], schema)
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame,
                    chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """The rows of ``docs`` that no item leaks into. Rows stream through once per block of items,
    without a shuffle."""
    names = docs.schema.names

    def unhit(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        return batch.filter(pa.array([not mine for mine in found], pa.bool_()))

    for block in item_blocks(benchmark):
        docs = _scan(docs.select(*names), block, chars_per_edit, docs.schema, unhit)
    return docs
