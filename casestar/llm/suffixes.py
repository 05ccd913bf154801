"""Substring de-duplication over bytes, by sorting a sample of suffixes and inducing the rest.

Method. Sorting every suffix of a corpus externally (induced sorting with disk-backed queues of
tuples and common-prefix values) needs tuples of 16 bytes and more for each byte of text, several
times the input on disk. A string of 400 bytes only has to be found once, though. So the suffixes
that are sorted are those at anchors, about one in 190, which any string of 400 bytes contains
and which depend on the string alone, as the left-most-smallest suffixes of induced sorting do.
Spark's external sort (runs on disk, merged through a priority queue) brings equal ones together;
their names are phrases. The induction step extends what is known at an anchor to the suffixes
around it: equal phrases settle all strings through an anchor, and where phrases differ, the
strings at equal distances from it are compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casestar.llm.repeats import Units, covered, mixed

STRING_BYTES = 400
GRAM_BYTES = 16

_BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def byte_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return _BYTE_CODES[np.frombuffer(b"".join(texts), np.uint8)], bounds


def without_repeats(docs: DataFrame, string_bytes: int = STRING_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and
    ``kept_sha256``, after the removal of each byte that a string of ``string_bytes`` covers which
    also starts elsewhere, in the same text or another.

    A null text is empty. Rows that repeat, with or without an id, are elsewhere for each other.
    Other columns are ignored.
    """
    units = Units(string_bytes, min(GRAM_BYTES, string_bytes), byte_codes, 1, False)

    def result(ids, texts, codes, bounds, hit) -> pa.RecordBatch:
        rows = []
        for t, text in enumerate(texts):
            mine = hit[bounds[t]:bounds[t + 1]]
            removed = int(mine.sum())
            kept = text
            spans = 0
            if removed:
                kept = np.frombuffer(text, np.uint8)[~mine].tobytes()
                spans = int(mine[0]) + int((mine[1:] & ~mine[:-1]).sum())
            rows.append((len(text), removed, spans, hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [ids, *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return covered(docs, units, result,
                   "n_bytes long, n_removed long, n_spans long, kept_sha256 string", True)
