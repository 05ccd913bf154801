"""Substring de-duplication over words, by relative Lempel-Ziv parsing.

Method. The reference holds the phrases of all documents, indexed by the gram at their anchor and
dealt by it into blocks, one per partition. A document is factored against every block at once:
each of its phrases goes to the block that can hold it. Consecutive phrases that earlier
documents have form a factor, as long as the match goes. At a factor's boundaries the match ends
inside a phrase, and the windows there are compared one by one with the block's phrases. A factor
of at least ``window_words`` words is a duplicate span; shorter ones cover no window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from casestar.llm.repeats import Units, covered

WINDOW_WORDS = 13
GRAM_WORDS = 5


class _Codes(dict):
    """The code of each word, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


_codes = _Codes()


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts, sizes = [], [0]
    for text in texts:
        words = text.split()
        parts.append(np.fromiter(map(_codes.__getitem__, words), np.uint64, len(words)))
        sizes.append(len(words))
    codes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return codes, np.cumsum(sizes)


def without_copied(docs: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256``
    after the removal of each word in a window of ``window_words`` that also starts in a document
    with a smaller id.

    A null text has no words. A null id is neither smaller nor larger than another, so nothing is
    removed for it or from it. Rows that repeat an id are one document. Other columns are ignored.
    """
    units = Units(window_words, min(GRAM_WORDS, window_words), word_codes, 8, True)

    def result(ids, texts, codes, bounds, hit) -> pa.RecordBatch:
        rows = []
        for t, text in enumerate(texts):
            mine, words = hit[bounds[t]:bounds[t + 1]], text.split()
            removed = int(mine.sum())
            if removed:
                words = [words[i] for i in np.flatnonzero(~mine).tolist()]
            rows.append((len(mine), removed, hashlib.sha256(b" ".join(words)).hexdigest()))
        columns = list(zip(*rows)) or [()] * 3
        return pa.RecordBatch.from_arrays(
            [ids, *[pa.array(c, pa.int64()) for c in columns[:2]], pa.array(columns[2], pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return covered(docs, units, result, "n_words long, n_removed long, kept_sha256 string", False)
