"""Token counts without token ids: pieces once per distinct pre-token, joined to frequencies.

A byte-level BPE never merges across the borders of pre-tokens, so the tokens of a text are the
sum over its pre-tokens. The corpus is split twice. The first pass counts every pre-token, and
each distinct one is cut into pieces once. The second pass counts the pre-tokens of each document
and joins them to those counts: the most frequent ones from a broadcast table of bounded size,
the others through a shuffle, in which no pre-token owns more rows than the least frequent one of
that table. Ids of tokens exist only inside the library's call for one pre-token.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casestar.llm.common import ids_of, staged

# Fixed value: the published pattern that byte-level BPE vocabularies of this family split by,
# letters first, since only the contractions can start with an apostrophe and win.
SPLIT = (r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
         r"|\s+(?!\S)|\s+")

# Fixed rule: byte-level vocabularies write a byte as the Latin-1 character if that is printable,
# the others in order as the characters from 256 on.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_WRITTEN = {byte: 256 + at for at, byte in enumerate(sorted({*range(256)} - _PLAIN))}

# The broadcast table has at most so many pre-tokens, of so many bytes.
HEAD_ROWS, HEAD_BYTES = 1 << 18, 16 << 20
# A task of the first pass hands its counts on when it has so many different pre-tokens.
VOCABULARY = 1 << 16
BATCH_ROWS = 20_000
# Texts are cut in groups of about so many characters; a group's pre-tokens are held as strings,
# which take some ten times the memory of the text.
GROUP_CHARS = 1 << 19


class Splitter:
    """Cuts texts into pre-tokens exactly as the tokenizer of a definition does."""

    def __init__(self, definition: str):
        import regex
        from tokenizers import Tokenizer

        check_definition(definition)
        self.library = Tokenizer.from_str(definition)
        special = sorted((t["content"] for t in json.loads(definition)["added_tokens"]),
                         key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pattern = regex.compile(SPLIT)
        self.alike: set[str] = set()
        self.other: set[str] = set()

    def cut(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and how many special strings stand in it."""
        parts = self.special.split(text) if self.special else [text]
        found: list[str] = []
        for part in parts:
            if part.isascii() or self._classes_agree(part):
                found += self.pattern.findall(part)
            else:
                found += [part[a:b] for _, (a, b) in
                          self.library.pre_tokenizer.pre_tokenize_str(part)]
        return found, len(parts) - 1

    def pieces(self, pre: str) -> int:
        """The number of pieces of a pre-token."""
        written = pre.encode().decode("latin-1").translate(_WRITTEN)
        return len(self.library.model.tokenize(written))

    def _classes_agree(self, part: str) -> bool:
        """Whether the pattern and the library agree on letter, number, space or other for every
        character. They follow different versions of Unicode; where they differ the library cuts,
        which is slower."""
        for char in set(part) - self.alike - self.other:
            probe = f"a{char}1 {char}{char}!"
            spans = [span for _, span in self.library.pre_tokenizer.pre_tokenize_str(probe)]
            same = spans == [m.span() for m in self.pattern.finditer(probe)]
            (self.alike if same else self.other).add(char)
        return self.other.isdisjoint(part)


def check_definition(definition: str) -> None:
    """Raise ``ValueError`` unless counting by pre-token is exact for this tokenizer: byte-level
    BPE, the plain split, no normalizer, special tokens matched as they are written."""
    parts = json.loads(definition)
    before, model = parts["pre_tokenizer"] or {}, parts["model"]
    plain = all(not token[flag] for token in parts["added_tokens"]
                for flag in ("lstrip", "rstrip", "single_word", "normalized"))
    if not (plain and parts["normalizer"] is None and model["type"] == "BPE"
            and model.get("dropout") is None and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before["add_prefix_space"]):
        raise ValueError("not a byte-level BPE that can be counted by pre-token")


def token_counts(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = 1024, head_rows: int = HEAD_ROWS,
                 head_bytes: int = HEAD_BYTES) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``
    tokens), one row per row of ``docs``.

    ``tokenizer`` is the place of a definition (.json) on the driver; it travels with the job.
    The count is the library's for the whole text without begin or end tokens; a special string
    inside a text counts as one token, as the library reads it by default.

    A null text counts as an empty one: no bytes, no tokens. Rows without an id, with repeated ids
    and equal rows are counted one by one. Other columns of ``docs`` are not read. An empty table
    gives no rows. A text is cut in one task, whatever its length; its rare pre-tokens, which are
    one row each, are summed over several.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    check_definition(definition)
    shared = spark.sparkContext.broadcast(definition)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    pieces = staged(_pieces(_vocabulary(rows, shared), shared), "tokens-pieces")
    head = _head(pieces, head_rows, head_bytes)
    counted = staged(_frequencies(rows, shared, spark.sparkContext.broadcast(head)),
                     "tokens-documents")
    # one row per rare pre-token of a document, joined to its number of pieces
    rare = counted.where(F.size("rare") > 0).select("row_key", F.explode("rare").alias("r"))
    tail = (rare.select("row_key", "r.pre", "r.freq").join(pieces.select("pre", "pieces"), "pre")
            .groupBy("row_key").agg(F.sum(F.col("freq") * F.col("pieces")).alias("tail")))
    return (counted.drop("rare").join(tail, "row_key", "left")
            .withColumn("n_tokens", F.col("common") + F.coalesce("tail", F.lit(0)))
            .select("doc_id", "n_bytes", "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit")))


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """The texts of a batch in groups of about ``GROUP_CHARS``, each with its first row."""
    first, texts, size = 0, [], 0
    for row, value in enumerate(ids_of(batch, "text"), start=1):
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if size >= GROUP_CHARS or row == batch.num_rows:
            yield first, texts
            first, texts, size = row, [], 0


def _vocabulary(rows: DataFrame, shared) -> DataFrame:
    """Every distinct pre-token and how often it occurs in the corpus."""
    def batches_of(seen: Counter) -> Iterator[pa.RecordBatch]:
        table = pa.table({"pre": pa.array(seen, pa.string()),
                          "freq": pa.array(seen.values(), pa.int64())})
        return iter(table.to_batches(BATCH_ROWS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, seen = Splitter(shared.value), Counter()
        for batch in batches:
            for _, texts in _groups(batch):
                for text in texts:
                    seen.update(splitter.cut(text)[0])
                if len(seen) > VOCABULARY:
                    yield from batches_of(seen)
                    seen = Counter()
        yield from batches_of(seen)

    return (rows.select("text").mapInArrow(count, "pre string, freq long")
            .groupBy("pre").agg(F.sum("freq").alias("freq")))


def _pieces(vocabulary: DataFrame, shared) -> DataFrame:
    """The number of pieces of each distinct pre-token."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(shared.value)
        for batch in batches:
            found = [splitter.pieces(pre) for pre in ids_of(batch, "pre").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [ids_of(batch, "pre"), ids_of(batch, "freq"), pa.array(found, pa.int64())],
                names=["pre", "freq", "pieces"])

    return vocabulary.mapInArrow(count, "pre string, freq long, pieces long")


def _head(pieces: DataFrame, head_rows: int, head_bytes: int) -> dict[str, int]:
    """The most frequent pre-tokens, as many powers of two of frequency as fit both bounds."""
    power = F.length(F.bin("freq"))
    # at most 63 rows
    levels = pieces.groupBy(power.alias("power")).agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("pre")).alias("bytes")).collect()
    least, rows, size = 64, 0, 0
    for level in sorted(levels, key=lambda r: -r["power"]):
        rows, size = rows + level["rows"], size + level["bytes"]
        if rows > head_rows or size > head_bytes:
            break
        least = level["power"]
    # within the two bounds, which are the parameters
    found = pieces.where(power >= least).select("pre", "pieces").toArrow()
    return dict(zip(found["pre"].to_pylist(), found["pieces"].to_pylist()))


def _frequencies(rows: DataFrame, shared, head) -> DataFrame:
    """Per document: its bytes, the tokens of its frequent pre-tokens, and its rare pre-tokens
    with how often it has each. ``row_key`` tells rows apart, not ids."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, known = Splitter(shared.value), head.value
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, texts in _groups(batch):
                found, lengths, special = [], [], []
                for text in texts:
                    pres, n = splitter.cut(text)
                    found += pres
                    lengths.append(len(pres))
                    special.append(n)
                named = pa.array(found, pa.string()).dictionary_encode()
                names = named.dictionary
                pieces = np.array([known.get(pre, 0) for pre in names.to_pylist()] or [0])
                code = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(len(texts)), lengths)
                common = np.array(special)
                np.add.at(common, doc, pieces[code])
                # every pre-token has a piece, so those without are the rare ones
                rare = pieces[code] == 0
                each, freq = np.unique(doc[rare] * len(names) + code[rare], return_counts=True)
                offsets = np.searchsorted(each, np.arange(len(texts) + 1) * len(names))
                pairs = pa.StructArray.from_arrays(
                    [names.take(pa.array(each % max(len(names), 1))), pa.array(freq)],
                    names=["pre", "freq"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(key, key + len(texts))),
                     ids_of(batch, "doc_id").slice(first, len(texts)),
                     pa.array([len(text.encode()) for text in texts], pa.int64()),
                     pa.array(common.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pairs)],
                    names=["row_key", "doc_id", "n_bytes", "common", "rare"])
                key += len(texts)

    return rows.mapInArrow(count, f"row_key long, doc_id {id_type}, n_bytes long, common long, "
                                  "rare array<struct<pre: string, freq: long>>")
