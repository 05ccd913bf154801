"""Windows of a fixed number of units (words or bytes) that occur more than once in a corpus.

Each window has an anchor: the place in it where a short gram has the least hash, so equal windows
have equal anchors wherever they lie. Consecutive windows with one anchor form a phrase. Phrases
are what is grouped, some ten to a thousand times fewer than windows:

1. Phrases are grouped by the gram at their anchor. An equal phrase elsewhere settles all windows
   of a phrase at once.
2. Where phrases with one gram differ, only a part of their windows can be equal. One example of
   each such phrase is fetched, and its windows are compared one by one, at equal distances from
   the anchor. Up to ``CROWD`` phrases of a gram are compared in one group; the windows of a
   larger crowd are grouped by their own hashes instead, all over the cluster.
3. Each document finds its phrases again, and covers what the first two steps settled.

Rows without an id are told apart by a hash of their text, so they are dealt like all others.

Phrases are equal if the 64-bit hashes of their gram and of all their units are; they are only
compared under one gram. Windows of crowds meet among all windows of the corpus, so two
independent hashes, 128 bits together, decide about them.

Within a batch of documents equal phrases are counted before they are shuffled, so a passage that
a third of all documents share costs its group one row per batch. Equal windows of a crowd are
merged in the same way. What passes through one task is streamed, not held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casestar.llm.common import byte_values, runs, staged

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
# Units that are looked at together; a longer text is cut into pieces that overlap by a window.
PIECE = 1 << 20
# Different phrases with one gram that are compared in one group.
CROWD = 1000


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_power_cache: dict[str, np.ndarray] = {}


def powers(name: str, size: int) -> np.ndarray:
    have = _power_cache.get(name)
    if have is None or len(have) < size:
        size = max(size, 1 << 16) * 2
        have = _power_cache[name] = _powers(_BASE if name == "up" else _INVERSE, size)
    return have


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    values = (values ^ (values >> np.uint64(29))) * _MIX
    return values ^ (values >> np.uint64(32))


@dataclass(frozen=True)
class Units:
    """How texts are cut: ``codes`` gives the 64-bit codes of the units of some texts, and where
    each text starts among them. ``packed`` codes take so many bytes each in a fetched phrase."""

    width: int
    gram: int
    codes: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    packed: int
    earlier_only: bool


def prefix(codes: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any stretch follows."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers("up", len(codes))[: len(codes)], out=out[1:])
    return out


def stretch_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (sums[end] - sums[start]) * powers("down", len(sums))[start]


def check_sums(codes: np.ndarray) -> np.ndarray:
    """Sums for a second hash that does not depend on the first: the codes are other ones."""
    return prefix(mixed(codes ^ _MIX))


def _pieces(bounds: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    """Stretches of about a piece: whole short texts together, and the parts of each long text,
    counted from its start, so that a text has the same phrases wherever it is met."""
    at, texts = 0, len(bounds) - 1
    while at < texts:
        low = int(bounds[at])
        to = int(np.searchsorted(bounds, low + PIECE, side="right")) - 1
        if to > at:
            if bounds[to] - low >= width:
                yield low, int(bounds[to])
            at = to
        else:
            end = int(bounds[at + 1])
            for start in range(low, end - width + 1, PIECE):
                yield start, min(start + PIECE + width - 1, end)
            at += 1


def phrases(codes: np.ndarray, bounds: np.ndarray, units: Units) -> tuple[np.ndarray, ...]:
    """``text, first, last, gram, phrase`` of each phrase: the number of its text, the starts of
    its first and last window among all codes, the hash of the gram at the anchor, and of all its
    units; and the anchor's place. Windows do not cross the ``bounds`` of texts."""
    width, gram = units.width, units.gram
    parts = []
    for low, high in _pieces(bounds, width):
        piece = codes[low:high]
        sums = prefix(piece)
        grams = mixed(stretch_hash(sums, np.arange(len(piece) - gram + 1),
                                   np.arange(gram, len(piece) + 1)))
        # the least hash of each window, the leftmost of equal ones: its high bits and its place
        least = (grams & ~np.uint64((1 << 24) - 1)) | np.arange(len(grams), dtype=np.uint64)
        step, span = 1, width - gram + 1
        while 2 * step <= span:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if span > step:
            least = np.minimum(least[:len(least) - (span - step)], least[span - step:])
        anchors = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        text = np.searchsorted(bounds, np.arange(low, low + len(anchors)), side="right") - 1
        inside = np.arange(low, low + len(anchors)) + width <= bounds[text + 1]
        change = (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1] | ~inside[1:]
        cut = np.flatnonzero(change) + 1
        first = np.concatenate(([0], cut))
        last = np.concatenate((cut - 1, [len(anchors) - 1]))
        keep = inside[first]
        first, last = first[keep], last[keep]
        parts.append((text[first], first + low, last + low, grams[anchors[first]],
                      stretch_hash(sums, first, last + width), anchors[first] + low))
    if not parts:
        none = np.empty(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none
    return tuple(np.concatenate(x) for x in zip(*parts))


def _batches(batches: Iterator[pa.RecordBatch], text: int, most: int = 3 << 20):
    """Batches cut to at most about ``most`` bytes of text, with the texts."""
    for batch in batches:
        texts = list(byte_values(batch.column(text)))
        low = size = 0
        for i, t in enumerate(texts):
            if size and size + len(t) > most:
                yield batch.slice(low, i - low), texts[low:i]
                low, size = i, 0
            size += len(t)
        if low < len(texts):
            yield batch.slice(low), texts[low:]


def _int64(column: pa.Array) -> np.ndarray:
    return np.asarray(column.cast(pa.int64()))


def _grouped(batches: Iterator[pa.RecordBatch], most: int = 2000,
             keys: int = 1) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` rows that end where one of the first ``keys`` columns changes."""
    parts: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        named = [np.asarray(batch.column(i)) for i in range(keys)]
        change = np.zeros(len(batch), bool)
        for at, values in enumerate(named):
            change[1:] |= values[1:] != values[:-1]
            change[0] |= bool(parts) and parts[-1].column(at)[-1].as_py() != values[0]
        ends = np.flatnonzero(change)
        if not len(ends):
            parts.append(batch)
            continue
        done = int(ends[-1])
        before = sum(map(len, parts))
        whole = pa.concat_batches([*parts, batch.slice(0, done)])
        ends = ends[ends + before > 0] + before
        at = 0
        while at < len(whole):
            place = np.searchsorted(ends, min(at + most, len(whole)))
            yield whole.slice(at, int(ends[place]) - at)
            at = int(ends[place])
        parts = [batch.slice(done)]
    if parts:
        yield pa.concat_batches(parts)


def settled(docs: DataFrame, units: Units) -> DataFrame:
    """Step 1. ``doc, gram, phrase, kind``: kind 0 for a phrase of a document that is settled as
    repeated, 1 for an example of a phrase that shares its gram with different ones, 2 if these
    are more than ``CROWD``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _batches(batches, 1):
            codes, bounds = units.codes(texts)
            text, _, _, gram, phrase, _ = phrases(codes, bounds, units)
            doc = _int64(batch.column(0))[text]
            order = np.lexsort((doc, phrase, gram))
            doc, gram, phrase = doc[order], gram[order].view(np.int64), phrase[order].view(np.int64)
            same = (gram[1:] == gram[:-1]) & (phrase[1:] == phrase[:-1])
            fresh = np.concatenate(([True], ~same)) if len(doc) else np.empty(0, bool)
            at = np.flatnonzero(fresh)
            count = np.diff(np.append(at, len(doc)))
            # later ones of a batch are settled here; they travel by a key of their own
            later = ~fresh
            later[1:] &= ~same | (doc[1:] != doc[:-1])
            key = np.where(fresh, gram, mixed((phrase ^ (doc * 31)).view(np.uint64)).view(np.int64))
            keep = fresh | later
            times = np.zeros(len(doc), np.int64)
            times[at] = count
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (key, phrase, doc, times)],
                names=["gram", "phrase", "doc", "times"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # examples of a gram that may go on in the next batch, or the gram if it is a crowd
        waiting = tuple(np.empty(0, np.int64) for _ in range(3))
        crowd = None
        for batch in chain(_grouped(batches, 100_000, 2), [None]):
            kept: list[tuple[np.ndarray, ...]] = []
            if batch is not None:
                gram, phrase, doc, times = (np.asarray(batch.column(i)) for i in range(4))
                local = times == 0
                kept.append((doc[local], gram[local], phrase[local]))
                gram, phrase, doc, times = (x[~local] for x in (gram, phrase, doc, times))
                change = (gram[1:] != gram[:-1]) | (phrase[1:] != phrase[:-1])
                at = (np.concatenate(([0], np.flatnonzero(change) + 1)) if len(gram)
                      else np.empty(0, np.int64))
                size = np.diff(np.append(at, len(gram)))
                if units.earlier_only:
                    repeated = doc > np.repeat(doc[at], size)
                else:
                    repeated = np.repeat(np.add.reduceat(times, at) if len(at) else times, size) > 1
                kept.append((doc[repeated], gram[repeated], phrase[repeated]))
                waiting = tuple(np.concatenate((old, new[at]))
                                for old, new in zip(waiting, (doc, gram, phrase)))
            at, to = runs(waiting[1])
            size = to - at
            kind = np.where(size > CROWD, 2, np.where(size > 1, 1, 0)).astype(np.int32)
            hold = len(waiting[1])
            if hold:
                if waiting[1][0] == crowd:
                    kind[0] = 2
                crowd = waiting[1][-1] if kind[-1] == 2 else None
                if batch is not None and crowd is None:
                    hold = int(at[-1])
            kinds = np.repeat(kind, size)[:hold]
            asked = np.flatnonzero(kinds)
            kept.append(tuple(x[asked] for x in waiting))
            waiting = tuple(x[hold:] for x in waiting)
            out = [np.concatenate(x) for x in zip(*kept)]
            kind = np.zeros(len(out[0]), np.int32)
            kind[len(kind) - len(asked):] = kinds[asked]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*out, kind)],
                                             names=["doc", "gram", "phrase", "kind"])

    return staged(
        docs.mapInArrow(emit, "gram long, phrase long, doc long, times long")
        .repartition("gram").sortWithinPartitions("gram", "phrase", "doc")
        .mapInArrow(decide, "doc long, gram long, phrase long, kind int"), "phrases")


def compared(docs: DataFrame, found: DataFrame, units: Units) -> DataFrame:
    """Step 2. ``doc, phrase, low, high``: windows of a phrase, by their place in it, that occur
    in a different phrase too."""
    asked = (found.where("kind > 0").groupBy("doc")
             .agg(F.collect_list(F.when(F.col("kind") == 1, F.col("phrase"))).alias("asked"),
                  F.collect_list(F.when(F.col("kind") == 2, F.col("phrase"))).alias("crowds")))
    width = units.width

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _batches(batches, 1):
            codes, bounds = units.codes(texts)
            text, first, last, gram, phrase, anchor = phrases(codes, bounds, units)
            names = phrase.view(np.int64)
            doc = _int64(batch.column(0))
            pick = picked(text, names, batch.column(2))
            yield from_columns(
                gram[pick].view(np.int64), names[pick], doc[text[pick]], (anchor - first)[pick],
                np.ones(len(pick), np.int64), np.zeros(len(pick), np.int64),
                [codes[a:b + width].tobytes() if units.packed == 8
                 else bytes_of(texts, bounds, t, a, b + width)
                 for t, a, b in zip(text[pick], first[pick], last[pick])])
            pick = picked(text, names, batch.column(3))
            if len(pick):
                yield from windows_of(codes, first[pick], last[pick], anchor[pick], gram[pick],
                                      names[pick], doc[text[pick]])

    def picked(text: np.ndarray, names: np.ndarray, wanted: pa.Array) -> np.ndarray:
        """The first of each wanted phrase of each text."""
        left = [set(x) for x in wanted.to_pylist()]
        rows = []
        for i, (t, name) in enumerate(zip(text.tolist(), names.tolist())):
            if name in left[t]:
                left[t].discard(name)
                rows.append(i)
        return np.array(rows, np.int64)

    def from_columns(*columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, columns[:6]), pa.array(columns[6], pa.binary())],
            names=["gram", "phrase", "doc", "place", "times", "proof", "units"])

    def windows_of(codes, first, last, anchor, gram, names, doc) -> Iterator[pa.RecordBatch]:
        """A row for each window of the phrases of crowds, keyed by its hash, without units. Of
        equal ones those of the first document go to their group, with their number; the others
        are settled, which zero tells, and travel by keys of their own."""
        sums, checks = prefix(codes), check_sums(codes)
        sizes = last - first + 1
        for part in np.array_split(np.arange(len(sizes)), int(sizes.sum()) // (1 << 19) + 1):
            size = sizes[part]
            owner = np.repeat(part, size)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            begin = first[owner] + inside
            key = mixed(stretch_hash(sums, begin, begin + width) ^ gram[owner]
                        ^ mixed((anchor[owner] - begin).astype(np.uint64) + np.uint64(1)))
            proof = stretch_hash(checks, begin, begin + width)
            order = np.lexsort((doc[owner], proof, key))
            key, proof, owner, inside = (x[order] for x in (key, proof, owner, inside))
            at, to = runs(numbered(key, proof))
            same = doc[owner] == np.repeat(doc[owner[at]], to - at)
            key = np.where(same, key, mixed(key ^ doc[owner].view(np.uint64)))
            yield from_columns(key.view(np.int64), names[owner], doc[owner], inside,
                               np.where(same, np.repeat(to - at, to - at), 0),
                               proof.view(np.int64), pa.nulls(len(key), pa.binary()))

    def numbered(key: np.ndarray, proof: np.ndarray) -> np.ndarray:
        """A number for each run of rows that agree in both."""
        fresh = np.ones(len(key), np.int64)
        fresh[1:] = (key[1:] != key[:-1]) | (proof[1:] != proof[:-1])
        return np.cumsum(fresh)

    def bytes_of(texts: list[bytes], bounds: np.ndarray, t: int, a: int, b: int) -> bytes:
        return texts[t][a - bounds[t]:b - bounds[t]]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _grouped(batches):
            alone = batch.column(6).is_null()
            if alone.true_count:
                yield crowded(batch.filter(alone))
                batch = batch.filter(pc.invert(alone))
            if len(batch):
                yield together(batch)

    def crowded(batch: pa.RecordBatch) -> pa.RecordBatch:
        key, phrase, doc, place, times, proof = (np.asarray(batch.column(i)) for i in range(6))
        order = np.lexsort((doc, proof, key))
        key, phrase, doc, place, times, proof = (
            x[order] for x in (key, phrase, doc, place, times, proof))
        at, to = runs(numbered(key, proof))
        if units.earlier_only:
            hit = doc > np.repeat(doc[at], to - at)
        else:
            hit = np.repeat(np.add.reduceat(times, at), to - at) > 1
        hit |= times == 0
        return pa.RecordBatch.from_arrays(
            [pa.array(x[hit]) for x in (doc, phrase, place, place)],
            names=["doc", "phrase", "low", "high"])

    def together(batch: pa.RecordBatch) -> pa.RecordBatch:
        stored = list(byte_values(batch.column(6)))
        if units.packed == 8:
            codes = np.frombuffer(b"".join(stored), np.uint64)
            sizes = np.array([len(s) // 8 for s in stored])
        else:
            codes, ends = units.codes(stored)
            sizes = np.diff(ends)
        gram, phrase, doc, place = (np.asarray(batch.column(i)) for i in range(4))
        start = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        windows = sizes - width + 1
        owner = np.repeat(np.arange(len(sizes)), windows)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        begin = start[owner] + inside
        sums = prefix(codes)
        # equal windows lie at equal distances from the anchor, under one gram
        back = (place[owner] - inside).astype(np.uint64)
        key = mixed(stretch_hash(sums, begin, begin + width) ^ mixed(back + np.uint64(1))
                    ^ gram[owner].view(np.uint64))
        order = np.lexsort((doc[owner], key))
        key, owner, inside = key[order], owner[order], inside[order]
        at, to = runs(key)
        if units.earlier_only:
            hit = doc[owner] > np.repeat(doc[owner[at]], to - at)
        else:
            hit = np.repeat(to - at, to - at) > 1
        owner, inside = owner[hit], inside[hit]
        order = np.lexsort((inside, owner))
        owner, inside = owner[order], inside[order]
        at, to = runs(owner * (1 << 40) + inside - np.arange(len(inside)))
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[owner[at]]), pa.array(phrase[owner[at]]), pa.array(inside[at]),
             pa.array(inside[to - 1])], names=["doc", "phrase", "low", "high"])

    return staged(
        docs.join(asked.hint("merge"), "doc").select("doc", "text", "asked", "crowds")
        .mapInArrow(fetch, "gram long, phrase long, doc long, place long, times long, proof long, "
                           "units binary")
        .repartition("gram").sortWithinPartitions("gram")
        .mapInArrow(compare, "doc long, phrase long, low long, high long"), "windows")


def keyed_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, text, doc``: rows under the key of their notes, the id or else a hash of the
    text. Rows that share a key, copies without an id or by chance, share their notes; a note names
    phrases by content, so each row only uses those on its own phrases."""
    return docs.select("doc_id", "text", F.coalesce(
        F.col("doc_id").cast("long"), F.xxhash64("text")).alias("doc"))


def covered(docs: DataFrame, units: Units, result: Callable, schema: str,
            with_null_ids: bool) -> DataFrame:
    """All steps: ``result(ids, texts, codes, bounds, hit)`` makes a record batch of ``schema``
    of some texts, their codes, and which codes lie in a repeated window."""
    keyed = keyed_rows(docs)
    part = keyed if with_null_ids else keyed.where("doc_id is not null")
    part = part.select("doc", "text")
    found = settled(part, units)
    windows = compared(part, found, units)
    whole = (found.where("kind = 0").groupBy("doc")
             .agg(F.collect_set("phrase").alias("whole")))
    some = windows.groupBy("doc").agg(
        F.collect_list(F.struct("phrase", "low", "high")).alias("some"))
    notes = whole.join(some, "doc", "full_outer")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    width = units.width

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _batches(batches, 1):
            codes, bounds = units.codes(texts)
            text, first, last, _, phrase, _ = phrases(codes, bounds, units)
            names = phrase.view(np.int64)
            change = np.zeros(len(codes) + 1, np.int64)
            ends = np.searchsorted(text, np.arange(len(texts) + 1))
            for t, (whole, some) in enumerate(zip(batch.column(2), batch.column(3))):
                low, high = ends[t], ends[t + 1]
                if low == high:
                    continue
                mine = names[low:high]
                if whole.is_valid:
                    hit = np.flatnonzero(np.isin(mine, np.asarray(whole.values))) + low
                    np.add.at(change, first[hit], 1)
                    np.add.at(change, last[hit] + width, -1)
                if some.is_valid:
                    fields = some.values
                    name, lo, hi = (np.asarray(fields.field(i)) for i in range(3))
                    order = np.argsort(mine, kind="stable")
                    left = np.searchsorted(mine[order], name, "left")
                    right = np.searchsorted(mine[order], name, "right")
                    times = right - left
                    which = np.repeat(np.arange(len(name)), times)
                    nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
                    at = first[low + order[left[which] + nth]]
                    np.add.at(change, at + lo[which], 1)
                    np.add.at(change, at + hi[which] + width, -1)
            yield result(batch.column(0), texts, codes, bounds, np.cumsum(change[:-1]) > 0)

    noted = F.col("doc") == F.col("_doc")
    if not with_null_ids:
        noted &= F.col("doc_id").isNotNull()
    return (keyed.join(notes.withColumnRenamed("doc", "_doc").hint("merge"), noted, "left")
            .select("doc_id", "text", "whole", "some")
            .mapInArrow(cover, f"doc_id {id_type}, {schema}"))
