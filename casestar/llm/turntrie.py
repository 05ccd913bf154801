"""Prefix tries over conversations, one double array per shard of sorted turn sequences.

A turn is named by 128 bits of a digest of role and text, a conversation by the digests of its
turns in order, its path. Equal paths are one sequence with a count. The sequences are sorted over
the cluster and the sorted order is cut into shards of bounded size, so a first turn that a third
of all conversations share is spread like any other. Each shard numbers its turns densely, packs
its trie into BASE and CHECK arrays and walks its sequences through them to sum up the nodes.
A node lies in several shards only if it is a prefix on both sides of a cut; those upper nodes
carry a key, and their sums are merged over the cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casestar.llm.common import runs, staged

DIGEST = 16
NO_MEMBERS = hashlib.sha256(b"").hexdigest()
# Members of a sequence are listed in blocks of so many consecutive ids.
BLOCK_IDS = 256
# A shard is closed when it holds so many turns.
SHARD_TURNS = 1 << 16
# How many places are tried for a node with several children before it goes to the end.
TRIED = 2048

SEQUENCE = "path binary, sizes array<int>, conv_id long, n_convs long, ends string"
NODE = pa.schema([
    ("shard", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()),
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("ends", pa.string())])
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def rebuilt(conversations: DataFrame, group: int = 5, heads: int = 9, conv_id: str = "conv_id",
            turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``path`` and ``sizes`` (bytes of each text) of every rebuilt conversation.

    Conversation c takes its first h turns from conversation c - c % group and the others from
    itself, with h = crc32(decimal c) % heads. Turns are ordered by ``turn``, null first; turns of
    equal rank are ordered by their digest, so equal rows stay and reruns agree. A null role or
    text is empty. Rows without a conversation id belong to no conversation. Other columns are not
    read. Texts are digested where they are scanned; 20 bytes a turn are shuffled. The turns of
    one conversation meet in one row.
    """
    def filled(name: str):
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))

    # the length in front keeps role and text apart
    named = F.concat(F.octet_length(filled(role)).cast("string"), F.lit(":"), filled(role),
                     filled(text))
    turns = conversations.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").alias("at"),
                 F.substring(F.sha2(named, 256), 1, 2 * DIGEST).alias("digest"),
                 F.octet_length(filled(text)).alias("size")).alias("t"))
    own = turns.groupBy("conv_id").agg(F.transform(
        F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"], t["size"])).alias("own"))
    first = F.col("conv_id") - F.col("conv_id") % group
    lead = own.where(F.col("conv_id") == first).select(
        F.col("conv_id").alias("lead_id"), F.slice("own", 1, heads - 1).alias("lead"))
    joined = own.join(lead, first == F.col("lead_id"), "left").withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int"))
    head = F.expr("if(lead is null, slice(own, 1, 0), slice(lead, 1, h))")
    turns_now = F.concat(head, F.expr("slice(own, h + 1, size(own))"))
    return joined.select("conv_id", turns_now.alias("turns")).select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"))


def sequences(paths: DataFrame) -> DataFrame:
    """Each distinct path with its smallest member, the number of members and the SHA-256 of
    their ids, ascending and joined by commas.

    Ids are joined in blocks of at most ``BLOCK_IDS`` consecutive ones, wherever their rows are.
    SHA-256 has to read a list in order, so the blocks of a path stream through one task, which
    holds one block at a time.
    """
    listed = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")),
                                      lambda x: x.cast("string")), ",")
    blocks = (paths.groupBy("path", "sizes", F.floor(F.col("conv_id") / BLOCK_IDS).alias("block"))
              .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                   listed.alias("ends")))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = hashed = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if now is None or now["path"] != row["path"]:
                    if now is not None:
                        done.append(now | {"ends": hashed.hexdigest()})
                    now, hashed = row, hashlib.sha256(row["ends"].encode())
                else:
                    now["conv_id"] = min(now["conv_id"], row["conv_id"])
                    now["n_convs"] += row["n_convs"]
                    hashed.update(b"," + row["ends"].encode())
            yield pa.RecordBatch.from_pylist(done, schema=batch.schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now | {"ends": hashed.hexdigest()}],
                                             schema=batch.schema)

    return (blocks.repartition("path").sortWithinPartitions("path", "block").drop("block")
            .mapInArrow(join, SEQUENCE))


def prefix_trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct prefix of the ``paths`` (see ``rebuilt``), the empty one included.

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``; subtrees include their top. A table without
    conversations has no node, not even a root.
    """
    spark = paths.sparkSession
    ranged = sequences(paths).repartitionByRange("path").sortWithinPartitions("path")
    # range borders are sampled: what follows only reads the written cut
    cut = staged(ranged.withColumn("part", F.spark_partition_id()), "trie-sequences")
    nodes = staged(
        cut.join(F.broadcast(_neighbours(cut)), "part")  # one row per partition
        .repartitionByRange("part").sortWithinPartitions("part", "path")
        .mapInArrow(lambda batches: _trie_rows(batches, shard_turns),
                    spark.createDataFrame(NODE.empty_table()).schema), "trie-nodes")
    upper = nodes.where(F.col("key").isNotNull())
    merged = staged(upper.groupBy("key").agg(
        F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"), *[F.sum(name).alias(name) for name in SUMS],
        F.max("ends").alias("ends")), "trie-upper")
    tops = merged.select(F.col("key").alias("top"), F.col("conv_id").alias("top_conv_id"))
    # below an upper node the parent's smallest member is known only now; it is brought to each
    # shard first, so a root with a third of all nodes below it is no hot key
    in_shard = upper.select(F.col("shard").alias("top_shard"), "key").join(
        tops, F.col("key") == F.col("top")).drop("key")
    below = nodes.where("key is null and parent_key is not null").join(
        in_shard, (F.col("shard") == F.col("top_shard")) & (F.col("parent_key") == F.col("top")))
    found = [_node(nodes.where("key is null and parent_key is null"), "parent_conv_id"),
             _node(below, "top_conv_id"),
             _node(merged.join(tops, F.col("parent_key") == F.col("top"), "left"), "top_conv_id")]
    return found[0].unionByName(found[1]).unionByName(found[2])


def _node(rows: DataFrame, parent: str) -> DataFrame:
    return rows.select("conv_id", "depth", F.col(parent).alias("parent_conv_id"), *SUMS,
                       F.coalesce("ends", F.lit(NO_MEMBERS)).alias("ends_sha256"))


def _neighbours(cut: DataFrame) -> DataFrame:
    """Per partition of the sorted sequences: how many turns its first one shares with the last
    one before it, and its last one with the first one after it; -1 at either end."""
    ends = cut.groupBy("part").agg(F.min("path").alias("lo"), F.max("path").alias("hi"))
    # one row per partition
    order = Window.orderBy("part")
    beside = ends.withColumns({"prev": F.lag("hi").over(order), "next": F.lead("lo").over(order)})

    def shared(a: str, b: str):
        return F.expr(f"""if({a} is null or {b} is null, -1, aggregate(
            sequence(0, cast(least(length({a}), length({b})) / {DIGEST} as int)), 0, (n, i) ->
            if(n = i and i * {DIGEST} < least(length({a}), length({b}))
               and substring({a}, i * {DIGEST} + 1, {DIGEST})
                   = substring({b}, i * {DIGEST} + 1, {DIGEST}), n + 1, n)))""")

    return beside.select("part", shared("prev", "lo").alias("before"),
                         shared("hi", "next").alias("after"))


def common_turns(a: bytes, b: bytes) -> int:
    """How many leading turns two paths share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))) // DIGEST


@dataclass
class Shard:
    """Consecutive sequences of the sorted order. ``before`` and ``after`` are the turns that the
    first and the last one share with their neighbours outside."""

    before: int
    after: int = -1
    rows: list[dict] = field(default_factory=list)
    turns: int = 0


def shards(batches: Iterator[pa.RecordBatch], shard_turns: int) -> Iterator[Shard]:
    """Cut a sorted stream of sequences into shards of about ``shard_turns`` turns."""
    shard, part, after = None, None, -1
    for batch in batches:
        for row in batch.to_pylist():
            if shard is not None and part != row["part"]:
                shard.after = after
                yield shard
                shard = None
            elif shard is not None and shard.turns >= shard_turns:
                shard.after = common_turns(shard.rows[-1]["path"], row["path"])
                yield shard
                shard = Shard(before=shard.after)
            if shard is None:
                shard = Shard(before=row["before"])
            part, after = row["part"], row["after"]
            shard.rows.append(row)
            shard.turns += len(row["sizes"])
    if shard is not None:
        shard.after = after
        yield shard


class DoubleArray:
    """A trie of sorted distinct sequences: ``base[s] + code`` is the slot of the child of slot
    ``s`` by the turn ``code``, and ``check`` of that slot is ``s``. Slot 0 is the root."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
                 shared: np.ndarray):
        self.codes, self.starts, self.lengths = codes, starts, lengths
        self.base = np.zeros(1024, np.int64)
        self.check = np.full(1024, -1, np.int64)
        self.check[0] = 0
        self.free_from = self.end = 1
        state = np.zeros(len(lengths), np.int64)
        active = np.arange(len(lengths))
        for depth in range(1, int(lengths.max(initial=0)) + 1):
            active = active[lengths[active] >= depth]
            code = codes[starts[active] + depth - 1]
            # a sequence opens a node where it leaves the one before it
            opens = shared[active] < depth
            slots = self._place(state[active[opens]], code[opens])
            state[active] = slots[np.cumsum(opens) - 1]

    def _room(self, end: int) -> None:
        while len(self.check) < end:
            self.base = np.concatenate((self.base, np.zeros(len(self.base), np.int64)))
            self.check = np.concatenate((self.check, np.full(len(self.check), -1, np.int64)))

    def _place(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Slots for children that stand together by parent: nodes with several children first,
        each where all of its codes fall on free slots; only children then fill the gaps."""
        slots = np.empty(len(parents), np.int64)
        begin, end = runs(parents)
        many = np.flatnonzero(end - begin > 1)
        for i in many[np.argsort(begin[many] - end[many], kind="stable")]:
            mine = codes[begin[i]:end[i]]
            base = self._fit(mine)
            slots[begin[i]:end[i]] = self._take(base + mine, parents[begin[i]], base)
        only = begin[end - begin == 1]
        self._room(self.end + len(only))
        free = self.free_from + np.flatnonzero(
            self.check[self.free_from:self.end + len(only)] < 0)[:len(only)]
        slots[only] = free
        self.base[parents[only]] = free - codes[only]
        self.check[free] = parents[only]
        if len(free):
            self.end = max(self.end, int(free[-1]) + 1)
        taken = np.flatnonzero(self.check[self.free_from:self.end] < 0)
        self.free_from = self.free_from + int(taken[0]) if len(taken) else self.end
        return slots

    def _fit(self, codes: np.ndarray) -> int:
        low, width = int(codes.min()), int(codes.max() - codes.min()) + 1
        self._room(self.end + width)
        gaps = self.free_from + np.flatnonzero(self.check[self.free_from:self.end] < 0)
        gaps = gaps[:max(1, min(TRIED, (1 << 20) // len(codes)))]
        if len(gaps):
            self._room(int(gaps[-1]) + width)
            fits = (self.check[gaps[:, None] + (codes - low)] < 0).all(axis=1)
            if fits.any():
                return int(gaps[np.argmax(fits)]) - low
        return self.end - low

    def _take(self, slots: np.ndarray, parent: int, base: int) -> np.ndarray:
        self.base[parent] = base
        self.check[slots] = parent
        self.end = max(self.end, int(slots.max()) + 1)
        return slots

    def levels(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Walk all sequences through the arrays: per depth the sequences that get there and the
        slots they are in."""
        state = np.zeros(len(self.lengths), np.int64)
        active = np.arange(len(self.lengths))
        yield active, state
        for depth in range(1, int(self.lengths.max(initial=0)) + 1):
            active = active[self.lengths[active] >= depth]
            slots = self.base[state[active]] + self.codes[self.starts[active] + depth - 1]
            if (self.check[slots] != state[active]).any():
                raise RuntimeError("a sequence fell out of its double array")
            state[active] = slots
            yield active, slots


def dense_codes(flat: bytes, lengths: np.ndarray) -> np.ndarray:
    """Numbers 0..k-1 for the distinct turns, in the order in which a walk by levels meets them:
    the children of a node then have codes close to each other."""
    total = int(lengths.sum())
    sequence = np.repeat(np.arange(len(lengths)), lengths)
    depth = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    by_level = np.lexsort((sequence, depth))
    turns = np.frombuffer(flat, np.dtype((np.void, DIGEST)))[by_level]
    named = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(DIGEST), total, [None, pa.py_buffer(turns.tobytes())]).dictionary_encode()
    codes = np.empty(total, np.int64)
    codes[by_level] = named.indices.to_numpy(zero_copy_only=False)
    return codes


def shard_nodes(shard: Shard, number: int) -> pa.RecordBatch:
    """The nodes of one shard with their sums.

    Sums are such that adding them up over shards is right: a childless node is never one that an
    earlier shard has too, and the bytes of a node and the node as a child count in the first
    shard that has it.
    """
    rows = shard.rows
    paths = [row["path"] for row in rows]
    lengths = np.array([len(p) // DIGEST for p in paths], np.int64)
    starts = np.cumsum(lengths) - lengths
    shared = np.array([0] + [common_turns(a, b) for a, b in zip(paths, paths[1:])], np.int64)
    codes = dense_codes(b"".join(paths), lengths)
    sizes = np.array([s for row in rows for s in row["sizes"]], np.int64)
    members = np.array([row["n_convs"] for row in rows], np.int64)
    ids = np.array([row["conv_id"] for row in rows], np.int64)
    trie = DoubleArray(codes, starts, lengths, shared)

    width = trie.end
    n, least = np.zeros(width, np.int64), np.full(width, np.iinfo(np.int64).max)
    depths, size = np.full(width, -1, np.int64), np.zeros(width, np.int64)
    ends: list[str | None] = [None] * width
    seen = np.zeros(width, bool)
    keys: dict[int, bytes] = {}
    by_level = []
    for depth, (active, slots) in enumerate(trie.levels()):
        np.add.at(n, slots, members[active])
        np.minimum.at(least, slots, ids[active])
        depths[slots] = depth
        if depth:
            size[slots] = sizes[starts[active] + depth - 1]
        for at in np.flatnonzero(lengths[active] == depth):
            ends[slots[at]] = rows[active[at]]["ends"]
        for at, bound, earlier in ((0, shard.before, True), (-1, shard.after, False)):
            if depth <= bound:
                slot = int(slots[at])
                seen[slot] |= earlier
                keys[slot] = hashlib.sha256(paths[at][:depth * DIGEST]).digest()[:DIGEST]
        by_level.append(np.unique(slots))

    parents = trie.check[:width]
    children, local = np.zeros(width, np.int64), np.zeros(width, np.int64)
    for level in by_level[1:]:
        np.add.at(local, parents[level], 1)
        np.add.at(children, parents[level], ~seen[level])
    leaves = (local == 0).astype(np.int64)
    if shard.after == lengths[-1]:  # the last sequence goes on in the next shard
        leaves[_end_slot(trie, -1)] = 0
    saved = n * size - np.where(seen, 0, size)
    for level in reversed(by_level[1:]):
        np.add.at(leaves, parents[level], leaves[level])
        np.add.at(saved, parents[level], saved[level])

    found = np.concatenate(by_level)
    over = parents[found]
    is_root = found == 0
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(found), number)),
        pa.array([keys.get(s) for s in found.tolist()], pa.binary()),
        pa.array([None if s == 0 else keys.get(p) for s, p in zip(found.tolist(), over.tolist())],
                 pa.binary()),
        pa.array(least[found]), pa.array(depths[found]), pa.array(least[over], mask=is_root),
        pa.array(n[found]), pa.array(children[found]), pa.array(leaves[found]),
        pa.array(saved[found]), pa.array([ends[s] for s in found.tolist()], pa.string()),
    ], schema=NODE)


def _end_slot(trie: DoubleArray, at: int) -> int:
    """The slot in which a sequence ends."""
    slot, start = 0, int(trie.starts[at])
    for code in trie.codes[start:start + int(trie.lengths[at])].tolist():
        slot = int(trie.base[slot]) + code
    return slot


def _trie_rows(batches: Iterator[pa.RecordBatch], shard_turns: int) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    for number, shard in enumerate(shards(batches, shard_turns)):
        yield shard_nodes(shard, first + number)
