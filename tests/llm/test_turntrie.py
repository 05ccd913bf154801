"""The conversation trie against a plain one, with shards of a few turns."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from casestar.llm import turntrie

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows) -> Counter:
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append(((turn is not None, turn or 0), digest, role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(found)] for c, found in own.items()}
    paths = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = turns.get(c - int(np.fmod(c, 5)), [])[:h] + mine[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in paths.items():
        ends[tuple(path)].append(c)
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    below = defaultdict(set)
    for node in members:
        if node:
            below[node[:-1]].add(node)
    leaves, saved = Counter(), Counter()
    for node, found in members.items():
        own_saved = (len(found) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not below[node]
            saved[node[:d]] += own_saved
    return Counter(
        (min(found), len(node), min(members[node[:-1]]) if node else None, len(found),
         len(below[node]), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, found in members.items())


def found(conversations, **options) -> Counter:
    frame = turntrie.prefix_trie(turntrie.rebuilt(conversations), **options)
    return Counter(tuple(r) for r in frame.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect())


def dialogues(seed: int, n: int, words: int = 3, longest: int = 9) -> list[tuple]:
    draw = random.Random(seed)
    rows = [(c, t, draw.choice(["user", "tool"]), f"é{draw.randrange(words)}")
            for c in range(0, 3 * n, 3) for t in range(draw.randrange(1, longest))]
    # a third of the conversations are one
    rows += [(10_000 + c, t, "user", "same") for c in range(n // 2) for t in range(4)]
    draw.shuffle(rows)
    return rows


def messy() -> list[tuple]:
    return [(None, 1, "user", "lost"), (1, None, "user", "first"), (1, 0, None, None),
            (1, 0, "user", ""), (1, 0, "user", ""), (2, 5, "", "x" * 50_000), (2, -5, "a", "b:c"),
            (3, 1, "a:b", "c"), (-7, 1, "u", "t"), (-5, 1, "u", "t"), (-6, 2, "u", "t"),
            (2**62, 1, "user", "first"), (7, 3, None, "ünï"), (5, 1, "user", "first")]


def test_shards_of_any_size_give_the_plain_trie(spark, conf):
    rows = dialogues(1, 120) + messy()
    frame = spark.createDataFrame(rows, TURNS).repartition(3)
    wanted = plain(rows)
    assert found(frame) == wanted
    for turns in (1, 7, 200):
        assert found(frame, shard_turns=turns) == wanted
    conf("spark.sql.shuffle.partitions", "5")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    assert found(frame, shard_turns=30) == wanted


def test_long_conversations_and_many_continuations(spark):
    rows = [(c, t, "user", f"{t}" if t < 300 else f"{t}-{c % 7}") for c in range(0, 100, 5)
            for t in range(320)]
    rows += [(1000 + c, t, "u", f"{t}" if t == 0 else f"{c}-{t}") for c in range(300)
             for t in range(3)]
    frame = spark.createDataFrame(rows, TURNS).repartition(3)
    assert found(frame, shard_turns=500) == plain(rows)


def test_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame(messy(), TURNS)
    extra = frame.select("*", *[F.lit("x").alias(c) for c in
                                ("path", "sizes", "own", "lead", "h", "t", "key", "part", "block")])
    assert found(extra) == plain(messy())
    assert found(extra.limit(0)) == Counter()


def test_double_array_finds_every_sequence_and_no_other():
    draw = random.Random(3)
    for _ in range(60):
        paths = sorted({tuple(draw.randrange(6) for _ in range(draw.randrange(0, 6)))
                        for _ in range(40)})
        lengths = np.array([len(p) for p in paths])
        starts = np.cumsum(lengths) - lengths
        shared = np.array([0] + [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y),
                                      min(len(a), len(b))) for a, b in zip(paths, paths[1:])])
        codes = np.array([c for p in paths for c in p], np.int64)
        trie = turntrie.DoubleArray(codes, starts, lengths, shared)
        nodes = {p[:d] for p in paths for d in range(len(p) + 1)}
        assert len(np.unique(np.concatenate([s for _, s in trie.levels()]))) == len(nodes)
        slots = {(): 0}
        for node in sorted(nodes, key=len):
            for code in range(6):
                slot = int(trie.base[slots[node]]) + code
                inside = 0 < slot < trie.end and trie.check[slot] == slots[node]
                if (*node, code) in nodes:
                    assert inside
                    slots[(*node, code)] = slot
                elif any(n[:-1] == node for n in nodes if n):
                    assert not inside
