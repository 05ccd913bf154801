"""Quality rules, mixing, sharding."""

from __future__ import annotations

import random
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F
from corpus_samples import frame, messy_rows, prose

from casestar.llm import mixing, quality, sharding
from casestar.llm.common import permuted, running_start


def plain_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = text.encode().split()
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1
               for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words),
            sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts(messy):
    found = Counter(tuple(r)[:6] for r in quality.quality_rules(messy).collect())
    assert found == Counter((r[0], *plain_counts(r[1])) for r in messy_rows())


def test_rules_adapt_and_keep_clean_documents(spark):
    clean = [(i, prose(i, 80), "en", "ab"[i % 2], 1) for i in range(400)]
    # one source writes longer words: normal there, odd in another
    long = [(1000 + i, " ".join(f"{w}abcdefghij" for w in prose(i, 60).split(" ")), "en", "c", 1)
            for i in range(200)]
    odd = [(2000, long[0][1], "en", "a", 1), (2001, " ".join(
        f"{w} ###" for w in prose(9, 50).split(" ")), "en", "b", 1)]
    kept = {r["doc_id"]: r["kept"] for r in
            quality.quality_rules(frame(spark, clean + long + odd)).collect()}
    assert all(kept[r[0]] for r in clean + long)
    assert not kept[2000] and not kept[2001]


def test_rules_on_messy_and_empty_tables(messy, nothing):
    kept = quality.kept_documents(messy)
    assert kept.columns == messy.columns
    found = {r["doc_id"] for r in kept.collect()}
    assert {1, 2, 3, 7, 8, 11} <= found and not {4, 5, 6, 9, 12, 14} & found
    assert quality.quality_rules(nothing).count() == quality.kept_documents(nothing).count() == 0


def test_buckets_are_monotone(spark):
    rows = spark.range(0, 5000).select(
        "id", quality.bucket_of(F.col("id")).alias("b")).withColumn(
        "start", quality.bucket_start(F.col("b"))).orderBy("id").collect()
    assert all(a["b"] <= b["b"] for a, b in zip(rows, rows[1:]))
    assert all(r["start"] <= r["id"] <= r["start"] * 17 / 16 + 1 for r in rows)


def water_level(sizes: list[int], weights: list[int]) -> list[float]:
    total, capped = 1.5 * sum(sizes), set()
    while True:
        left = total - sum(2 * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        over = {i for i in range(len(sizes)) if i not in capped
                and left * weights[i] / weight > 2 * sizes[i]}
        if not over:
            return [2.0 * sizes[i] if i in capped else left * weights[i] / weight
                    for i in range(len(sizes))]
        capped |= over


def test_mix_meets_targets(spark):
    draw = random.Random(5)
    rows = [(i, prose(i, draw.randrange(1, 300)), "en", draw.choice(
        ["s1", "s10", "s2", "é", None, "big", "big", "big"]), 1) for i in range(1500)]
    found = mixing.mixed(frame(spark, rows)).collect()
    again = mixing.mixed(frame(spark, rows[::-1])).collect()
    assert Counter(found) == Counter(again)
    sources = sorted({r[3] for r in rows} - {None}, key=lambda s: [ord(c) for c in s]) + [None]
    sizes = [sum(len(r[1].split()) for r in rows if r[3] == s) for s in sources]
    levels = water_level(sizes, [[5, 2, 1][i % 3] for i in range(len(sources))])
    source_of, taken = {r[0]: r[3] for r in rows}, defaultdict(int)
    for r in found:
        at = sources.index(source_of[r["doc_id"]])
        assert r["source_size"] == sizes[at] and r["target"] == pytest.approx(levels[at])
        assert r["taken"] <= 2 * r["size"]
        taken[at] += r["taken"]
    assert all(abs(taken[i] - levels[i]) < 1.5 * 64 for i in range(len(sources)))


def test_mix_on_messy_and_empty_tables(messy, nothing):
    rows = messy_rows()
    found = mixing.mixed(messy).collect()
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter(
        (r[0], len((r[1] or "").encode().split())) for r in rows)
    assert mixing.mixed(nothing).count() == 0
    repeated = mixing.mixed_documents(messy)
    assert repeated.columns == messy.columns
    assert set(map(tuple, repeated.collect())) <= set(map(tuple, messy.collect()))
    assert mixing.mixed_documents(nothing).count() == 0


def plain_draws(slots: dict[int, int], shard_slots: int, seed: int) -> Counter:
    """Each slot draws a place of all; the source is the one that the place falls to. The sources
    lie in the order that the operator's running sums give them."""
    order = sorted(slots, key=lambda s: (signed_hash(s) % 1024, s))
    owners = [s for s in order for _ in range(slots[s])]
    return Counter((i // shard_slots, owners[signed_hash(i, seed) % len(owners)])
                   for i in range(len(owners)))


def signed_hash(value: int, seed: int | None = None) -> int:
    digest = xxhash.xxh64_intdigest(struct.pack("<q", value), 42)
    if seed is not None:
        digest = xxhash.xxh64_intdigest(struct.pack("<i", seed), digest)
    return digest - (1 << 64) if digest >> 63 else digest


def test_draws_equal_a_plain_version(spark):
    slots = {1: 900, 2: 0, 3: 41, 4: 2500, 5: 1, 6: 5000}
    rows = [(s, n, max(n, 1)) for s, n in slots.items()]
    sources = spark.createDataFrame(rows, "source_no long, slots long, blocks long")
    found = {(r["shard"], r["source_no"]): r["drawn"]
             for r in mixing.drawn_counts(sources, 256, 17).collect()}
    assert found == plain_draws(slots, 256, 17)
    # a multinomial draw spreads as one: a source of half the mix varies by about 8 in 256
    half = [found[(shard, 6)] for shard in range(sum(slots.values()) // 256)]
    share = slots[6] / sum(slots.values())
    spread = (sum((x - 256 * share) ** 2 for x in half) / len(half)) ** 0.5
    assert 0.6 < spread / (256 * share * (1 - share)) ** 0.5 < 1.5


@pytest.mark.parametrize("shard_slots", [1, 64, 10 ** 6])
def test_slots_are_full_and_blocks_are_read_in_turn(spark, shard_slots):
    rows = [(1, 900, 600), (2, 0, 0), (3, 41, 41), (4, 2500, 1250), (5, 1, 9), (6, 700, 350)]
    sources = spark.createDataFrame(rows, "source_no long, slots long, blocks long")
    mix = mixing.mix_slots(sources, shard_slots).collect()
    total = sum(r[1] for r in rows)
    assert Counter((r["shard"] * shard_slots + r["place"]) for r in mix) == Counter(range(total))
    times = Counter((r["source_no"], r["block"]) for r in mix)
    for source, slots, blocks in rows:
        mine = {b: n for (s, b), n in times.items() if s == source}
        assert sum(mine.values()) == slots and all(0 <= b < blocks for b in mine)
        assert all(slots // blocks <= mine.get(b, 0) <= -(-slots // blocks)
                   for b in range(blocks))
    # only slots drawn beyond a source's own are dealt again
    drawn = {(r["shard"], r["source_no"]): r["drawn"]
             for r in mixing.drawn_counts(sources, shard_slots).collect()}
    in_mix = Counter((r["shard"], r["source_no"]) for r in mix)
    moved = sum((Counter(drawn) - in_mix).values())
    so_far = Counter()
    for (_, source), n in drawn.items():
        so_far[source] += n
    assert moved == sum(max(so_far[s] - n, 0) for s, n, _ in rows)


def test_the_mix_holds_what_is_taken(messy, nothing):
    words = {r[0]: (r[1] or "").encode().split() for r in messy_rows()}
    spans = mixing.mix_spans(messy, block_words=16, shard_slots=32).collect()
    taken = Counter()
    for r in spans:
        assert 0 <= r["from_word"] and r["from_word"] + r["words"] <= r["size"]
        taken[(r["doc_id"], r["size"])] += r["words"]
    sums = Counter()
    for r in mixing.mixed(messy, block_words=16).collect():
        sums[(r["doc_id"], r["size"])] += r["taken"]
    assert +sums == +taken
    assert all(size == len(words[doc]) for doc, size in taken if doc is not None)
    slots = defaultdict(list)
    for r in spans:
        slots[(r["shard"], r["place"])].append((r["offset"], r["words"]))
    for pieces in slots.values():  # pieces follow each other and fill the block
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 16
    assert mixing.mix_spans(nothing).count() == 0


def test_mix_is_native(messy):
    plan = mixing.mixed(messy)._jdf.queryExecution().executedPlan().toString()
    slots = mixing.mix_spans(messy)._jdf.queryExecution().executedPlan().toString()
    assert "place" in slots and "shard" in slots
    assert not any(x in plan + slots
                   for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000, 1048573, 2 * 1048573])
def test_permutation(spark, size):
    places = permuted(spark.range(size).withColumn("n", F.lit(size).cast("long")), "id", "n", "3",
                      "at").agg(F.min("at"), F.max("at"), F.count_distinct("at")).first()
    assert tuple(places) == (0, size - 1, size)


def test_running_start(spark):
    rows = [(i, i % 3, (i * 7) % 11) for i in range(300)]
    found = running_start(spark.createDataFrame(rows, "id long, g int, v long"), ["g"], ["id"],
                          "v", "start", salts=8).collect()
    for g in range(3):
        at = 0
        for r in sorted((r for r in found if r["g"] == g), key=lambda r: (r["start"], r["v"])):
            assert r["start"] == at
            at += r["v"]


def test_shards(messy, nothing):
    rows = messy_rows()
    found = sharding.balanced_shards(messy, shards=4).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts, shards = {r[0]: r[1] for r in rows}, defaultdict(set)
    for r in found:
        if r["doc_id"] is not None:
            shards[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())
    assert sharding.balanced_shards(nothing).count() == 0


def test_kept_columns_stay_with_their_rows(messy, nothing):
    found = sharding.balanced_shards(messy, shards=4, keep=("text", "source", "_kept")).collect()
    assert Counter((r["doc_id"], r["text"], r["source"], r["_kept"]) for r in found) == Counter(
        (r[0], r[1], r[3], "x") for r in messy_rows())
    assert all(zlib.crc32((r["text"] or "").encode()) == r["text_crc32"] for r in found)
    plain = sharding.balanced_shards(messy, shards=4)
    assert "text" not in plain.columns and plain.count() == len(found)
    assert sharding.balanced_shards(nothing, keep=("text",)).count() == 0


def plain_differencing(sizes, shards):
    """Largest differencing over lists of members, straight from its definition."""
    parts = [[[(s, i)]] + [[] for _ in range(shards - 1)] for i, s in enumerate(sizes)]

    def sums(part):
        return sorted((sum(s for s, _ in one) for one in part), reverse=True)

    parts = [(sums(p)[-1] - sums(p)[0], n, p) for n, p in enumerate(parts)]
    number = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: p[:2])
        (_, _, a), (_, _, b), *parts = parts
        a = sorted(a, key=lambda one: -sum(s for s, _ in one))
        b = sorted(b, key=lambda one: sum(s for s, _ in one))
        both = [x + y for x, y in zip(a, b)]
        parts.append((sums(both)[-1] - sums(both)[0], number, both))
        number += 1
    return sums(parts[0][2])


def test_differencing_equals_a_plain_version():
    draw = random.Random(4)
    for _ in range(40):
        sizes = [draw.randrange(1, 1000) for _ in range(draw.randrange(1, 30))]
        shards = draw.randrange(2, 6)
        sums = [0] * shards
        for size, shard in zip(sizes, sharding.differenced(sizes, shards)):
            sums[shard] += size
        assert sorted(sums, reverse=True) == plain_differencing(sizes, shards)


def test_differencing_balances():
    draw = random.Random(2)
    sizes = [draw.randrange(1, 5000) for _ in range(2000)]
    sums = Counter()
    for size, shard in zip(sizes, sharding.differenced(sizes, 24)):
        sums[shard] += size
    assert len(sums) == 24 and max(sums.values()) - min(sums.values()) <= 3
    big = [10 ** 6] + sizes[:200]  # more than a fair share: alone in its shard
    placed = sharding.differenced(big, 4)
    assert placed.count(placed[0]) == 1
    assert sharding.differenced([], 3) == [] and sharding.differenced([5], 3) == [0]
