from __future__ import annotations

import random
from collections import Counter

import numpy as np
import xxhash
from corpus_samples import messy_rows, prose

from casestar.llm import simhash
from casestar.llm.components import components


def plain_fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[int], max_bits: int) -> list[int]:
    root = list(range(len(prints)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_messy_documents(messy):
    rows = messy_rows()
    prints = [plain_fingerprint(r[1]) for r in rows]
    groups = plain_components(prints, 4)
    first = {g: min((r[0] for r, h in zip(rows, groups) if h == g and r[0] is not None),
                    default=None) for g in groups}
    wanted = Counter((r[0], p, first[g]) for r, p, g in zip(rows, prints, groups))
    found = Counter((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"])
                    for r in simhash.near_duplicates(messy).collect())
    assert found == wanted


def clustered(seed: int) -> list[int]:
    """Dense groups, chains of single steps, and strangers."""
    draw = random.Random(seed)
    prints = [draw.getrandbits(64) for _ in range(200)]
    for center in prints[:3]:
        prints += [center ^ sum(1 << draw.randrange(64) for _ in range(draw.randrange(6)))
                   & (1 << 64) - 1 for _ in range(150)]
    at = draw.getrandbits(64)
    for _ in range(60):
        at ^= sum(1 << b for b in draw.sample(range(64), 4))
        prints.append(at)
    return sorted(set(prints))


def test_links_lose_no_pair(spark):
    prints = clustered(3)
    wanted = plain_components(prints, 4)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    for blocks, cell_rows in ((5, 20_000), (6, 20_000), (6, 20), (8, 20_000), (10, 20_000)):
        links = simhash.links(frame, blocks, 4, cell_rows)
        root = {r["node"] & (1 << 64) - 1: r["root"] for r in
                components(links, "a", "b", "test").collect()}
        found = [root.get(p, p) for p in prints]
        assert len(set(zip(found, wanted))) == len(set(found)) == len(set(wanted))


def test_blocks_follow_the_number_of_prints(monkeypatch, messy):
    sizes = [10 ** k for k in range(13)]
    chosen = [simhash.blocks_for(n, 4) for n in sizes]
    assert chosen == sorted(chosen) and chosen[0] == 6 and chosen[-1] >= 10
    assert simhash.blocks_for(250_000, 4) == 6 and simhash.blocks_for(10 ** 8, 4) == 8
    assert all(simhash.blocks_for(n, 0) >= 2 for n in sizes)
    found = Counter(map(tuple, simhash.near_duplicates(messy).collect()))
    monkeypatch.setattr(simhash, "ROW_COST", 0)  # as if comparing were all that counts
    assert simhash.blocks_for(60, 4) == 12
    assert Counter(map(tuple, simhash.near_duplicates(messy, blocks=9).collect())) == found


def test_embedding_is_a_lower_bound():
    draw = np.random.default_rng(1)
    prints = draw.integers(0, 1 << 63, 400, dtype=np.uint64)
    totals = np.column_stack([np.bitwise_count(prints & np.uint64(m)) for m in simhash._masks(6)])
    for i in range(0, 400, 2):
        bound = np.abs(totals[i].astype(int) - totals[i + 1].astype(int)).sum()
        assert bound <= (int(prints[i]) ^ int(prints[i + 1])).bit_count()


def test_one_of_each_stays(messy):
    kept = simhash.first_of_each(messy)
    assert kept.columns == messy.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 7, 8, 9, 11} <= set(ids) and not {2, 3} & set(ids)


def test_different_texts_under_one_id_stay(spark):
    rows = [(1, prose(1, 80)), (1, prose(2, 80)), (None, prose(3, 80)), (None, prose(4, 80)),
            (None, prose(1, 80)), (5, prose(2, 80)), (1, prose(1, 80)), (6, prose(3, 80))]
    found = simhash.first_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, found.collect())) == Counter(
        [rows[0], rows[1], rows[3], rows[7]])


def test_chain_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (101, 102)],
                                  "a long, b long")
    found = {r["node"]: r["root"] for r in components(edges, "a", "b", "test").collect()}
    assert found == {**{i: 0 for i in range(61)}, 101: 101, 102: 101}


def test_empty_table(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.first_of_each(nothing).count() == 0
