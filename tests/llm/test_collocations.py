"""Phrase counts and collocations against plain ones, with any number of shards and slots."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
from corpus_samples import frame, messy_rows

from casestar.llm import collocations


def plain_counts(rows) -> dict[str, Counter]:
    counts = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang][" ".join(words[i:i + k])] += 1
    return counts


def plain(rows, top=2000, threshold=10, inside=50) -> Counter:
    found = []
    for lang, f in plain_counts(rows).items():
        n = sum(c for phrase, c in f.items() if " " not in phrase)
        held = defaultdict(int)
        for phrase, c in f.items():
            words = phrase.split(" ")
            if len(words) == 3 and c >= threshold:
                for part in (" ".join(words[:2]), " ".join(words[1:])):
                    held[part] = max(held[part], c)
        scored = []
        for phrase, a in f.items():
            words = phrase.split(" ")
            if len(words) == 1 or a < threshold or 100 * held[phrase] >= inside * a > 0 and (
                    len(words) == 2 and held[phrase]):
                continue
            cuts = []
            for k in range(1, len(words)):
                left, right = f[" ".join(words[:k])], f[" ".join(words[k:])]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            scored.append((-score, -a, phrase.encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], start=1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return Counter(found)


def found(docs, **options) -> Counter:
    return Counter(map(tuple, collocations.collocations(docs, **options).collect()))


def sayings(seed: int, n: int) -> list[tuple]:
    draw = random.Random(seed)
    words = ["the", "The", "of", "new", "York", "state", "é", "ü.", "a,b", "x\ty", "z  z", "Q!", "\n"]
    weights = [9, 3, 5, 4, 4, 2, 1, 1, 1, 1, 1, 1, 1]
    rows = [(i, " ".join(draw.choices(words, weights, k=draw.randrange(0, 40))),
             draw.choice(["en", "en", None, "de"]), "s", 0) for i in range(n)]
    # a third of the table is one text in one language
    return rows + [(None, "of the very common phrase", "en", "s", 0)] * (n // 2)


def test_any_shards_and_slots_give_the_plain_result(spark):
    rows = sayings(1, 160)
    docs = frame(spark, rows)
    wanted = plain(rows)
    assert found(docs) == wanted
    assert found(docs, shards=1) == wanted
    # four slots: nearly every phrase shares its slot with others
    assert found(docs, shards=4, slots=4) == wanted
    assert found(docs, top=3, threshold=4, inside_percent=80) == plain(rows, 3, 4, 80)


def test_messy_and_empty_tables(spark, messy, nothing):
    assert found(messy) == plain(messy_rows())
    assert found(messy, threshold=2, shards=2) == plain(messy_rows(), threshold=2)
    assert found(nothing) == Counter()


def test_chunks_keep_pieces_whole():
    texts = [b"A b. c d e f, g" * 40, b"", b"x" * 90, b"y z"]
    for size in (1, 7, 50, 10_000):
        pieces = [p for chunk in collocations.chunks(texts, size) for p in chunk.split(b"\xff")]
        whole = [p for t in texts for p in re.split(rb"[.,]", t.lower())]
        assert [p for p in pieces if p] == [p for p in whole if p]


def test_slots_of_a_phrase_follow_from_its_words():
    hashes = collocations.word_hashes("en", [b"a", b"b", b"c"])
    pairs = collocations.phrase_slots(collocations.phrase_hashes([hashes[:2], hashes[1:]]), 1 << 20)
    assert pairs.tolist() == [collocations.key_slot(b"en\xffa b", 1 << 20),
                              collocations.key_slot(b"en\xffb c", 1 << 20)]
    assert collocations.word_hashes("de", [b"a"])[0] != hashes[0]
    assert (collocations.phrase_slots(np.arange(99, dtype=np.uint64), 5) < 5).all()
