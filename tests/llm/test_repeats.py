"""Substring removal over words and bytes against plain versions."""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
import pytest
from corpus_samples import frame, messy_rows, prose

from casestar.llm import repeats, rlz, suffixes


def by_words(rows, width):
    first = {}
    for doc, text, *_ in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - width + 1):
            if doc is not None:
                key = tuple(words[i:i + width])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text, *_ in rows:
        words = (text or "").encode().split()
        hit = [False] * len(words)
        for i in range(len(words) - width + 1):
            if doc is not None and first[tuple(words[i:i + width])] < doc:
                hit[i:i + width] = [True] * width
        kept = b" ".join(w for w, h in zip(words, hit) if not h)
        out.append((doc, len(words), sum(hit), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def by_bytes(rows, width):
    texts = [(doc, (text or "").encode()) for doc, text, *_ in rows]
    times = Counter(t[i:i + width] for _, t in texts for i in range(len(t) - width + 1))
    out = []
    for doc, t in texts:
        hit = [False] * len(t)
        for i in range(len(t) - width + 1):
            if times[t[i:i + width]] > 1:
                hit[i:i + width] = [True] * width
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        kept = bytes(b for b, h in zip(t, hit) if not h)
        out.append((doc, len(t), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("piece, crowd", [(1 << 20, 1000), (500, 1000), (1 << 20, 1)])
def test_words_equal_plain_version(messy, monkeypatch, piece, crowd):
    monkeypatch.setattr(repeats, "PIECE", piece)
    monkeypatch.setattr(repeats, "CROWD", crowd)
    assert Counter(map(tuple, rlz.without_copied(messy).collect())) == by_words(messy_rows(), 13)


@pytest.mark.parametrize("piece, crowd", [(1 << 20, 1000), (700, 1000), (1 << 20, 1)])
def test_bytes_equal_plain_version(messy, monkeypatch, piece, crowd):
    monkeypatch.setattr(repeats, "PIECE", piece)
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rows = messy_rows()
    assert Counter(map(tuple, suffixes.without_repeats(messy).collect())) == by_bytes(rows, 400)


@pytest.mark.parametrize("crowd", [1000, 2, 0])
def test_partial_overlaps_at_every_length(spark, monkeypatch, crowd):
    """Passages shared to different lengths, so that matches end inside phrases, whose grams are
    in crowds or not."""
    monkeypatch.setattr(repeats, "CROWD", crowd)
    passage = prose(50, 60).split(" ")
    rows = [(i, " ".join([f"l{i}"] * 3 + passage[i:i + 10 + i] + [f"r{i}"] * 3), "en", "a", 1)
            for i in range(40)]
    docs = frame(spark, rows)
    assert Counter(map(tuple, rlz.without_copied(docs).collect())) == by_words(rows, 13)
    assert Counter(map(tuple, suffixes.without_repeats(docs, 60).collect())) == by_bytes(rows, 60)


def test_a_third_of_the_rows_without_id(spark, monkeypatch):
    """Rows without an id share passages with each other and with the rest, and are spread."""
    monkeypatch.setattr(repeats, "CROWD", 20)
    shared = [prose(900 + i, 40) for i in range(30)]
    rows = [(None if i % 3 == 0 else i, f"{prose(2000 + i, 12)} {shared[i % 30]} {prose(i, 8)}",
             "en", "a", 1) for i in range(2400)]
    rows += [(None, prose(5, 60), "en", "a", 1)] * 2 + [(None, None, None, None, None)] * 3
    docs = frame(spark, rows)
    assert Counter(map(tuple, rlz.without_copied(docs).collect())) == by_words(rows, 13)
    assert Counter(map(tuple, suffixes.without_repeats(docs, 60).collect())) == by_bytes(rows, 60)
    keys = repeats.keyed_rows(docs).where("text is not null").groupBy("doc").count()
    assert keys.agg({"count": "max"}).first()[0] == 2


def test_groups_are_cut_where_keys_change():
    """Whole groups come out whatever the batches they arrive in."""
    keys = [0] * 7 + [1] + [2] * 4 + [3, 4] + [5] * 9
    second = [x // 3 for x in range(len(keys))]
    for width in (1, 2, 5, 30):
        for columns in (1, 2):
            batches = [pa.RecordBatch.from_arrays(
                [pa.array(c[at:at + width], pa.int64()) for c in (keys, second)], names=["a", "b"])
                for at in range(0, len(keys), width)]
            out = [list(zip(*(c.to_pylist() for c in b.columns)))
                   for b in repeats._grouped(iter(batches), 3, columns)]
            assert [row for part in out for row in part] == list(zip(keys, second))
            marks = [{row[:columns] for row in part} for part in out]
            assert sum(map(len, marks)) == len(set().union(*marks))


def test_empty_tables(nothing):
    assert rlz.without_copied(nothing).count() == 0
    assert suffixes.without_repeats(nothing).count() == 0


def test_passages_of_over_50_words_go_if_they_have_400_bytes(spark):
    """The strings of op3 are counted in bytes: 60 short words are fewer than 400 of them."""
    rows, planted = [], {}
    for i in range(40):
        passage = " ".join(f"{'p' * (1 + i % 8)}{(i * 61 + j) % 97}" for j in range(60))
        for doc in (2 * i, 2 * i + 1):
            rows.append((doc, f"l{doc}|{passage}|{doc}r", "en", "a", 1))
            planted[doc] = len(passage) + 2
    found = suffixes.without_repeats(frame(spark, rows)).collect()
    assert Counter(map(tuple, found)) == by_bytes(rows, 400)
    assert {r.doc_id for r in found if r.n_removed} == {d for d, n in planted.items() if n >= 400}
    assert 0 < sum(n >= 400 for n in planted.values()) < len(planted)
