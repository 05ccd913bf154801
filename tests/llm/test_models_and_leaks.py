"""Edit matching, co-training, the pipeline and the registered queries."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus_samples import frame, messy_rows, prose
from oracle_check import connect, differences

import __spark_entry__ as driver
import corpus_pipeline
from casestar.llm import cotraining, decontamination, oracle, queries, simhash

SMALL = "/root/testdata/sf0.001"


def plain_distance(item: str, text: str) -> int:
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        last, row[0] = row[0], 0
        for i, x in enumerate(item):
            last, row[i + 1] = row[i + 1], min(last + (x != c), row[i] + 1, row[i + 1] + 1)
        best = min(best, row[-1])
    return best


def test_bit_parallel_distance():
    draw = random.Random(1)
    for _ in range(500):
        item = "".join(draw.choice("ab") for _ in range(draw.randrange(1, 12)))
        text = "".join(draw.choice("abc") for _ in range(draw.randrange(0, 30)))
        assert decontamination.least_distance(item, text) == plain_distance(item, text)


def edited(item: str, edits: int, draw: random.Random) -> str:
    for _ in range(edits):
        i = draw.randrange(len(item))
        item = draw.choice([item[:i] + item[i + 1:], item[:i] + "z" + item[i:],
                            item[:i] + "q" + item[i + 1:]])
    return item


def test_leaks_equal_plain_version(spark, monkeypatch, nothing):
    draw = random.Random(2)
    items = [(i, prose(900 + i, 12 + i)) for i in range(12)] + [(90, None), (91, "  "), (92, None)]
    rows = []
    for i in range(60):
        item = items[i % 12][1]
        part = edited(item, draw.randrange(0, 2 + len(item) // 10), draw)
        rows.append((i, f"{prose(i, 20)} {part.upper() if i % 3 else part}\n{prose(i + 500, 9)}",
                     "en", "a", 1))
    rows += [(None, items[0][1], None, None, None), (70, None, None, None, None), (71, "", "", "", 0)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    wanted = set()
    for doc, text, *_ in rows:
        for item, raw in items:
            one = decontamination.normalized(raw or "")
            if one and text:
                d = plain_distance(one, decontamination.normalized(text))
                if d <= len(one) // 20:
                    wanted.add((doc, item, d))
    docs = frame(spark, rows)
    for block in (1 << 20, 300):
        monkeypatch.setattr(decontamination.item_blocks, "__defaults__", (block,))
        assert {tuple(r) for r in decontamination.leaks(docs, benchmark).collect()} == wanted
        left = {r["doc_id"] for r in decontamination.clean_documents(docs, benchmark).collect()}
        assert left == {r[0] for r in rows} - {w[0] for w in wanted}
    assert decontamination.leaks(nothing, benchmark).count() == 0
    assert decontamination.leaks(docs, benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["int", "short", "string"])
def test_leaks_keep_the_type_of_item_ids(spark, messy, kind):
    """Repeated and null items, a very long text, and columns that clash with each other's."""
    long_text = prose(7, 6000)
    items = [(1, long_text[20000:20300]), (1, long_text[20000:20300]), (2, prose(1, 300)[:80]),
             (None, prose(8, 12)), (3, None), (4, "  ")]
    benchmark = spark.createDataFrame(
        [(None if i is None else str(i) if kind == "string" else i, t, "x", "y") for i, t in items],
        f"item_id {kind}, text string, doc_id string, distance string")
    found = decontamination.leaks(messy, benchmark)
    assert found.schema["item_id"].dataType == benchmark.schema["item_id"].dataType
    near = [(d, i) for d, text, *_ in messy_rows() for i, item in items
            if item and item.strip() and text
            and decontamination.normalized(item) in decontamination.normalized(text)]
    assert Counter((r["doc_id"], r["item_id"] and int(r["item_id"])) for r in found.collect()
                   if r["distance"] == 0) == Counter(near)
    clean = decontamination.clean_documents(messy, benchmark)
    assert clean.columns == messy.columns
    assert not {11, 1, 2, 0} & {r["doc_id"] for r in clean.collect()}


def test_co_training_on_held_out_labels(spark):
    good, bad = ["calm", "clear", "sound"], ["spam", "junk", "idiot"]
    draw = random.Random(3)
    rows, labels = [], []
    for i in range(1500):
        quality = int(draw.random() < 0.7)
        words = prose(i, 40).split(" ") + [draw.choice(good if quality else bad)] * 2
        rows.append((i, " ".join(words), "en", "trusted" if quality == (draw.random() < 0.9)
                     else "other", 100))
        if i % 2:
            labels.append((i, quality if i % 50 != 1 else None, 0))
        labels.append((10_000 + i, 1, 0))
    truth = {i: int(any(w in good for w in r[1].split())) for i, r in enumerate(rows)}
    table = spark.createDataFrame(labels, "doc_id long, quality long, toxic long")
    found = cotraining.scored(frame(spark, rows), table, labelled=2000, pool=500).collect()
    unseen = [r for r in found if r["doc_id"] % 2 == 0]
    right = sum((r["score"] > 0.5) == bool(truth[r["doc_id"]]) for r in unseen)
    assert right / len(unseen) > 0.9
    assert sum(r["kept"] for r in found if truth[r["doc_id"]]) >= 0.98 * sum(truth.values())


def plain_fit(rows, labels, steps=80):
    """Logistic regression on a dense matrix: Adam over all rows, a small ridge. ``rows`` holds
    sets of buckets with dense values; the result gives the margin of such a row."""
    n = max(len(rows), 1)
    columns = sorted(set().union(*(b for b, _ in rows)))
    x = np.array([[float(c in b) for c in columns] for b, _ in rows])
    dense = np.array([d for _, d in rows], float).reshape(len(rows), -1)
    mean, spread = dense.mean(axis=0), dense.std(axis=0) + 1e-6
    x = np.hstack((x, (dense - mean) / spread, np.ones((len(rows), 1))))
    prior = min(max(sum(labels) / n, 1e-3), 1 - 1e-3)
    theta = np.zeros(x.shape[1])
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(x @ theta)))
        slope = x.T @ (p - np.array(labels)) / n + 1e-4 * theta / np.sqrt(n)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope ** 2
        theta = theta - 0.1 * first / (1 - 0.9 ** step) / (
            np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    weights = dict(zip(columns, theta))

    def margin(row):
        values = (np.array(row[1], float) - mean) / spread
        return (sum(weights.get(b, 0.0) for b in row[0])
                + values @ theta[len(columns):-1] + theta[-1])

    return margin


def plain_co_training(rows, labels, pool, rounds):
    """Per view the margin after all rounds, and the labels that each one was given per round."""
    train = {v: list(zip(rows[v], labels)) for v in rows}
    free = {v: set(range(len(pool[v]))) for v in rows}
    share, most, given = sum(labels) / len(labels), int(0.1 * len(pool["text"])), []
    for _ in range(rounds):
        margins = {v: plain_fit(*zip(*train[v])) for v in train}
        for teacher, pupil in (("text", "meta"), ("meta", "text")):
            p = [1 / (1 + np.exp(-margins[teacher](row))) for row in pool[teacher]]
            for label, part in ((1.0, share), (0.0, 1 - share)):
                sure = [(x if label else 1 - x, -i) for i, x in enumerate(p)]
                best = [-i for s, i in sorted(sure, reverse=True)
                        if s >= 0.95 and -i in free[pupil]][:int(most * part)]
                free[pupil] -= set(best)
                train[pupil] += [(pool[pupil][i], label) for i in best]
                given.append((pupil, label, len(best)))
    return {v: plain_fit(*zip(*train[v])) for v in train}, given


def test_co_training_equals_a_plain_version():
    def views(seeds, good):
        texts = [(prose(s, 40, 60) + (" fine" if g else " ### poor")).encode()
                 for s, g in zip(seeds, good)]
        return ([cotraining.text_features(t) for t in texts],
                [(cotraining.meta_features("en", "ab"[g == (s % 7 > 0)], 100), [])
                 for s, g in zip(seeds, good)])

    draw = random.Random(8)
    y = [draw.random() < 0.6 for _ in range(90)]
    pool_y = [draw.random() < 0.6 for _ in range(150)]
    text, meta = views(range(90), y)
    pool_text, pool_meta = views(range(500, 650), pool_y)

    def rows(view, dense):
        return cotraining.Rows.of([b for b, _ in view], [d for _, d in view] if dense else None)

    held = np.zeros(90, bool)
    held[::5] = True
    model = cotraining.co_trained(rows(text, True), rows(meta, False), np.array(y, float), held,
                                  rows(pool_text, True), rows(pool_meta, False), rounds=3)
    used = [i for i in range(90) if not held[i]]
    margins, given = plain_co_training(
        {"text": [text[i] for i in used], "meta": [meta[i] for i in used]},
        [float(y[i]) for i in used], {"text": pool_text, "meta": pool_meta}, 3)
    assert sum(n for pupil, _, n in given if pupil == "meta") > 0
    for view, found, given_rows in ((pool_text, model.text, rows(pool_text, True)),
                                    (pool_meta, model.meta, rows(pool_meta, False))):
        wanted = [margins["text" if found is model.text else "meta"](r) for r in view]
        assert found.margins(given_rows) == pytest.approx(wanted, abs=1e-5)


def test_the_pool_is_picked_by_hash(spark, monkeypatch):
    seen = {}

    def caught(text, meta, y, held, pool_text, pool_meta):
        seen["pool"] = pool_text.dense[:, 0]
        raise StopIteration

    monkeypatch.setattr(cotraining, "co_trained", caught)
    # a third of the rows has no id; the number of words tells rows apart
    rows = [(i if i % 3 else None, " ".join(["w"] * (i + 1)), "en", "a", 1) for i in range(600)]
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for given in (rows, rows[::-1]):
        with pytest.raises(StopIteration):
            cotraining.fitted(frame(spark, given), labels, pool=60)
        picked = np.rint(np.expm1(seen["pool"])).astype(int) - 1
        assert 59 <= len(picked) <= 60 and len(set(picked)) == len(picked)
        assert picked.max() > 400 and 5 < (picked % 3 == 0).sum() < 40
        assert seen.setdefault("first", set(picked)) == set(picked)


def test_co_training_on_messy_and_empty_tables(spark, messy, nothing):
    schema = "doc_id long, quality long, toxic long"
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 0), (12, 0, None), (7, 1, None),
                                    (8, 1, 0), (14, None, 0)], schema)
    found = cotraining.scored(messy, labels).collect()
    assert len(found) == len(messy_rows()) and all(0 <= r["score"] <= 1 for r in found)
    none = cotraining.scored(messy, spark.createDataFrame([], schema)).collect()
    assert all(r["kept"] and r["score"] == pytest.approx(0.5) for r in none)
    assert cotraining.scored(nothing, labels).count() == 0


def test_every_operator_is_registered():
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert differences(queries.queries()[name](spark, SMALL), connect(SMALL),
                       oracle.oracle_sql()[name]) == []


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        ids = [r["doc_id"] for r in docs.collect()]
        assert set(ids) <= before
        if name != "sharding":
            assert docs.columns == columns
        if name == "simhash_near_dedup":
            assert len(ids) == len(set(ids))
            left = [r["fp"] & (1 << 64) - 1 for r in simhash.fingerprints(docs).collect()]
            assert all((a ^ b).bit_count() > 4 for i, a in enumerate(left) for b in left[:i])
        before = set(ids)
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert len(rows) == len(ids)
    # each row carries its own text, and the slots of a shard have no gap
    assert all(zlib.crc32((r["text"] or "").encode()) == r["text_crc32"] for r in rows)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_pipeline_on_the_messy_table(spark, messy):
    """Nulls, copies, rows without an id and clashing columns go through all stages."""
    docs, given = messy, messy_rows()
    texts = Counter(r[1] for r in given)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        if name != "sharding":
            assert docs.columns == messy.columns
        left = Counter(r["text"] for r in docs.collect())
        assert set(left) <= set(texts)
        if name == "simhash_near_dedup":
            assert max(left.values()) == 1
    assert docs.count() == sum(left.values()) > 20


def test_pipeline_on_an_empty_table(spark, nothing):
    docs = nothing.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0
