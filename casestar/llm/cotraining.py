"""Quality classifier by co-training of a text view and a metadata view.

Method. One classifier sees what a document says (hashed words, character statistics), the other
how it is filed (language, source, size). Both start from the labelled sample. In each round each
classifier labels the pool of unlabelled documents, and the labels it is surest of, in the
proportion of the classes, become training rows of the other. In the end each view's margin is
calibrated on labelled rows that were held out (Platt), and the calibrated log-odds are added,
with the prior counted once. All documents are scored.

The samples that the models are fitted on are bounded by parameters: ``labelled`` labelled rows
and ``pool`` unlabelled ones, picked by a hash of the id. Fitting them takes numpy in the driver;
what depends on the corpus size (features and scores) runs in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casestar.llm.common import byte_values

WORD_BITS = 18
META_BITS = 12
LABELLED = 8_000
POOL = 8_000
ROUNDS = 4
SURE = 0.95
GROWTH = 0.1
HELD_OUT = 5  # one labelled row of so many calibrates and sets the threshold
KEEP_SHARE = 0.995

_PUNCTUATION = b".,;:!?\"'()[]|"
_SYMBOLS = b"#*$%&|<>!"
_DIGITS = b"0123456789"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STATISTICS = 9


def text_features(text: bytes) -> tuple[list[int], list[float]]:
    """Buckets of the distinct words, and statistics of the characters."""
    words = text.lower().translate(None, _PUNCTUATION).split()
    kinds = set(words)
    mask = (1 << WORD_BITS) - 1
    buckets = sorted({xxhash.xxh3_64_intdigest(w) & mask for w in kinds})
    size, n = max(len(text), 1), max(len(words), 1)
    lines = [line for line in text.split(b"\n") if line.strip()]

    def share(chars: bytes) -> float:
        return 1 - len(text.translate(None, chars)) / size

    return buckets, [np.log1p(len(words)), sum(map(len, words)) / n, len(kinds) / n,
                     share(_SYMBOLS), share(_UPPER), share(_DIGITS), share(_PUNCTUATION),
                     len(set(lines)) / max(len(lines), 1), float(len(words) < 10)]


def meta_features(lang: str | None, source: str | None, chars: int | None) -> list[int]:
    """Buckets of language, source, size, and pairs of them."""
    size = "none" if chars is None else str(int(2 * np.log2(max(chars, 0) + 1)))
    values = [f"l{lang}", f"s{source}", f"n{size}", f"l{lang} s{source}", f"l{lang} n{size}"]
    mask = (1 << META_BITS) - 1
    return sorted({xxhash.xxh3_64_intdigest(v) & mask for v in values})


@dataclass
class Rows:
    """Sparse 0/1 rows and some dense columns."""

    buckets: np.ndarray
    sizes: np.ndarray
    dense: np.ndarray

    @staticmethod
    def of(buckets: list[list[int]], dense: list[list[float]] | None = None) -> Rows:
        sizes = np.array([len(b) for b in buckets], np.int64)
        flat = np.concatenate([np.asarray(b, np.int32) for b in buckets]) if buckets else \
            np.empty(0, np.int32)
        wide = len(dense[0]) if dense else 0
        return Rows(flat, sizes, np.array(dense or [], float).reshape(len(buckets), wide))

    def take(self, rows: np.ndarray) -> Rows:
        start = np.cumsum(self.sizes) - self.sizes
        sizes = self.sizes[rows]
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return Rows(self.buckets[np.repeat(start[rows], sizes) + inside], sizes, self.dense[rows])

    def join(self, other: Rows) -> Rows:
        return Rows(np.concatenate((self.buckets, other.buckets)),
                    np.concatenate((self.sizes, other.sizes)),
                    np.concatenate((self.dense, other.dense)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Linear:
    """Logistic regression; a row's buckets count by the root of their number."""

    weights: np.ndarray
    dense: np.ndarray
    bias: float
    mean: np.ndarray
    spread: np.ndarray

    def margins(self, rows: Rows) -> np.ndarray:
        owner = np.repeat(np.arange(len(rows.sizes), dtype=np.int32), rows.sizes)
        sums = np.bincount(owner, self.weights[rows.buckets], minlength=len(rows.sizes))
        return sums + (rows.dense - self.mean) / self.spread @ self.dense + self.bias

    @staticmethod
    def fitted(rows: Rows, y: np.ndarray, bits: int, ridge: float = 1e-4,
               steps: int = 80, rate: float = 0.1) -> Linear:
        """Full-batch Adam; no randomness, so equal samples give equal models."""
        n, wide = max(len(y), 1), rows.dense.shape[1]
        prior = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        model = Linear(np.zeros(1 << bits), np.zeros(wide), float(np.log(prior / (1 - prior))),
                       rows.dense.mean(axis=0) if len(y) else np.zeros(wide),
                       (rows.dense.std(axis=0) if len(y) else np.zeros(wide)) + 1e-6)
        state = [np.zeros((1 << bits) + wide + 1) for _ in range(2)]
        theta = np.concatenate((model.weights, model.dense, [model.bias]))
        scaled = (rows.dense - model.mean) / model.spread
        owner = np.repeat(np.arange(len(y), dtype=np.int32), rows.sizes)
        for step in range(1, steps + 1):
            model.weights, model.dense = theta[:1 << bits], theta[1 << bits:-1]
            model.bias = theta[-1]
            error = (sigmoid(model.margins(rows)) - y) / n
            slope = np.concatenate((
                np.bincount(rows.buckets, error[owner], minlength=1 << bits),
                scaled.T @ error, [error.sum()])) + ridge * theta / np.sqrt(n)
            state[0] = 0.9 * state[0] + 0.1 * slope
            state[1] = 0.999 * state[1] + 0.001 * slope ** 2
            theta = theta - rate * (state[0] / (1 - 0.9 ** step)) / (
                np.sqrt(state[1] / (1 - 0.999 ** step)) + 1e-8)
        model.weights, model.dense, model.bias = theta[:1 << bits], theta[1 << bits:-1], theta[-1]
        return model


def platt(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into log-odds, by Newton steps on smoothed labels."""
    positive, negative = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * margins + b)
        error, curve = p - target, p * (1 - p) + 1e-9
        g = np.array([(error * margins).sum() + 1e-3 * (a - 1), error.sum()])
        h = np.array([[(curve * margins ** 2).sum() + 1e-3, (curve * margins).sum()],
                      [(curve * margins).sum(), curve.sum() + 1e-6]])
        move = np.linalg.solve(h, g)
        a, b = a - float(np.clip(move[0], -1, 1)), b - float(np.clip(move[1], -1, 1))
        if np.abs(move).max() < 1e-6:
            break
    return max(a, 0.0), b


@dataclass
class Model:
    """Two views, their calibrations, the prior log-odds and the threshold of ``kept``."""

    text: Linear
    meta: Linear
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    prior: float
    threshold: float

    def scores(self, text: Rows, meta: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = self.text_scale[0] * self.text.margins(text) + self.text_scale[1]
        b = self.meta_scale[0] * self.meta.margins(meta) + self.meta_scale[1]
        return sigmoid(a), sigmoid(b), sigmoid(a + b - self.prior)


def co_trained(text: Rows, meta: Rows, y: np.ndarray, held: np.ndarray, pool_text: Rows,
               pool_meta: Rows, rounds: int = ROUNDS) -> Model:
    """The model of the labelled rows, of which ``held`` only calibrate, and the pool."""
    train = np.flatnonzero(~held)
    rows = {"text": text.take(train), "meta": meta.take(train)}
    labels = {"text": y[train].astype(float), "meta": y[train].astype(float)}
    pools = {"text": pool_text, "meta": pool_meta}
    bits = {"text": WORD_BITS, "meta": META_BITS}
    free = {v: np.ones(len(pool_text.sizes), bool) for v in pools}
    share = float(y[train].mean()) if len(train) else 0.5
    most = int(GROWTH * len(pool_text.sizes))
    for number in range(rounds + 1):
        views = {v: Linear.fitted(rows[v], labels[v], bits[v]) for v in rows}
        if number == rounds or not most:
            break
        for teacher, pupil in (("text", "meta"), ("meta", "text")):
            p = sigmoid(views[teacher].margins(pools[teacher]))
            for label, sure, part in ((1.0, p, share), (0.0, 1 - p, 1 - share)):
                order = np.argsort(-sure, kind="stable")
                order = order[(sure[order] >= SURE) & free[pupil][order]][:int(most * part)]
                free[pupil][order] = False
                rows[pupil] = rows[pupil].join(pools[pupil].take(order))
                labels[pupil] = np.concatenate((labels[pupil], np.full(len(order), label)))
    use = np.flatnonzero(held) if held.any() else train
    mine, other = text.take(use), meta.take(use)
    mean = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    model = Model(views["text"], views["meta"], platt(views["text"].margins(mine), y[use]),
                  platt(views["meta"].margins(other), y[use]), float(np.log(mean / (1 - mean))), 0)
    good = np.sort(model.scores(mine, other)[2][y[use] > 0])
    if len(good):
        model.threshold = min(0.5, float(good[int((1 - KEEP_SHARE) * len(good))]))
    return model


def _columns(batch: pa.RecordBatch) -> tuple[Rows, Rows]:
    found = [text_features(t) for t in byte_values(batch.column(1))]
    meta = [meta_features(*x) for x in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
    return Rows.of([f[0] for f in found], [f[1] for f in found]), Rows.of(meta)


_INPUT = ("doc_id", "text", "lang", "source", "n_chars")


def _featured(docs: DataFrame, *carry: str) -> DataFrame:
    """Features of a bounded sample, to be fetched."""
    names = ["doc_id", "buckets", "statistics", "meta"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(t) for t in byte_values(batch.column(1))]
            meta = [meta_features(*x)
                    for x in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.list_(pa.float64())),
                 pa.array(meta, pa.list_(pa.int32())),
                 *[batch.column(len(_INPUT) + i) for i in range(len(carry))]],
                names=[*names, *carry])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(*_INPUT, *carry).mapInArrow(
        each, f"doc_id {kind}, buckets array<int>, statistics array<double>, meta array<int>"
              + "".join(f", {c} int" for c in carry))


def fitted(rows: Rows, y: np.ndarray, bits: int, ridge: float = 1e-4,
               steps: int = 80, rate: float = 0.1) -> Linear:
        """Full-batch Adam; no randomness, so equal samples give equal models."""
        n, wide = max(len(y), 1), rows.dense.shape[1]
        prior = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        model = Linear(np.zeros(1 << bits), np.zeros(wide), float(np.log(prior / (1 - prior))),
                       rows.dense.mean(axis=0) if len(y) else np.zeros(wide),
                       (rows.dense.std(axis=0) if len(y) else np.zeros(wide)) + 1e-6)
        state = [np.zeros((1 << bits) + wide + 1) for _ in range(2)]
        theta = np.concatenate((model.weights, model.dense, [model.bias]))
        scaled = (rows.dense - model.mean) / model.spread
        owner = np.repeat(np.arange(len(y), dtype=np.int32), rows.sizes)
        for step in range(1, steps + 1):
            model.weights, model.dense = theta[:1 << bits], theta[1 << bits:-1]
            model.bias = theta[-1]
            error = (sigmoid(model.margins(rows)) - y) / n
            slope = np.concatenate((
                np.bincount(rows.buckets, error[owner], minlength=1 << bits),
                scaled.T @ error, [error.sum()])) + ridge * theta / np.sqrt(n)
            state[0] = 0.9 * state[0] + 0.1 * slope
            state[1] = 0.999 * state[1] + 0.001 * slope ** 2
            theta = theta - rate * (state[0] / (1 - 0.9 ** step)) / (
                np.sqrt(state[1] / (1 - 0.999 ** step)) + 1e-8)
        model.weights, model.dense, model.bias = theta[:1 << bits], theta[1 << bits:-1], theta[-1]
        return model


def platt(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into log-odds, by Newton steps on smoothed labels."""
    positive, negative = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * margins + b)
        error, curve = p - target, p * (1 - p) + 1e-9
        g = np.array([(error * margins).sum() + 1e-3 * (a - 1), error.sum()])
        h = np.array([[(curve * margins ** 2).sum() + 1e-3, (curve * margins).sum()],
                      [(curve * margins).sum(), curve.sum() + 1e-6]])
        move = np.linalg.solve(h, g)
        a, b = a - float(np.clip(move[0], -1, 1)), b - float(np.clip(move[1], -1, 1))
        if np.abs(move).max() < 1e-6:
            break
    return max(a, 0.0), b


@dataclass
class Model:
    """Two views, their calibrations, the prior log-odds and the threshold of ``kept``."""

    text: Linear
    meta: Linear
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    prior: float
    threshold: float

    def scores(self, text: Rows, meta: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = self.text_scale[0] * self.text.margins(text) + self.text_scale[1]
        b = self.meta_scale[0] * self.meta.margins(meta) + self.meta_scale[1]
        return sigmoid(a), sigmoid(b), sigmoid(a + b - self.prior)


def co_trained(text: Rows, meta: Rows, y: np.ndarray, held: np.ndarray, pool_text: Rows,
               pool_meta: Rows, rounds: int = ROUNDS) -> Model:
    """The model of the labelled rows, of which ``held`` only calibrate, and the pool."""
    train = np.flatnonzero(~held)
    rows = {"text": text.take(train), "meta": meta.take(train)}
    labels = {"text": y[train].astype(float), "meta": y[train].astype(float)}
    pools = {"text": pool_text, "meta": pool_meta}
    bits = {"text": WORD_BITS, "meta": META_BITS}
    free = {v: np.ones(len(pool_text.sizes), bool) for v in pools}
    share = float(y[train].mean()) if len(train) else 0.5
    most = int(GROWTH * len(pool_text.sizes))
    for number in range(rounds + 1):
        views = {v: Linear.fitted(rows[v], labels[v], bits[v]) for v in rows}
        if number == rounds or not most:
            break
        for teacher, pupil in (("text", "meta"), ("meta", "text")):
            p = sigmoid(views[teacher].margins(pools[teacher]))
            for label, sure, part in ((1.0, p, share), (0.0, 1 - p, 1 - share)):
                order = np.argsort(-sure, kind="stable")
                order = order[(sure[order] >= SURE) & free[pupil][order]][:int(most * part)]
                free[pupil][order] = False
                rows[pupil] = rows[pupil].join(pools[pupil].take(order))
                labels[pupil] = np.concatenate((labels[pupil], np.full(len(order), label)))
    use = np.flatnonzero(held) if held.any() else train
    mine, other = text.take(use), meta.take(use)
    mean = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    model = Model(views["text"], views["meta"], platt(views["text"].margins(mine), y[use]),
                  platt(views["meta"].margins(other), y[use]), float(np.log(mean / (1 - mean))), 0)
    good = np.sort(model.scores(mine, other)[2][y[use] > 0])
    if len(good):
        model.threshold = min(0.5, float(good[int((1 - KEEP_SHARE) * len(good))]))
    return model


def _columns(batch: pa.RecordBatch) -> tuple[Rows, Rows]:
    found = [text_features(t) for t in byte_values(batch.column(1))]
    meta = [meta_features(*x) for x in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
    return Rows.of([f[0] for f in found], [f[1] for f in found]), Rows.of(meta)


_INPUT = ("doc_id", "text", "lang", "source", "n_chars")


def _featured(docs: DataFrame, *carry: str) -> DataFrame:
    """Features of a bounded sample, to be fetched."""
    names = ["doc_id", "buckets", "statistics", "meta"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(t) for t in byte_values(batch.column(1))]
            meta = [meta_features(*x)
                    for x in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.list_(pa.float64())),
                 pa.array(meta, pa.list_(pa.int32())),
                 *[batch.column(len(_INPUT) + i) for i in range(len(carry))]],
                names=[*names, *carry])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(*_INPUT, *carry).mapInArrow(
        each, f"doc_id {kind}, buckets array<int>, statistics array<double>, meta array<int>"
              + "".join(f", {c} int" for c in carry))


def _picked(key: Column, share: float, seed: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30))


def fitted(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED,
           pool: int = POOL) -> Model:
    """The model of a sample of at most ``labelled`` labelled rows and ``pool`` others. A document
    is good if its quality is 1 and it is not toxic; of repeated labels the worst counts. Both
    samples are the rows that hash lowest, by id and, in the pool, by id and text."""
    known = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min(((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int"))
        .alias("_good")))
    n_labels, n_docs = known.count(), docs.count()
    order = F.xxhash64("doc_id", F.lit(5))
    some = known.orderBy(order, "doc_id").limit(labelled) if n_labels > labelled else known
    few = some.select(F.col("doc_id").alias("_id"), "_good")
    sample = docs.join(F.broadcast(few), docs["doc_id"] == few["_id"]).select(
        *[docs[c] for c in _INPUT], "_good")  # at most `labelled` rows are sent
    taken = _featured(sample, "_good").toArrow().sort_by("doc_id")
    # rows without an id, or under one id, are told apart by their text
    place = F.pmod(F.xxhash64(docs["doc_id"], docs["text"], F.lit(7)), F.lit(1 << 30)).cast("int")
    share = min(1.0, 2 * pool / max(n_docs, 1))  # enough to fill the pool, little to sort
    others = docs.select(*[docs[c] for c in _INPUT], place.alias("_place")).where(
        F.col("_place") < int(share * (1 << 30)))
    others = (_featured(others, "_place").orderBy("_place", "doc_id").limit(pool).toArrow())
    ids = taken["doc_id"].to_pylist()
    seen = set(ids)
    others = others.filter(pa.array([d not in seen for d in others["doc_id"].to_pylist()],
                                    pa.bool_()))
    held = np.array([xxhash.xxh3_64_intdigest(str(d).encode()) % HELD_OUT == 0 for d in ids], bool)
    return co_trained(*_fetched(taken), np.array(taken["_good"].to_pylist(), float), held,
                      *_fetched(others))


def _fetched(table: pa.Table) -> tuple[Rows, Rows]:
    """Both views of fetched rows, straight from the Arrow buffers."""
    def sparse(name: str) -> tuple[np.ndarray, np.ndarray]:
        lists = table[name].combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
        return np.asarray(lists.flatten()), np.diff(np.asarray(lists.offsets)).astype(np.int64)

    statistics = sparse("statistics")[0].reshape(-1, STATISTICS)
    return (Rows(*sparse("buckets"), statistics),
            Rows(*sparse("meta"), np.empty((table.num_rows, 0))))


def scored(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED,
           pool: int = POOL) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_score``, ``meta_score`` and ``score`` (the
    probability of a good document by the text, the metadata and both) and ``kept``.

    ``kept`` drops the documents below the score that all but 0.5 percent of the good held-out
    ones reach, at most one half. Null texts count as empty, null metadata as values of their
    own. Without labels all scores are one half and all rows are kept. Rows that repeat count
    each and score alike. Texts of any length are read whole, one in a task's memory at a time
    beside its batch; only their features go on. Other columns are ignored.
    """
    model = fitted(docs, labels, labelled, pool)  # 2**18 weights, whatever the corpus

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            text, meta = _columns(batch)
            both = model.scores(text, meta)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x) for x in both],
                 pa.array(both[2] >= model.threshold)],
                names=["doc_id", "text_score", "meta_score", "score", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(*_INPUT).mapInArrow(
        each, f"doc_id {kind}, text_score double, meta_score double, score double, kept boolean")
