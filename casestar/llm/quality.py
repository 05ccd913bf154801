"""Quality rules whose cutoffs adapt to each language and source.

Method. Each metric of each document that passes the base rule goes into a quantile sketch of its
language and source: counts in buckets whose width grows with the value, 16 to a doubling, so
quantiles are right to about 3 percent. Sketches are merged by adding counts: from tasks into
groups, and from groups into languages and the whole corpus, which serve the groups with too few
documents. Quartiles of the sketch give a group's fences. The fences are joined to the documents
by language and source, and a document outside any fence is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casestar.llm.common import byte_values, staged

# Fixed values of the base rule.
SYMBOLS = b"#*$%&|<>"
WINDOW_WORDS = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Metric:
    """A count per thousand of another, with fences ``reach`` spreads beyond the quartiles; the
    spread is the distance of the quartiles, but at least ``spread``."""

    name: str
    of: str
    per: str
    spread: int
    two_sided: bool = False


METRICS = (
    Metric("word_length", "word_chars", "n_words", 800, two_sided=True),
    Metric("symbols", "n_symbols", "n_words", 60),
    Metric("dup_lines", "n_dup_lines", "n_lines", 160),
    Metric("repeats", "n_repeat_words", "n_words", 100),
)
REACH = 3
# Groups with fewer documents than this take the fences of their language, or of the corpus.
LEAST_DOCUMENTS = 100


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a window of five that occurs twice or more."""
    n = len(words) - WINDOW_WORDS + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    # windows of 2, 4 and then 5 words get numbers of their own, so equal numbers are equal words
    window, kinds, width = ids, len(numbers), 1
    for step in (1, 2):
        joined = window[:-step] * kinds + window[step:]
        _, window = np.unique(joined, return_inverse=True)
        kinds, width = int(window.max()) + 1, width + step
    joined = window[:n] * len(numbers) + ids[WINDOW_WORDS - 1:]
    _, place, times = np.unique(joined, return_inverse=True, return_counts=True)
    hit = np.flatnonzero(times[place] > 1)
    if not len(hit):
        return 0
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + WINDOW_WORDS, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def counts_of(text: bytes) -> tuple[int, ...]:
    """The counts of one text, and how many of its lines have a word."""
    words = text.split()
    continued = np.frombuffer(text, np.uint8)
    chars = int(((continued & 0xC0) != 0x80).sum())
    chars -= sum(text.count(c) for c in b" \t\n\v\f\r")
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), chars, sum(text.count(c) for c in SYMBOLS),
            len(lines) - len(set(lines)), repeated_words(words), len(lines))


def counted(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The counts of each row, after its columns ``carry``."""
    names = [*COUNTS, "n_lines"]
    schema = T.StructType([docs.schema[c] for c in carry]
                          + [T.StructField(f"_{n}", T.LongType()) for n in names])
    columns = list(dict.fromkeys([*carry, "text"]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts_of(t) for t in byte_values(batch.column(columns.index("text")))]
            table = np.array(found, np.int64).reshape(len(found), len(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column(columns.index(c)) for c in carry]
                + [pa.array(table[:, i]) for i in range(len(names))], names=schema.names)

    return docs.select(*columns).mapInArrow(each, schema)


def base_failed() -> Column:
    return ((F.col("_n_words") < LEAST_WORDS)
            | (100 * F.col("_n_repeat_words") > REPEAT_PERCENT * F.col("_n_words")))


def value_of(metric: Metric) -> Column:
    """The metric in thousandths, rounded down."""
    return F.floor(1000 * F.col(f"_{metric.of}") / F.greatest(F.col(f"_{metric.per}"), F.lit(1)))


def bucket_of(value: Column) -> Column:
    """Values below 32 have buckets of their own, others 16 to a doubling."""
    shift = F.length(F.bin(value)) - 5
    return F.when(value < 32, value).otherwise(
        shift * 16 + F.floor(value / F.pow(F.lit(2.0), shift))).cast("long")


def bucket_start(bucket: Column) -> Column:
    shift = F.floor(bucket / 16) - 1
    return F.when(bucket < 32, bucket).otherwise(
        (bucket - shift * 16) * F.pow(F.lit(2.0), shift)).cast("long")


def sketches(counted_docs: DataFrame) -> DataFrame:
    """Bucket counts of every metric by ``level``: 0 language and source, 1 language, 2 all."""
    metrics = F.explode(F.array(*[
        F.struct(F.lit(m.name).alias("metric"), bucket_of(value_of(m)).alias("bucket"))
        for m in METRICS]))
    fine = staged(
        counted_docs.where(~base_failed()).select("lang", "source", metrics.alias("_m"))
        .groupBy("lang", "source", "_m.metric", "_m.bucket").agg(F.count("*").alias("n")),
        "sketches")
    none = F.lit(None).cast("string")

    def merged(level: int, lang: Column, source: Column) -> DataFrame:
        return (fine.select(F.lit(level).alias("level"), lang.alias("lang"),
                            source.alias("source"), "metric", "bucket", "n")
                .groupBy("level", "lang", "source", "metric", "bucket")
                .agg(F.sum("n").alias("n")))

    return (merged(0, F.col("lang"), F.col("source")).unionByName(merged(1, F.col("lang"), none))
            .unionByName(merged(2, none, none)))


def fences(sketch: DataFrame) -> DataFrame:
    """One row per level, language and source: documents, and a lower and an upper fence for
    every metric."""
    group = Window.partitionBy("level", "lang", "source", "metric")
    ranked = (sketch.withColumn("_below", F.sum("n").over(group.orderBy("bucket")))
              .withColumn("_all", F.sum("n").over(group)))

    def quartile(k: int) -> Column:
        return F.min(F.when(F.col("_below") * 4 >= F.col("_all") * k, bucket_start(F.col("bucket"))))

    quartiles = ranked.groupBy("level", "lang", "source", "metric").agg(
        quartile(1).alias("q1"), quartile(3).alias("q3"), F.max("_all").alias("documents"))
    out = []
    for m in METRICS:
        mine = F.col("metric") == m.name
        reach = REACH * F.greatest(F.col("q3") - F.col("q1"), F.lit(m.spread))
        out.append(F.max(F.when(mine, F.col("q3") + reach)).alias(f"{m.name}_high"))
        if m.two_sided:
            out.append(F.max(F.when(mine, F.col("q1") - reach)).alias(f"{m.name}_low"))
    return quartiles.groupBy("level", "lang", "source").agg(
        F.max("documents").alias("documents"), *out)


def _fence_names() -> list[str]:
    return [f"{m.name}_{side}" for m in METRICS
            for side in (("low", "high") if m.two_sided else ("high",))]


def adapted(sketch: DataFrame) -> DataFrame:
    """The fences that hold for each language and source: of the group, the language or all."""
    every = staged(fences(sketch), "fences")
    names = ["documents", *_fence_names()]

    def of(level: int) -> DataFrame:
        return every.where(F.col("level") == level).select(
            "lang", "source", F.struct(*names).alias(f"_f{level}"))

    lang, whole = of(1).drop("source").withColumnRenamed("lang", "_lang"), of(2).select("_f2")
    small = F.lit(LEAST_DOCUMENTS)
    chosen = (F.when(F.col("_f0.documents") >= small, F.col("_f0"))
              .when(F.col("_f1.documents") >= small, F.col("_f1")).otherwise(F.col("_f2")))
    top = whole.first()
    whole_fences = (F.struct(*[F.lit(top["_f2"][n]).cast("long").alias(n) for n in names])
                    if top else F.lit(None))
    return (of(0).join(lang, F.col("lang").eqNullSafe(F.col("_lang")))
            .withColumn("_f2", whole_fences)
            .select(F.col("lang").alias("_group_lang"), F.col("source").alias("_group_source"),
                    chosen.alias("_fence")))


def judged(counted_docs: DataFrame) -> DataFrame:
    """``counted_docs`` with ``_base_failed`` and ``_kept``."""
    limits = staged(adapted(sketches(counted_docs)), "limits")  # its size decides how it joins
    inside = F.lit(True)
    for m in METRICS:
        value = value_of(m)
        inside = inside & (value <= F.col(f"_fence.{m.name}_high"))
        if m.two_sided:
            inside = inside & (value >= F.col(f"_fence.{m.name}_low"))
    return (counted_docs.withColumn("_base_failed", base_failed())
            .join(limits, counted_docs["lang"].eqNullSafe(limits["_group_lang"])
                  & counted_docs["source"].eqNullSafe(limits["_group_source"]), "left")
            .withColumn("_kept", ~F.col("_base_failed") & F.coalesce(inside, F.lit(False)))
            .drop("_group_lang", "_group_source", "_fence"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the counts, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails the base rule. A null language or source is a
    group like any other. Rows that repeat count each. Other columns are ignored.
    """
    counts = staged(counted(docs, ["doc_id", "lang", "source"]), "counts")
    return judged(counts).select("doc_id", *[F.col(f"_{c}").alias(c) for c in COUNTS],
                                 F.col("_base_failed").alias("base_failed"),
                                 F.col("_kept").alias("kept"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep. The text is written once beside its counts, so
    that it is read, but neither counted nor shuffled, a second time."""
    counts = staged(counted(docs, docs.columns), "counts")
    return judged(counts).where("_kept").select(*docs.columns)
