"""Mixing sources to target weights, over fixed-length blocks of words.

Method. Each source is one stream of words, its documents in a hashed order, cut into blocks of
``block_words`` words. Targets follow the weights and stop at twice a source's size, the excess
going to the others. The mix is a row of slots of one block each, cut into output shards. Each
slot of a shard draws a source with the probability of the source's share, so a shard's counts
per source are one multinomial draw. A source that was drawn more often than its target has
blocks for gives its last slots up, and sources that were drawn too rarely get those, dealt by a
permutation; the counts of a shard change by no more than that. The n-th slot of a source reads
the block that a permutation of the source's block numbers gives for n; a stream that is used up
starts again. Slots and blocks are joined by source and block number, and what a document gives
to the mix is counted from the slots.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casestar.llm.common import WORD, permuted, running_start, staged

# Fixed values of the mix: weights of the sources in turn, share of all words, times of a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_TIMES = 2
SHARD_SLOTS = 4096
SPAN_CHUNK = 4096
SLOTS_PER_TASK = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, block_words: int) -> DataFrame:
    """One row per source of ``sizes`` (``source``, ``size``): its number, size, target, and its
    blocks: how many there are, how many whole passes and how many more slots it takes.

    A source stops at its limit if its limit per weight is below the level that the words left
    give to the sources left, in the order of limit per weight: the level of the first that
    does not stop is that of all others.
    """
    ranked = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
              .withColumn("source_no", F.row_number().over(
                  Window.orderBy(F.col("source").asc_nulls_last())).cast("long")))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]),
                          ((F.col("source_no") - 1) % len(WEIGHTS) + 1).cast("int"))
    limit = MOST_TIMES * F.col("source_size")
    everything = Window.partitionBy(F.lit(1))
    rising = everything.orderBy(F.col("_limit") / F.col("_weight"), "source_no")
    level = ((F.lit(SHARE) * F.col("_all") - (F.col("_limits") - F.col("_limit")))
             / (F.col("_weights") - F.col("_lighter") + F.col("_weight")))
    leveled = (ranked.withColumn("_weight", weight.cast("long")).withColumn("_limit", limit)
               .withColumn("_all", F.sum("source_size").over(everything))
               .withColumn("_weights", F.sum("_weight").over(everything))
               .withColumn("_limits", F.sum("_limit").over(rising))
               .withColumn("_lighter", F.sum("_weight").over(rising))
               .withColumn("_level", F.when(level * F.col("_weight") <= F.col("_limit"), level))
               .withColumn("_level", F.first("_level", ignorenulls=True).over(
                   rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    target = F.least(F.col("_limit").cast("double"),
                     F.coalesce(F.col("_level") * F.col("_weight"), F.col("_limit")))
    passes = F.when(F.col("source_size") > 0,
                    F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    blocks = F.ceil(F.col("source_size") / F.lit(block_words))
    more = F.round((F.col("target") - F.col("passes") * F.col("source_size")) / block_words)
    return (leveled.withColumn("target", target).withColumn("passes", passes.cast("long"))
            .withColumn("blocks", blocks.cast("long"))
            .withColumn("more", F.least(more.cast("long"), F.col("blocks")))
            .withColumn("slots", F.col("passes") * F.col("blocks") + F.col("more"))
            .select("source", "source_no", "source_size", "target", "passes", "blocks", "more",
                    "slots"))


def _holding(points: DataFrame, at: str, spans: DataFrame, first: str, length: str) -> DataFrame:
    """``points``, each joined to the one span ``first`` .. ``first + length - 1`` that holds its
    ``at``. Spans are cut at multiples of a chunk, which is the join key; the range decides."""
    chunk = F.lit(SPAN_CHUNK)
    cut = (spans.where(F.col(length) > 0)
           .withColumn("_chunk", F.explode(F.sequence(
               F.floor(F.col(first) / chunk),
               F.floor((F.col(first) + F.col(length) - 1) / chunk)))))
    # the planner takes exploded spans for a small table, and would broadcast them
    return (points.withColumn("_chunk", F.floor(F.col(at) / chunk)).join(cut.hint("merge"), "_chunk")
            .where((F.col(at) >= F.col(first)) & (F.col(at) < F.col(first) + F.col(length)))
            .drop("_chunk"))


def _sum_of(df: DataFrame, column: str) -> int:
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).alias("n")).first()["n"]


def drawn_counts(sources: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = 17) -> DataFrame:
    """``shard``, ``source_no`` and ``drawn``: how often the slots of an output shard draw a
    source of ``sources`` (``source_no``, ``slots``). All shards but the last are full."""
    total = _sum_of(sources, "slots")
    spans = running_start(sources.select("source_no", "slots").where(F.col("slots") > 0), [],
                          ["source_no"], "slots", "first")
    slots = (sources.sparkSession.range(0, total, 1, 1 + total // SLOTS_PER_TASK)
             .select(F.floor(F.col("id") / shard_slots).alias("shard"),
                     F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(total, 1))).alias("_draw")))
    return (_holding(slots, "_draw", spans, "first", "slots")
            .groupBy("shard", "source_no").agg(F.count("*").alias("drawn")))


def mix_slots(sources: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = 17) -> DataFrame:
    """The mix: for each slot its output ``shard``, ``place`` in it, and the block it reads
    (``source_no``, ``block``).

    The slots that a source drew are numbered over all shards. Those beyond its ``slots`` are
    free again, and are dealt to the sources that lack some.
    """
    limits = sources.select("source_no", "slots", "blocks")
    draws = staged(running_start(drawn_counts(sources, shard_slots, seed), ["source_no"],
                                 ["shard"], "drawn", "start"), "draws")
    kept = F.least(F.col("drawn"), F.greatest(F.col("slots") - F.col("start"), F.lit(0)))
    held = staged(draws.join(limits, "source_no").withColumn("kept", kept)
                  .withColumn("over", F.col("drawn") - F.col("kept"))
                  .select("source_no", "blocks", "shard", "start", "kept", "over"), "held")
    free = running_start(held.where(F.col("over") > 0).select("source_no", "shard", "over"), [],
                         ["source_no", "shard"], "over", "first")
    so_far = draws.groupBy("source_no").agg(F.sum("drawn").alias("_drawn"))
    had = F.coalesce("_drawn", F.lit(0))
    lacking = running_start(limits.join(so_far, "source_no", "left")
                            .select("source_no", "blocks", had.alias("had"),
                                    (F.col("slots") - had).alias("lack"))
                            .where(F.col("lack") > 0), [], ["source_no"], "lack", "lack_first")
    each = (free.withColumn("_i", F.explode(F.sequence(
                F.col("first"), F.col("first") + F.col("over") - 1)))
            .select("shard", "_i", F.lit(max(_sum_of(held, "over"), 1)).cast("long").alias("_n")))
    dealt = _holding(permuted(each, "_i", "_n", str(seed), "_at"), "_at", lacking,
                     "lack_first", "lack").select(
        "source_no", "blocks", "shard", (F.col("had") + F.col("_at") - F.col("lack_first")).alias("n"))
    own = (held.where(F.col("kept") > 0).select("source_no", "blocks", "shard", F.explode(F.sequence(
        F.col("start"), F.col("start") + F.col("kept") - 1)).alias("n")))
    read = (own.unionByName(dealt).withColumn("_turn", F.col("n") % F.col("blocks"))
            .withColumn("_seed", F.col("source_no") + seed))
    inside = Window.partitionBy("shard").orderBy(F.xxhash64("source_no", "n"), "source_no", "n")
    return (permuted(read, "_turn", "blocks", "_seed", "block")
            .select("shard", (F.row_number().over(inside) - 1).cast("long").alias("place"),
                    "source_no", "block"))


def _streams(docs: DataFrame, block_words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of ``docs`` with size and source, the sources, and the parts of documents that make
    up the blocks: ``from_word`` counts in the document, ``words`` is the length."""
    sizes = staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")),
                   "sizes")
    sources = staged(targets(sizes, block_words), "sources")
    named = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).select(
        "doc_id", "size", "source_no", "source_size", "target")
    with_words = running_start(named.where(F.col("size") > 0), ["source_no"],
                               ["doc_id", "size"], "size", "start")
    first = F.floor(F.col("start") / block_words)
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    begin = F.greatest("start", F.col("block") * block_words)
    parts = (with_words.withColumn("block", F.explode(F.sequence(first, last)))
             .withColumn("from_word", begin - F.col("start"))
             .withColumn("words", F.least(F.col("start") + F.col("size"),
                                          (F.col("block") + 1) * block_words) - begin))
    return named, sources, parts


def mix_spans(docs: DataFrame, block_words: int = 64, shard_slots: int = SHARD_SLOTS,
              seed: int = 17) -> DataFrame:
    """The mix itself: for each slot (``shard``, ``place``) the pieces of documents that fill it
    in order of ``offset`` (words before the piece in the block): ``doc_id``, ``size`` of the
    document, ``from_word`` and ``words``.

    A block has ``block_words`` words but for the last of a source. Null and empty texts fill
    nothing; rows that repeat fill slots each; an empty table gives none.
    """
    _, sources, parts = _streams(docs, block_words)
    offset = F.col("start") + F.col("from_word") - F.col("block") * block_words
    return (mix_slots(sources, shard_slots, seed).join(
                parts.withColumn("offset", offset), ["source_no", "block"])
            .select("shard", "place", "offset", "doc_id", "size", "from_word", "words"))


def mixed(docs: DataFrame, block_words: int = 64, seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size`` (words; null text: 0), ``source_size``
    and ``target`` of its source (a null source is one too, the last), and ``taken``, the words
    of it that the mix takes, repeats counted.

    A source's taken words differ from its target by less than one and a half blocks (the last
    block of a stream is shorter). No document is taken
    more than twice. Rows that repeat count each. Other columns are ignored.
    """
    named, sources, parts = _streams(docs, block_words)
    mix = staged(mix_slots(sources, seed=seed), "mix")
    times = mix.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    # a document's first row carries what all rows of it need, so that one sum collects them
    taken = (parts.join(times.hint("merge"), ["source_no", "block"], "left")
             .groupBy("source_no", "start", "doc_id", "size", "source_size", "target")
             .agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken")))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    empty = named.where(F.col("size") == 0).withColumn("taken", F.lit(0).cast("long"))
    return taken.select(*columns).unionByName(empty.select(*columns))


def mixed_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its taken words are its size, a part
    of a time being rounded up or down by a hash of the id, so that the mix keeps its weights.
    Rows without words weigh nothing and stay once. Of rows that repeat an id the largest
    number of times counts."""
    mix = mixed(docs, seed=seed)
    part = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) / F.lit(1 << 20)
    times = (mix.groupBy("doc_id").agg(F.max(F.when(F.col("size") == 0, 1).otherwise(
        F.floor(F.col("taken") / F.col("size") + part))).cast("int").alias("_times"))
        .where(F.col("_times") > 0))
    renamed = times.select(F.col("doc_id").alias("_mixed_id"), F.col("_times").alias("_mix_times"))
    joined = docs.join(renamed, docs["doc_id"].eqNullSafe(renamed["_mixed_id"]))
    return (joined.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), renamed["_mix_times"])))
            .select(*[docs[c] for c in docs.columns]))
