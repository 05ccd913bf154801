"""Collocations by dynamic itemset counting over cyclic scans of corpus shards.

The corpus is cut into shards that are scanned in turn, over and over. Single words count from the
first scan on. A longer phrase starts to count with the scan after both of its subphrases (all
words but the last, all but the first) have reached the threshold, whatever shard comes next, and
is done after one full cycle, in which it has met every shard once. So lengths interleave, and
phrases that cannot reach the threshold are mostly never counted.

When a subphrase reached the threshold is told to the scanning tasks by a table of a fixed number
of slots, addressed by a hash. Two phrases in one slot can only start a phrase too
early, never too late, and always at the same scan, so each counted phrase still meets every shard
once; what was counted for nothing stays below the threshold and falls out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casestar.llm.common import byte_values, ids_of, place, runs, staged

SHARDS = 3
SLOTS = 1 << 24
NEVER = 255
# A task counts so many bytes of text at once.
CHUNK_BYTES = 8 << 20
# Phrases above this share of all words are looked up by broadcast: at most 100,000 of a length.
HOT_SHARE = 100_000

_CUT = 0xFF  # stands in no UTF-8 text
# The characters that end a piece.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_LOWER = bytes(range(256)).lower().translate(bytes.maketrans(_ENDS, bytes([_CUT]) * len(_ENDS)))

# Counts travel and rest in compressed Arrow blocks, one per bucket of phrases: a shuffle row of
# its own for each phrase costs several times as much as counting it. A key is the language, the
# byte above and the phrase.
COUNTS = pa.schema([("key", pa.binary()), ("words", pa.uint8()), ("start", pa.uint8()),
                    ("freq", pa.int64())])
COUNTING, DONE, REACHED = 0, 1, 2
# Blocks are merged when so many rows of a bucket wait.
MERGE_ROWS = 1 << 20


def collocations(docs: DataFrame, top: int = 2000, threshold: int = 10, inside_percent: int = 50,
                 lang: str = "lang", text: str = "text", shards: int = SHARDS,
                 slots: int = SLOTS) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of the ``top``
    phrases of 2 and 3 words of each language.

    A-Z is lower-cased, the text is split into pieces at ``.,;:!?`` and line breaks, and pieces
    into words at spaces and tabs. A candidate occurs ``threshold`` times or more; its score is
    floor(1000000 a a / (l r)) at its lowest-scoring cut (ties: the first), in exact decimals. It
    is dropped if a candidate one word longer holds it and occurs ``inside_percent`` per cent as
    often or more. Ranks go by score, then ``a`` (both descending), then the bytes of the phrase.

    A null text is empty and a null language is ``und``; equal rows count one by one; other
    columns are not read; an empty table gives no rows. A text is cut in one task.
    """
    counts = phrase_counts(docs, threshold, lang, text, shards, slots)
    total = staged(counts.where("words = 1").groupBy("lang").agg(F.sum("freq").alias("n")),
                   "phrase-totals")
    frequent = staged(counts.where(F.col("freq") >= threshold), "phrase-frequent")
    # sums of languages to one number
    hot = F.col("freq") * HOT_SHARE >= F.lit(
        total.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    candidates = frequent.where("words > 1").select("lang", "phrase", "words",
                                                    F.col("freq").alias("a"))
    triples = candidates.where(F.col("words") == 3)
    inside = triples.select("lang", "a", F.explode(F.array(
        _words("phrase", 0, 2), _words("phrase", 1, 2))).alias("phrase")).groupBy(
        "lang", "phrase").agg(F.max("a").alias("most"))
    pairs = candidates.where("words = 2").join(inside, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("most") < inside_percent * F.col("a"), F.lit(True))).drop("most")
    scored = _lowest(_at_cut(pairs, frequent, hot, 1, 1).unionByName(
        _at_cut(triples, frequent, hot, 1, 2)).unionByName(
        _at_cut(triples, frequent, hot, 2, 1)))
    # all but the first places of a language are dropped in the map tasks before its rows meet
    place_in = F.row_number().over(Window.partitionBy("lang").orderBy(
        F.desc("score"), F.desc("a"), "phrase"))
    return (scored.withColumn("place", place_in).where(F.col("place") <= top)
            .join(total, "lang")
            .select("lang", F.col("place").cast("long").alias("rank"),
                    F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score"))


def _words(phrase: str, start: int, count: int) -> Column:
    parts = F.split(F.col(phrase).cast("string"), " ")
    return F.array_join(F.slice(parts, start + 1, count), " ").cast("binary")


def _at_cut(candidates: DataFrame, frequent: DataFrame, hot: Column, left: int,
            right: int) -> DataFrame:
    """Candidates with ``l`` and ``r``, the counts of their first ``left`` and last ``right``
    words, and ``k``, where they are cut."""
    found = candidates
    for name, start, count in (("l", 0, left), ("r", left, right)):
        found = _looked_up(found.withColumn("part", _words("phrase", start, count)),
                           frequent.where(F.col("words") == count), hot, name).drop("part")
    return found.select("lang", "phrase", "a", "l", "r", F.lit(left).alias("k"))


def _looked_up(rows: DataFrame, counts: DataFrame, hot: Column, name: str) -> DataFrame:
    """Add the count of ``part``. A part with more than 1/HOT_SHARE of all words may be in very
    many candidates, so those, of which there are at most HOT_SHARE, are broadcast; any other is
    in few."""
    keyed = counts.select("lang", F.col("phrase").alias("part"), F.col("freq").alias(name), "freq")
    tops = keyed.where(hot).select("lang", "part", F.col(name).alias("_hot"))
    others = keyed.where(~hot).drop("freq")
    marked = rows.join(F.broadcast(tops), ["lang", "part"], "left")
    return (marked.where("_hot is not null").withColumnRenamed("_hot", name)
            .unionByName(marked.where("_hot is null").drop("_hot").join(others, ["lang", "part"])))


def _lowest(cuts: DataFrame) -> DataFrame:
    """The lowest score of each candidate, at the first cut among equals."""
    # 38 digits hold the products up to 3e15 occurrences; no part is rarer than the phrase, so
    # the quotient is 1000000 at most
    score = F.expr("""
        cast(1000000 * cast(cast(a as decimal(19,0)) * cast(a as decimal(19,0)) as decimal(31,0))
             as decimal(38,0))
        div cast(cast(l as decimal(19,0)) * cast(r as decimal(19,0)) as decimal(38,0))""")
    return cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("best")).select(
        "lang", "phrase", "best.a", "best.l", "best.r", "best.score")


def phrase_counts(docs: DataFrame, threshold: int = 10, lang: str = "lang", text: str = "text",
                  shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``lang``, ``phrase``, ``words`` and ``freq``, exact, of all single words and of every
    longer phrase that occurs ``threshold`` times or more. Rarer ones may be there or not."""
    spark = docs.sparkSession
    corpus = place(spark, "phrase-shards")
    (docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                 F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
     .withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int"))
     .write.partitionBy("shard").option("compression", "zstd").parquet(corpus))
    texts = spark.read.schema("lang string, text string, shard int").parquet(corpus)

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # per length and slot the scan with which a phrase there came to the threshold
    reached = np.full((2, slots), NEVER, np.uint8)
    states: list[DataFrame] = []
    scan = 0
    while scan < shards or (reached[reached < NEVER] >= scan - shards).any():
        # 5 bytes per slot in use
        used = [np.flatnonzero(row < NEVER).astype(np.int32) for row in reached]
        table = spark.sparkContext.broadcast(
            (slots, [(at, row[at]) for at, row in zip(used, reached)]))
        seen = _scanned(texts.where(F.col("shard") == scan % shards), table, scan, shards, buckets)
        seen = seen.withColumn("held", F.lit(False))
        if states:
            seen = seen.unionByName(states[-1].where(F.col("kind") == COUNTING).drop("kind")
                                    .withColumn("held", F.lit(True)))
        path = place(spark, "phrase-counts")
        _merged(seen, buckets, threshold, scan, shards, slots).write.partitionBy("kind").parquet(
            path)
        table.destroy()  # the scan is written
        states.append(spark.read.schema("bucket int, block binary, kind int").parquet(path))
        # at most one row per slot and length
        new = (states[-1].where(F.col("kind") == REACHED).mapInArrow(
            _slots_of, "words int, slot int").distinct().toArrow())
        row, slot = new["words"].to_numpy() - 1, new["slot"].to_numpy()
        fresh = reached[row, slot] == NEVER
        reached[row[fresh], slot[fresh]] = scan
        scan += 1
    done = states[0].where(F.col("kind") == DONE)
    for state in states[1:]:
        done = done.unionByName(state.where(F.col("kind") == DONE))
    return done.select("block").mapInArrow(
        _rows_of, "lang string, phrase binary, words int, freq long")


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema,
                           options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(block) -> pa.Table:
    return pa.ipc.open_stream(block.as_buffer()).read_all()


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([r[2] for r in rows], pa.binary())], names=["kind", "bucket", "block"])


def _slots_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in ids_of(batch, "block"):
            yield from unpack(block).to_batches()


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mark = bytes([_CUT])
    for batch in batches:
        for block in ids_of(batch, "block"):
            for part in unpack(block).to_batches(20_000):
                split = [key.split(mark) for key in part["key"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0].decode() for x in split], pa.string()),
                     pa.array([x[1] for x in split], pa.binary()),
                     part["words"].cast(pa.int32()), part["freq"]],
                    names=["lang", "phrase", "words", "freq"])


def _merged(seen: DataFrame, buckets: int, threshold: int, scan: int, shards: int,
            slots: int) -> DataFrame:
    """Blocks after a scan: phrases that go on counting, phrases whose cycle is over, and the
    slots of those that have just come to the threshold."""
    def settle(bucket: int, tables: list[pa.Table]) -> pa.RecordBatch:
        found = summed(tables)
        freq, old = found["freq"].to_numpy(), found["old"].to_numpy()
        words, start = found["words"].to_numpy(), found["start"].to_numpy()
        new = found.filter(pa.array((freq >= threshold) & (old < threshold) & (words < 3)))
        over = start == scan - shards + 1
        rows = []
        if len(new):
            rows.append((REACHED, bucket, pack(pa.table({
                "words": new["words"].cast(pa.int32()),
                "slot": pa.array([key_slot(key, slots) for key in new["key"].to_pylist()],
                                 pa.int32())}))))
        for kind, keep in ((COUNTING, ~over),
                           (DONE, over & ((words == 1) | (freq >= threshold)))):
            if keep.any():
                rows.append((kind, bucket, pack(
                    found.filter(pa.array(keep)).select(COUNTS.names))))
        return _blocks(rows)

    def summed(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by(["key", "words", "start"]).aggregate(
            [("freq", "sum"), ("old", "sum")]).rename_columns(
            ["key", "words", "start", "freq", "old"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, tables, waiting = None, [], 0
        for batch in batches:
            for at, held, block in zip(ids_of(batch, "bucket").to_pylist(),
                                       ids_of(batch, "held").to_pylist(), ids_of(batch, "block")):
                if bucket is not None and at != bucket:
                    yield settle(bucket, tables)
                    tables, waiting = [], 0
                bucket, found = at, unpack(block)
                tables.append(found.append_column("old", found["freq"] if held else pa.array(
                    np.zeros(len(found), np.int64))))
                waiting += len(found)
                if waiting > MERGE_ROWS:
                    tables, waiting = [summed(tables)], 0
        if bucket is not None:
            yield settle(bucket, tables)

    return (seen.repartition(buckets, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(merge, "kind int, bucket int, block binary"))


def key_slot(key: bytes, slots: int) -> int:
    lang, phrase = key.split(bytes([_CUT]))
    hashes = word_hashes(lang.decode(), phrase.split(b" "))
    return int(phrase_slots(phrase_hashes([hashes[i:i + 1] for i in range(len(hashes))]), slots)[0])


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def phrase_hashes(hashes: list[np.ndarray]) -> np.ndarray:
    """The hashes of phrases, given those of their words, one array per place."""
    mixed = hashes[0]
    for other in hashes[1:]:
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + other
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def phrase_slots(hashes: np.ndarray, slots: int) -> np.ndarray:
    return ((hashes >> np.uint64(24)) % np.uint64(slots)).astype(np.int64)


def _scanned(texts: DataFrame, table, scan: int, shards: int, buckets: int) -> DataFrame:
    """What one scan counts: blocks of the phrases that are active in it."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, used = table.value
        reached = np.full((len(used), slots), NEVER, np.uint8)
        for row, (at, scans) in zip(reached, used):
            row[at] = scans
        waiting: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(ids_of(batch, "lang").to_pylist(),
                                  byte_values(ids_of(batch, "text"))):
                waiting.setdefault(lang, []).append(text)
                size += len(text)
                if size >= CHUNK_BYTES:
                    for name, found in waiting.items():
                        yield from chunk_counts(name, found, reached, scan, shards, buckets)
                    waiting, size = {}, 0
        for name, found in waiting.items():
            yield from chunk_counts(name, found, reached, scan, shards, buckets)

    return texts.select("lang", "text").mapInArrow(count, "bucket int, block binary")


def chunks(texts: list[bytes], size: int) -> Iterator[bytes]:
    """Lower-cased texts with every piece border as one byte, cut at piece borders only."""
    data = bytes([_CUT]).join(texts).translate(_LOWER)
    start = 0
    while start < len(data):
        end = data.rfind(_CUT, start, start + size) if len(data) - start > size else len(data)
        if end <= start:  # a piece longer than a chunk
            end = data.find(_CUT, start + size)
            end = len(data) if end < 0 else end
        yield data[start:end]
        start = end + 1


def chunk_counts(lang: str, texts: list[bytes], reached: np.ndarray, scan: int, shards: int,
                 buckets: int) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases of some texts of one language that are active in this scan."""
    mark = bytes([_CUT])
    slots = reached.shape[1]
    for data in chunks(texts, CHUNK_BYTES):
        named = pa.array(data.replace(mark, b" " + mark + b" ").split(),
                         pa.binary()).dictionary_encode()
        names, words = named.dictionary, named.indices.to_numpy().astype(np.int64)
        if not len(words):
            continue
        known = len(names)
        border = np.array(pc.equal(names, pa.scalar(mark, pa.binary())))
        hashes = word_hashes(lang, names.to_pylist())
        found = []
        if scan < shards:  # single words start with scan 0
            freq = np.bincount(words[~border[words]], minlength=known)
            seen = np.flatnonzero(freq)
            found.append(_counted([seen], np.zeros(len(seen)), freq[seen], names, hashes))
        if scan > 0:
            came = np.where(border, NEVER, reached[0, phrase_slots(phrase_hashes([hashes]), slots)])
            # per place the scan with which both words of the pair there had come to the threshold
            both = np.maximum(came[words[:-1]], came[words[1:]])
            at = np.flatnonzero(both < NEVER)
            key, pair, freq = np.unique(words[at] * known + words[at + 1], return_inverse=True,
                                        return_counts=True)
            first, second = key // known, key % known
            start = np.maximum(came[first], came[second]).astype(np.int64) + 1
            now = (start <= scan) & (start > scan - shards)
            found.append(_counted([first[now], second[now]], start[now], freq[now], names, hashes))
            pair_came = np.maximum(start - 1, reached[1, phrase_slots(
                phrase_hashes([hashes[first], hashes[second]]), slots)])
            # a triple is two pairs that stand one word apart
            chain = np.flatnonzero(at[1:] == at[:-1] + 1)
            left, right = pair[chain], pair[chain + 1]
            start = np.maximum(pair_came[left], pair_came[right]) + 1
            now = (start <= scan) & (start > scan - shards)
            key, where, freq = np.unique(left[now] * known + second[right[now]],
                                         return_index=True, return_counts=True)
            left = key // known
            found.append(_counted([first[left], second[left], key % known], start[now][where],
                                  freq, names, hashes))
        yield _bucketed(lang, found, buckets)


def _counted(places: list[np.ndarray], start: np.ndarray, freq: np.ndarray, names: pa.Array,
             hashes: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """Phrases, given their words by place, and the hashes that deal them to buckets."""
    words = [names.take(pa.array(p)) for p in places]
    phrase = words[0] if len(words) == 1 else pc.binary_join_element_wise(
        *words, pa.scalar(b" ", pa.binary()))
    return pa.table([phrase, pa.array(np.full(len(freq), len(places), np.uint8)),
                     pa.array(start.astype(np.uint8)), pa.array(freq.astype(np.int64))],
                    schema=COUNTS), phrase_hashes([hashes[p] for p in places])


def _bucketed(lang: str, found: list[tuple[pa.Table, np.ndarray]],
              buckets: int) -> pa.RecordBatch:
    """One block per bucket."""
    table = pa.concat_tables([t for t, _ in found]).combine_chunks()
    bucket = np.concatenate([h for _, h in found]) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    begin, end = runs(bucket[order])
    prefix = pa.scalar(lang.encode() + bytes([_CUT]), pa.binary())
    rows = []
    for a, b in zip(begin.tolist(), end.tolist()):
        part = table.take(pa.array(order[a:b]))
        key = pc.binary_join_element_wise(prefix, part["key"], pa.scalar(b"", pa.binary()))
        rows.append((int(bucket[order[a]]), pack(part.set_column(0, COUNTS.field(0), key))))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
        names=["bucket", "block"])
