"""What the corpus operators share: staged tables, text buffers, running sums, permutations."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casestar.session import shared_folder

# A word is a run of characters other than the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def place(spark: SparkSession, label: str) -> str:
    """A folder in the shared place that nothing was written to before."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/casestar-llm/{app}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: the lineage ends here, and a lost
    executor costs a read instead of the work."""
    spark, path = df.sparkSession, place(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_values(column: pa.Array) -> Iterator[bytes]:
    """The values of an Arrow string or binary column as bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    for value in column:
        yield value.as_py() or b""


def ids_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def running_start(df: DataFrame, groups: list[str], order: list[str], value: str, name: str,
                  salts: int = 1024) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same group that come before.

    Rows are ordered by a hash of ``order``, cut into ``salts`` parts, and then by ``order``
    itself, so no task sums a whole group: each part is summed on its own and starts where the
    parts before it end. The offsets are one row per group and part.
    """
    part = f"_{name}_part"
    cut = df.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    keys = [*groups, part]
    inside = (Window.partitionBy(*keys).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (cut.groupBy(*keys).agg(F.sum(value).alias("_sum"))
               .withColumn("_offset", F.coalesce(F.sum("_sum").over(
                   Window.partitionBy(*groups).orderBy(part)
                   .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_offset"))
    summed = cut.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    match = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    condition = match[0]
    for other in match[1:]:
        condition = condition & other
    return (summed.join(offsets, condition)
            .withColumn(name, F.col(name) + F.col("_offset"))
            .drop(part, "_offset", *[f"_k{i}" for i in range(len(keys))]))


# Multipliers of the index permutations: primes below 2**20, so that a product with an index
# below 2**43 stays a long. One of the four never divides a size below 10**23.
PRIMES = (1048573, 1048571, 1048559, 1048549)


def permuted(df: DataFrame, index: str, size: str, seed: str, name: str) -> DataFrame:
    """Add ``name``: the place of ``index`` in a pseudorandom permutation of 0..size-1.

    Affine maps modulo the size alternate with xor-shifts of the largest power of two that fits,
    once at the low and once at the high end. Every step is a bijection, so the whole is one.
    Sizes stay below 2**43.
    """
    n, seed_column = F.col(size), F.col(seed) if seed in df.columns else F.lit(int(seed))
    prime = F.lit(PRIMES[-1])
    for p in reversed(PRIMES[:-1]):
        prime = F.when(n % p != 0, F.lit(p)).otherwise(prime)
    bits = F.length(F.bin(n)) - 1

    def affine(x: Column, step: int) -> Column:
        return (x * F.col("_a") + seed_column * (7919 + 104729 * step)) % n

    def shifted(x: Column) -> Column:
        return x.bitwiseXOR(F.floor(x / F.col("_h")))

    low = F.col("_x")
    high = F.col("_x") - (n - F.col("_p"))
    return (df.withColumn("_a", prime.cast("long"))
            .withColumn("_p", F.pow(F.lit(2.0), bits).cast("long"))
            .withColumn("_h", F.pow(F.lit(2.0), F.floor(bits / 2) + 1).cast("long"))
            .withColumn("_x", affine(F.col(index), 1))
            .withColumn("_x", affine(F.when(low < F.col("_p"), shifted(low)).otherwise(low), 2))
            .withColumn("_x", affine(F.when(high >= 0, n - F.col("_p") + shifted(high))
                                     .otherwise(low), 3))
            .withColumn(name, F.col("_x")).drop("_a", "_p", "_h", "_x"))


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of equal values."""
    if not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate(([0], cut)), np.concatenate((cut, [len(values)]))
