"""Session settings the library is tuned for, and the folder it may stage tables in."""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import SparkSession

# ANSI stays on: malformed input is handled by try_* expressions, not by a looser session.
COMMON_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # a build runs more generated classes than the default 100, and each one that is evicted
    # starts cold again
    "spark.sql.codegen.cache.maxEntries": "2000",
}

LOCAL_SETTINGS = {
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}

SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
SHUFFLE_WIDTH = 50_000
# Input of a pass before there is another one, and how many passes there are at most.
PASS_BYTES, MOST_PASSES = 64 * 1024 * 1024, 4
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scale_settings(shuffle_bytes: int, least: int = 200) -> dict[str, str]:
    """Settings for a known amount of shuffled data.

    Partitions start at about 128 MB each, small enough to sort in memory, and the adaptive
    planner merges the ones that turn out smaller. A shuffle writes a block per scan task and
    partition, so from about 6 TB on partitions and scan pieces grow instead of their number,
    and partitions may spill: 2 GB and 1 GB at 100 TB. ``least`` is the number to start from.
    """
    piece = max(SHUFFLE_PARTITION_BYTES, -(-shuffle_bytes // SHUFFLE_WIDTH))
    partitions = str(max(least, -(-shuffle_bytes // piece)))
    return {
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(max(2 * SHUFFLE_PARTITION_BYTES, piece // 2)),
    }


def passes_for(input_bytes: int) -> int:
    """In how many passes a build of so many input bytes goes over its rows. Each pass shuffles its
    share of them, so disk for shuffle files falls with the number, while all is read once a pass."""
    return min(MOST_PASSES, 1 + input_bytes // PASS_BYTES)


@contextmanager
def released_shuffles(spark: SparkSession):
    """A block of actions whose shuffle files go when the action ends. They would otherwise stay
    until the driver's garbage collector finds the plan unused, which may be after the build.

    A frame made in the block and run twice shuffles twice: write it and read that.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def get_session(app: str = "casestar", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings. ``master=None`` leaves the choice to spark-submit."""
    builder = SparkSession.builder.appName(app)
    chosen = dict(COMMON_SETTINGS)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            chosen |= LOCAL_SETTINGS
    chosen |= settings
    for name, value in chosen.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for staged tables: ``spark.checkpoint.dir``, which every executor can reach.

    A session with one machine (``local`` or ``local[n]``) that does not set it stages below its
    warehouse folder; any other has to set it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
