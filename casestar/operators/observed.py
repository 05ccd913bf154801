"""Counts observed on the rows of a job that runs anyway, instead of in a pass of their own."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Watch:
    """Metrics of several places of one plan, filled by the action that runs it.

    Rows that a result stage writes are counted once whatever happens. A place before a shuffle
    is counted again for every task that runs again after a lost executor: ``is_exact`` tells.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._places: list[tuple[Observation, list[str]]] = []
        self._tag = f"watch-{uuid.uuid4().hex}"

    def on(self, df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
        place = Observation(f"casestar-{uuid.uuid4().hex}")
        self._places.append((place, list(metrics)))
        return df.observe(place, *[metric.alias(name) for name, metric in metrics.items()])

    @contextmanager
    def running(self):
        """The block in which the watched action runs."""
        self._spark.sparkContext.addJobTag(self._tag)
        try:
            yield self
        finally:
            self._spark.sparkContext.removeJobTag(self._tag)

    def values(self) -> dict[str, int]:
        """The metrics of all places, after the action. What no row reached is 0: the optimizer
        takes a place out of the plan if it sees that no row can come there."""
        found: dict[str, int] = {}
        for place, names in self._places:
            reached = place._jo.getRow().length() > 0
            seen = place.get if reached else {}
            found |= {name: seen.get(name) or 0 for name in names}
        return found

    def is_exact(self) -> bool:
        """No stage of the action ran a second time."""
        return not stage_ran_again(self._spark, self._tag)


def added(counts: Iterable[dict[str, int]]) -> dict[str, int]:
    """The counts of several passes over different rows, added up by name."""
    total: dict[str, int] = {}
    for found in counts:
        total |= {name: total.get(name, 0) + int(value) for name, value in found.items()}
    return total


def watched(df: DataFrame, watch: Watch | None, metrics: dict[str, Column]) -> DataFrame:
    return df if watch is None else watch.on(df, metrics)


def stage_ran_again(spark: SparkSession, tag: str) -> bool:
    tracker = spark.sparkContext._jsc.sc().statusTracker()
    for job in tracker.getJobIdsForTag(tag):
        info = tracker.getJobInfo(job)
        for stage in (info.get().stageIds() if info.isDefined() else ()):
            found = tracker.getStageInfo(stage)
            if found.isDefined() and found.get().currentAttemptId() > 0:
                return True
    return False


def row_count() -> Column:
    return F.count(F.lit(1))


def fingerprint(key: str, prefix: str) -> dict[str, Column]:
    """Sums over the values of ``key`` that do not depend on their order.

    Two frames with equal counts and equal sums of two independent 64-bit hashes hold the same
    values equally often, but for a chance of about 2**-128.
    """
    value = F.col(key)
    return {f"{prefix}_{at}": F.sum(F.xxhash64(value, F.lit(at)).cast("decimal(20,0)"))
            for at in (1, 2)}


def same_values(metrics, left: str, right: str) -> bool:
    """Whether the fingerprints with these prefixes agree in ``metrics`` (a row or a dict)."""
    return all((metrics[f"{left}_{at}"] or 0) == (metrics[f"{right}_{at}"] or 0) for at in (1, 2))
