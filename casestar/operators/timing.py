"""Timing an action. Rows stay on the executors."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame


def timed_run(df: DataFrame) -> float:
    """Seconds to compute every row and column."""
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def timed_count(df: DataFrame) -> tuple[int, float]:
    started = time.perf_counter()
    rows = df.count()
    return rows, time.perf_counter() - started
