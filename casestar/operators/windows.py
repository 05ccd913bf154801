"""Ranking, previous-row comparison, positions, pivots and top-k over results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, partition, order, out: str, ties: bool = True) -> DataFrame:
    """``ties=True`` gives equal rows one rank and leaves a gap; False numbers them by ``order``."""
    window = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(out, (F.rank() if ties else F.row_number()).over(window))


def change_from_previous(df: DataFrame, order, measure: str, previous: str,
                         change: str) -> DataFrame:
    """Previous row's value and the difference to it, by row order: a gap is skipped over.

    The window is unpartitioned, so give it a result with few rows, such as one per month.
    """
    before = F.lag(measure).over(Window.orderBy(*order))
    return df.withColumn(previous, before).withColumn(change, F.col(measure) - before)


def positions(df: DataFrame, order, out: str) -> DataFrame:
    """0-based place of each row of a small ordered result."""
    return df.withColumn(out, F.row_number().over(Window.orderBy(*order)) - 1)


def pivot_matrix(df: DataFrame, row: str, column: str, values, measure: str, prefix: str = "",
                 fill: int | None = 0) -> DataFrame:
    """One row per ``row`` value and one column per listed ``column`` value.

    The values are listed by the caller, which saves the job that would look for them.
    ``fill=None`` leaves missing cells null.
    """
    matrix = df.groupBy(row).pivot(column, list(values)).agg(F.sum(measure))
    matrix = matrix.select(row, *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values])
    return matrix if fill is None else matrix.na.fill(fill)


def top_k(df: DataFrame, order, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def highlight(df: DataFrame, column: str | Column, value, out: str = "is_highlighted") -> DataFrame:
    """Mark the rows whose column equals the chosen value."""
    tested = F.col(column) if isinstance(column, str) else column
    return df.withColumn(out, tested.eqNullSafe(F.lit(value)))


def pick(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def picker_values(df: DataFrame, column: str | Column, out: str = "value") -> DataFrame:
    """Distinct values in order, as text."""
    return distinct_text(df, column, out).orderBy(out)


def distinct_text(df: DataFrame, column: str | Column, out: str = "value") -> DataFrame:
    source = F.col(column) if isinstance(column, str) else column
    return df.select(source.cast("string").alias(out)).distinct()


def roll_up(df: DataFrame, by, measure: str, out: str) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(measure).alias(out))
