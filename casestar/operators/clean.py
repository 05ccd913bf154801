"""Cleaning steps, each ``DataFrame -> DataFrame`` for use with ``df.transform``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casestar.functions import (
    all_zero,
    exceeds,
    hour_of_stamp,
    is_blank,
    lenient_double,
    lenient_int,
    lenient_long,
    null_outside,
    null_zero,
    trimmed_or,
    utc_stamp,
)

_LENIENT = {"int": lenient_int, "bigint": lenient_long, "double": lenient_double}


def rename_raw(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Project the raw headers in ``names`` to their published names; extra columns are left out."""
    return df.select(*[F.col(f"`{raw}`").alias(name) for raw, name in names.items()])


def drop_blank_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(~is_blank(F.col(key)))


def _other_columns(df: DataFrame, key: str, leading) -> list[str]:
    first = list(leading or [])
    return first + [name for name in df.columns if name != key and name not in first]


def dedup_by_key(df: DataFrame, key: str, order_cols: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest in the order of ``order_cols`` (default: all the others).

    Columns outside ``order_cols`` break the remaining ties, so the survivor does not depend
    on partitioning. Because only row number 1 is kept, each map task already drops all but
    its own smallest copy before the shuffle (``WindowGroupLimit`` in the plan): a key that
    owns a third of the table arrives at its reducer as one row per map task.
    """
    order = [F.col(f"`{name}`").asc_nulls_first() for name in _other_columns(df, key, order_cols)]
    place = F.row_number().over(Window.partitionBy(F.col(f"`{key}`")).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def first_with_copies(df: DataFrame, key: str, copies: str) -> DataFrame:
    """The rows of ``dedup_by_key`` plus how many rows each key had, combined in the map tasks."""
    rest = _other_columns(df, key, None)
    grouped = df.groupBy(F.col(f"`{key}`")).agg(
        F.min(F.struct(*[F.col(f"`{name}`") for name in rest])).alias("_first"),
        F.count(F.lit(1)).alias(copies),
    )
    return grouped.select(F.col(f"`{key}`"), "_first.*", copies)


def dedup_any(df: DataFrame, key: str) -> DataFrame:
    """One row per key, whichever comes first: fine where copies are known to be equal."""
    return df.dropDuplicates([key])


def lenient_cast(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.withColumns({name: _LENIENT[kind](F.col(name)) for name, kind in kinds.items()})


def zero_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({name: null_zero(F.col(name)) for name in columns})


def null_out_of_range(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {name: null_outside(F.col(name), low, high) for name, (low, high) in ranges.items()}
    )


def parse_date(df: DataFrame, source: str, date_format: str, out: str) -> DataFrame:
    return df.withColumn(out, F.try_to_date(F.col(source), date_format))


def parse_date_drop_invalid(df: DataFrame, source: str, date_format: str, out: str) -> DataFrame:
    return parse_date(df, source, date_format, out).filter(F.col(out).isNotNull())


def event_hour(df: DataFrame, date_text: str, time_text: str, out: str, date_format: str,
               time_format: str, default_time: str) -> DataFrame:
    stamp = utc_stamp(F.col(date_text), F.col(time_text), date_format, time_format, default_time)
    return df.withColumn(out, hour_of_stamp(stamp))


def all_zero_flag(df: DataFrame, columns: list[str], out: str) -> DataFrame:
    return df.withColumn(out, all_zero([F.col(name) for name in columns]))


def above_flag(df: DataFrame, column: str, threshold: int, out: str) -> DataFrame:
    return df.withColumn(out, exceeds(F.col(column), threshold))


def normalize_keys(df: DataFrame, keys: dict[str, tuple[str, object]]) -> DataFrame:
    """Add join keys ``{out: (source, placeholder)}``; a numeric placeholder is not trimmed."""
    return df.withColumns({out: key_column(F.col(source), placeholder)
                           for out, (source, placeholder) in keys.items()})


def key_column(source: Column, placeholder) -> Column:
    if isinstance(placeholder, str):
        return trimmed_or(source, placeholder)
    return F.coalesce(source, F.lit(placeholder))
