"""Dimension specs and the dimension build."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casestar.config import FACTOR_COLUMNS, VEHICLE_COLUMNS, CleanRules
from casestar.operators.clean import key_column
from casestar.operators.keys import KeyedTable, number_ranged


@dataclass(frozen=True)
class Dimension:
    """``natural`` maps a join-key column to (source, placeholder); None joins on the source as is.

    ``attributes`` are published as the smallest value seen under a natural key, ``derived``
    are computed from the published row.
    """

    name: str
    key: str
    natural: dict[str, tuple[str, object]]
    attributes: tuple[str, ...]
    published: tuple[str, ...]
    derived: dict[str, Column] = field(default_factory=dict)

    @property
    def natural_names(self) -> list[str]:
        return list(self.natural)

    def natural_columns(self, null_safe: bool = False) -> list[Column]:
        """Join keys. The null-safe form keeps null as null, so no text can clash with it."""
        columns = []
        for out, (source, placeholder) in self.natural.items():
            if placeholder is None:
                columns.append(F.col(source).alias(out))
            elif not null_safe:
                columns.append(key_column(F.col(source), placeholder).alias(out))
            elif isinstance(placeholder, str):
                columns.append(F.trim(source).alias(out))
            else:
                columns.append(F.col(source).alias(out))
        return columns

    def sources(self) -> list[str]:
        return list(dict.fromkeys([s for s, _ in self.natural.values()] + list(self.attributes)))


def standard_dimensions(rules: CleanRules) -> dict[str, Dimension]:
    marks = rules.placeholders
    day = F.col("crash_date")
    date = Dimension(
        name="dim_date",
        key="date_key",
        natural={"crash_date": ("crash_date", None),
                 "j_crash_time": ("crash_time", marks["crash_time"])},
        attributes=("crash_time", "hour"),
        published=("crash_date", "crash_time", "hour", "day_of_week", "month", "year", "is_weekend"),
        derived={
            "day_of_week": F.dayofweek(day),
            "month": F.month(day),
            "year": F.year(day),
            "is_weekend": F.dayofweek(day).isin(*rules.weekend_days),
        },
    )
    places = ("borough", "zip_code", "on_street_name")
    points = ("latitude", "longitude")
    location = Dimension(
        name="dim_location",
        key="location_key",
        natural={f"j_{name}": (name, marks[name]) for name in places}
        | {f"j_{name}": (name, marks["coordinate"]) for name in points},
        attributes=places + points,
        published=places + points + ("geo_imputed",),
        derived={"geo_imputed": F.lit(False)},
    )
    vehicle = Dimension(
        name="dim_vehicle",
        key="vehicle_key",
        natural={f"j_{name}": (name, marks["vehicle_type"]) for name in VEHICLE_COLUMNS},
        attributes=VEHICLE_COLUMNS,
        published=VEHICLE_COLUMNS,
    )
    factor = Dimension(
        name="dim_factor",
        key="factor_key",
        natural={f"j_{name}": (name, marks["factor"]) for name in FACTOR_COLUMNS},
        attributes=FACTOR_COLUMNS,
        published=FACTOR_COLUMNS,
    )
    return {d.name: d for d in (date, location, vehicle, factor)}


@dataclass(frozen=True)
class PublishedDimension:
    """A dimension as an earlier build published it, and its measured size."""

    frame: DataFrame
    payload_bytes: int

    def is_broadcast(self, limit: int) -> bool:
        return self.payload_bytes <= limit


def build_dimension(clean: DataFrame, dim: Dimension, stage_path: str,
                    null_safe: bool = False, previous: PublishedDimension | None = None,
                    broadcast_limit: int = 0) -> KeyedTable:
    """Rows of one dimension with a dense key, still carrying the natural-key columns.

    With ``previous`` its rows stay as they were published, keys and spellings, whether or not
    they still occur; only natural keys that it does not have are numbered, after its largest key
    and in their own order.

    The distinct comes first: it hashes, combines in the map tasks and leaves one row per
    spelling, however often the hottest one occurs. The minimum over text then sorts only
    those few. Range partitioning serves both that grouping and the numbering.
    """
    variants = clean.select(*dim.sources()).distinct()
    naturals = dim.natural_names
    chosen = [name for name in dim.attributes if name not in naturals]
    found = variants.select(*dim.natural_columns(null_safe), *chosen)
    if previous is not None:
        if null_safe:
            raise ValueError("published rows are matched on keys with placeholders")
        old = previous.frame.select(dim.key, *dim.natural_columns(), *chosen)
        known = old.select(*naturals)
        found = found.join(F.broadcast(known) if previous.is_broadcast(broadcast_limit) else known,
                           naturals, "left_anti")
    grouped = found.repartitionByRange(*naturals).groupBy(*naturals).agg(
        *[F.min(name).alias(name) for name in chosen])
    added = number_ranged(grouped, naturals, dim.key, stage_path)
    if previous is None:
        return added
    last, rows = old.agg(F.coalesce(F.max(dim.key), F.lit(0)), F.count(F.lit(1))).first()
    shifted = added.frame.withColumn(dim.key, F.col(dim.key) + last)
    return KeyedTable(old.unionByName(shifted.select(*old.columns)), rows + added.rows,
                      previous.payload_bytes + added.payload_bytes)


def published_dimension(keyed: DataFrame, dim: Dimension) -> DataFrame:
    """The table as written: derived columns added, join-key helpers dropped."""
    return keyed.withColumns(dim.derived).select(dim.key, *dim.published)
