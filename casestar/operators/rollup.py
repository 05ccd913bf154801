"""Star joins and star aggregates over a published warehouse."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casestar.sources.warehouse import Warehouse

# dimension -> foreign key
FOREIGN_KEYS = {
    "dim_date": "date_key",
    "dim_location": "location_key",
    "dim_vehicle": "vehicle_key",
    "dim_factor": "factor_key",
}
# Facts per dimension row from which grouping before the join pays for its own shuffle.
PREAGGREGATE_RATIO = 4


# what a fact's folders repeat of a dimension
FOLDERS = {"dim_date": {"partition_year": "year", "partition_month": "month"}}


def star_base(warehouse: Warehouse, dims=tuple(FOREIGN_KEYS), columns=None,
              prune: bool = False) -> DataFrame:
    """The fact with the attributes of ``dims``, in the published column order.

    List only the dimensions a question reads: an unused left join is not removed for you.
    ``prune`` joins a dimension on the folder columns as well, which equal its own by
    construction: a filter on any of its attributes then prunes folders while the query runs.
    """
    fact = warehouse.table("fact_crash")
    joined = fact
    for name in dims:
        side, key = warehouse.join_side(name), FOREIGN_KEYS[name]
        if prune and name in FOLDERS:
            match = F.col(key) == F.col(f"_{key}")
            for folder, attribute in FOLDERS[name].items():
                match = match & (F.col(folder) == F.col(attribute))
            joined = joined.join(side.withColumnRenamed(key, f"_{key}"), match, "left")
        else:
            joined = joined.join(side, key, "left")
    attributes = [c for name in dims for c in warehouse.table(name).columns
                  if c not in (FOREIGN_KEYS[name], "geo_imputed")]
    measures = [c for c in fact.columns
                if c not in FOREIGN_KEYS.values() and not c.startswith("partition_")]
    partitions = [c for c in fact.columns if c.startswith("partition_")]
    return joined.select(*(columns or measures + attributes + partitions))


def register_star_view(warehouse: Warehouse, view: str = "analytics_base") -> DataFrame:
    """The whole star as a temporary view for SQL text; date filters prune the fact's folders."""
    base = star_base(warehouse, prune=True)
    base.createOrReplaceTempView(view)
    return base


@dataclass(frozen=True)
class Rollup:
    """An aggregate over the star.

    ``keys`` maps an output name to (table, expression), the table being ``fact_crash`` or a
    dimension. ``sums`` maps an output name to a fact column; ``averages`` likewise;
    ``count`` names the row count. ``where`` holds one filter per table.
    """

    keys: dict[str, tuple[str, Column]]
    count: str | None = None
    sums: dict[str, str] = field(default_factory=dict)
    averages: dict[str, str] = field(default_factory=dict)
    where: dict[str, Column] = field(default_factory=dict)


def star_rollup(warehouse: Warehouse, rollup: Rollup) -> DataFrame:
    """Run a ``Rollup``.

    Dimensions of a proven small size are broadcast into the fact scan. For a larger one the
    facts are first summed per foreign key, so a hot key shrinks inside the map tasks and the
    join shuffles one row per key instead of one per fact. Sums, counts and averages all
    combine, so both routes give the same result.
    """
    tables = {table for table, _ in rollup.keys.values()} | set(rollup.where)
    dims = [name for name in FOREIGN_KEYS if name in tables]
    large = [name for name in dims if not warehouse.fits_broadcast(name)]

    rows = warehouse.table("fact_crash")
    if "fact_crash" in rollup.where:
        rows = rows.filter(rollup.where["fact_crash"])
    measured = dict.fromkeys([*rollup.sums.values(), *rollup.averages.values()])
    rows = rows.select(
        *[FOREIGN_KEYS[name] for name in dims],
        *[expr.alias(out) for out, (table, expr) in rollup.keys.items() if table == "fact_crash"],
        *[F.col(name).alias(f"m_{name}") for name in measured],
    )
    ready = [out for out, (table, _) in rollup.keys.items() if table == "fact_crash"]

    for name in dims:
        if name not in large:
            rows = _attach(rows, warehouse, rollup, name)
            ready += _keys_of(rollup, name)
    partial = bool(large) and all(warehouse.facts_per_row(name) >= PREAGGREGATE_RATIO
                                  for name in large)
    if partial:
        rows = rows.groupBy(*[FOREIGN_KEYS[name] for name in large], *ready).agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.sum(f"m_{name}").alias(f"m_{name}") for name in measured],
            *[F.count(f"m_{name}").alias(f"n_{name}") for name in rollup.averages.values()],
        )
    for name in large:
        rows = _attach(rows, warehouse, rollup, name)
    return rows.groupBy(*rollup.keys).agg(*_measures(rollup, partial))


def _keys_of(rollup: Rollup, dim: str) -> list[str]:
    return [out for out, (table, _) in rollup.keys.items() if table == dim]


def _attach(rows: DataFrame, warehouse: Warehouse, rollup: Rollup, name: str) -> DataFrame:
    """Join one dimension, reduced to its filter and the output columns it supplies."""
    side = warehouse.table(name)
    test = rollup.where.get(name)
    if test is not None:
        side = side.filter(test)
    side = side.select(FOREIGN_KEYS[name],
                       *[expr.alias(out) for out, (table, expr) in rollup.keys.items()
                         if table == name])
    if warehouse.fits_broadcast(name):
        side = F.broadcast(side)
    joined = rows.join(side, FOREIGN_KEYS[name], "left" if test is None else "inner")
    return joined.drop(FOREIGN_KEYS[name])


def _measures(rollup: Rollup, partial: bool) -> list[Column]:
    measures = []
    if rollup.count:
        rows = F.sum("n_rows") if partial else F.count(F.lit(1))
        measures.append(rows.alias(rollup.count))
    for out, name in rollup.sums.items():
        measures.append(F.sum(f"m_{name}").alias(out))
    for out, name in rollup.averages.items():
        filled = F.sum(f"n_{name}") if partial else F.count(f"m_{name}")
        mean = F.sum(f"m_{name}").cast("double") / filled
        measures.append(F.when(filled > 0, mean).alias(out))
    return measures
