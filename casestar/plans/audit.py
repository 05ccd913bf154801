"""What a build dropped, nulled, flagged and wrote, counted once more.

Every build writes these counts itself, observed on the rows it writes (``Warehouse.audit``). This
is the independent way: passes over the raw and the published tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casestar.config import CleanRules, RawColumns
from casestar.operators.clean import rename_raw
from casestar.operators.quality import coordinate_audit, count_flags, step_audit, table_counts
from casestar.plans.etl import COORDINATES, unique_coordinates
from casestar.sources.warehouse import Warehouse


def recounted_audit(raw: DataFrame, warehouse: Warehouse, columns: RawColumns = RawColumns(),
                rules: CleanRules = CleanRules()) -> DataFrame:
    """One row per count of a build: ``section``, ``item``, ``observed``.

    Two passes over the leading columns of the raw table, one for the steps and one for the
    coordinates; flags and table sizes come from the published tables.
    """
    steps = step_audit(rename_raw(raw, columns.names), "collision_id", "crash_date",
                       rules.date_format)
    coordinates = coordinate_audit(unique_coordinates(raw, columns), *COORDINATES,
                                   rules.latitude_range, rules.longitude_range)
    flags = count_flags(warehouse.table("fact_crash"), {
        "property_damage_only_rows": F.col("property_damage_only"),
        "injury_count_flagged_rows": F.col("injury_count_flagged"),
    })
    tables = table_counts(warehouse.tables())
    return reduce(DataFrame.unionByName, [
        _items(steps, F.col("step"), "rows_before", "rows_removed", "rows_after"),
        _items(coordinates, F.lit("coordinates"), *coordinates.columns),
        _items(flags, F.lit("flags"), *flags.columns),
        _items(tables, F.col("table_name"), "row_count"),
    ])


def _items(metrics: DataFrame, section, *names: str) -> DataFrame:
    """Each metric of each row as a row of its own."""
    rows = [F.struct(section.alias("section"), F.lit(name).alias("item"),
                     F.col(name).cast("bigint").alias("observed")) for name in names]
    return metrics.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
