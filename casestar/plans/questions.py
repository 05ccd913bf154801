"""The business questions, as roll-ups over the star.

Year and month come from the fact's partition columns, which equal the date dimension's by
construction: a year filter then prunes folders, and a question about months alone reads no
dimension at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casestar.config import QuestionRules
from casestar.functions import day_part, period_label, rate_per, severity, year_month_label
from casestar.operators.rollup import Rollup, star_base, star_rollup
from casestar.operators.windows import change_from_previous, rank_within, top_k
from casestar.sources.warehouse import Warehouse

FACT, DATE, LOCATION = "fact_crash", "dim_date", "dim_location"
VEHICLE, FACTOR = "dim_vehicle", "dim_factor"


def crashes_by_borough(warehouse: Warehouse) -> DataFrame:
    borough = F.col("borough")
    counted = star_rollup(warehouse, Rollup(
        keys={"borough": (LOCATION, borough)},
        count="total_crashes",
        where={LOCATION: borough.isNotNull()},
    ))
    return counted.orderBy(F.desc("total_crashes"), "borough")


def fatality_rates(warehouse: Warehouse, rules: QuestionRules = QuestionRules()) -> DataFrame:
    """Q1: deaths per 1000 crashes by borough and year, ranked within the year."""
    borough, year = F.col("borough"), F.col("partition_year")
    counted = star_rollup(warehouse, Rollup(
        keys={"borough": (LOCATION, borough), "year": (FACT, year)},
        count="total_crashes",
        sums={"total_fatalities": "persons_killed"},
        where={LOCATION: borough.isNotNull(), FACT: year.between(*rules.rate_years)},
    ))
    rate = f"fatality_rate_per_{rules.rate_scale}_crashes"
    rated = counted.withColumn(
        rate, rate_per(F.col("total_fatalities"), F.col("total_crashes"), rules.rate_scale))
    ranked = rank_within(rated, ["year"], [F.desc(rate)], "fatality_rank_within_year")
    return ranked.orderBy("borough", "year")


def pedestrian_peak_hours(warehouse: Warehouse) -> DataFrame:
    """Q2: pedestrian injuries by hour, weekday and leading factor."""
    hour, day, factor = F.col("hour"), F.col("day_of_week"), F.col("factor_1")
    summed = star_rollup(warehouse, Rollup(
        keys={"hour": (DATE, hour), "day_of_week": (DATE, day),
              "contributing_factor": (FACTOR, factor)},
        sums={"total_pedestrian_injuries": "pedestrians_injured"},
        where={DATE: hour.isNotNull() & day.isNotNull(), FACTOR: factor.isNotNull()},
    ))
    return summed.orderBy(F.desc("total_pedestrian_injuries"), "hour", "day_of_week",
                          "contributing_factor")


def pedestrian_heatmap(warehouse: Warehouse) -> DataFrame:
    """Q2: pedestrian injuries by weekday and hour."""
    hour, day = F.col("hour"), F.col("day_of_week")
    summed = star_rollup(warehouse, Rollup(
        keys={"day_of_week": (DATE, day), "hour": (DATE, hour)},
        sums={"total_pedestrian_injuries": "pedestrians_injured"},
        where={DATE: hour.isNotNull() & day.isNotNull()},
    ))
    return summed.orderBy("day_of_week", "hour")


def severity_by_vehicle(warehouse: Warehouse) -> DataFrame:
    """Q3: fatal and non-fatal crashes by borough and first vehicle type."""
    borough, vehicle = F.col("borough"), F.col("vehicle_type_1")
    counted = star_rollup(warehouse, Rollup(
        keys={"borough": (LOCATION, borough), "vehicle_type_1": (VEHICLE, vehicle),
              "crash_severity": (FACT, severity(F.col("persons_killed")))},
        count="crash_count",
        where={LOCATION: borough.isNotNull(), VEHICLE: vehicle.isNotNull()},
    ))
    return counted.orderBy(F.desc("crash_count"), "borough", "vehicle_type_1", "crash_severity")


def cyclist_months(warehouse: Warehouse, rules: QuestionRules = QuestionRules()) -> DataFrame:
    """Q4: cyclist injuries per month, compared with the month before."""
    year, month = F.col("partition_year"), F.col("partition_month")
    summed = star_rollup(warehouse, Rollup(
        keys={"year": (FACT, year), "month": (FACT, month),
              "period": (FACT, period_label(year, rules.period_split_year))},
        sums={"total_cyclist_injuries": "cyclists_injured"},
        where={FACT: year >= rules.trend_first_year},
    ))
    compared = change_from_previous(summed, ["year", "month"], "total_cyclist_injuries",
                                    "previous_month_injuries", "month_over_month_change")
    labelled = compared.withColumn("year_month", year_month_label(F.col("year"), F.col("month")))
    return labelled.select(
        "year", "month", "total_cyclist_injuries", "period",
        "previous_month_injuries", "month_over_month_change", "year_month",
    ).orderBy("year", "month")


def cyclist_periods(warehouse: Warehouse, rules: QuestionRules = QuestionRules()) -> DataFrame:
    """Q4: cyclist injuries before and after the split year."""
    year = F.col("partition_year")
    summed = star_rollup(warehouse, Rollup(
        keys={"period": (FACT, period_label(year, rules.period_split_year))},
        sums={"total_cyclist_injuries": "cyclists_injured"},
        averages={"avg_row_cyclist_injuries": "cyclists_injured"},
        where={FACT: year >= rules.trend_first_year},
    ))
    return summed.orderBy("period")


def severe_crash_factors(warehouse: Warehouse, rules: QuestionRules = QuestionRules()) -> DataFrame:
    """Q5: leading factors of multi-vehicle crashes with several injured, ranked by day part."""
    hour, factor = F.col("hour"), F.col("factor_1")
    counted = star_rollup(warehouse, Rollup(
        keys={"contributing_factor": (FACTOR, factor),
              "time_of_day": (DATE, day_part(hour, rules.day_parts, rules.night_label))},
        count="crash_count",
        where={FACT: F.col("persons_injured") >= rules.severe_injured_at_least,
               VEHICLE: F.col("vehicle_type_2").isNotNull(),
               FACTOR: factor.isNotNull(),
               DATE: hour.isNotNull()},
    ))
    ranked = rank_within(counted, ["time_of_day"], [F.desc("crash_count"), "contributing_factor"],
                         "factor_rank_within_time_of_day", ties=False)
    return ranked.orderBy(F.desc("crash_count"), "contributing_factor", "time_of_day")


def located_points(warehouse: Warehouse, rules: QuestionRules = QuestionRules()) -> DataFrame:
    """Coordinates of all located crashes. A caller's ``geo_limit`` keeps the lowest ids."""
    located = star_base(warehouse, [LOCATION], ["collision_id", "latitude", "longitude"]).filter(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if rules.geo_limit is not None:
        located = top_k(located, ["collision_id"], rules.geo_limit)
    return located.select("latitude", "longitude")
