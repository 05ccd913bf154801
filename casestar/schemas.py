"""Declared schemas: raw text input, the five warehouse tables, published results."""

from __future__ import annotations

from pyspark.sql import types as T

from casestar.config import (
    COUNT_COLUMNS,
    FACTOR_COLUMNS,
    PARTITION_COLUMNS,
    RAW_TO_PUBLISHED,
    VEHICLE_COLUMNS,
)


def fields(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def all_strings(names) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


TEXT, INT, LONG, REAL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
FLAG, DAY, RATE = T.BooleanType(), T.DateType(), T.DecimalType(38, 13)

RAW = all_strings(RAW_TO_PUBLISHED)

FACT_CRASH = fields(
    collision_id=LONG,
    date_key=LONG,
    location_key=LONG,
    vehicle_key=LONG,
    factor_key=LONG,
    **{name: INT for name in COUNT_COLUMNS},
    property_damage_only=FLAG,
    injury_count_flagged=FLAG,
    **{name: INT for name in PARTITION_COLUMNS},
)
DIM_DATE = fields(
    date_key=LONG, crash_date=DAY, crash_time=TEXT, hour=INT,
    day_of_week=INT, month=INT, year=INT, is_weekend=FLAG,
)
DIM_LOCATION = fields(
    location_key=LONG, borough=TEXT, zip_code=TEXT, on_street_name=TEXT,
    latitude=REAL, longitude=REAL, geo_imputed=FLAG,
)
DIM_VEHICLE = fields(vehicle_key=LONG, **{name: TEXT for name in VEHICLE_COLUMNS})
DIM_FACTOR = fields(factor_key=LONG, **{name: TEXT for name in FACTOR_COLUMNS})

WAREHOUSE = {
    "fact_crash": FACT_CRASH,
    "dim_date": DIM_DATE,
    "dim_location": DIM_LOCATION,
    "dim_vehicle": DIM_VEHICLE,
    "dim_factor": DIM_FACTOR,
}

RESULTS = {
    "partition_summary": fields(partition_year=INT, partition_month=INT),
    "q1_borough_fatality_rates": fields(
        borough=TEXT, year=INT, total_crashes=LONG, total_fatalities=LONG,
        fatality_rate_per_1000_crashes=RATE, fatality_rank_within_year=INT,
    ),
    "q2_peak_hours_pedestrian_injuries": fields(
        hour=INT, day_of_week=INT, contributing_factor=TEXT, total_pedestrian_injuries=LONG,
    ),
    "q2_hour_day_heatmap": fields(day_of_week=INT, hour=INT, total_pedestrian_injuries=LONG),
    "q3_vehicle_fatal_nonfatal_by_borough": fields(
        borough=TEXT, vehicle_type_1=TEXT, crash_severity=TEXT, crash_count=LONG,
    ),
    "q4_cyclist_injury_trends_monthly": fields(
        year=INT, month=INT, total_cyclist_injuries=LONG, period=TEXT,
        previous_month_injuries=LONG, month_over_month_change=LONG, year_month=TEXT,
    ),
    "q4_pre_post_2019_summary": fields(
        period=TEXT, total_cyclist_injuries=LONG, avg_row_cyclist_injuries=REAL,
    ),
    "q5_multi_vehicle_3plus_injuries_factors": fields(
        contributing_factor=TEXT, time_of_day=TEXT, crash_count=LONG,
        factor_rank_within_time_of_day=INT,
    ),
    "bonus_geo_density_points": fields(latitude=REAL, longitude=REAL),
}


def result_schema(name: str, rate_scale: int = 1000) -> T.StructType:
    """The schema of a published result; the rate's column is named by its scale."""
    return T.StructType([
        T.StructField(f.name.replace("per_1000_", f"per_{rate_scale}_"), f.dataType, f.nullable)
        for f in RESULTS[name].fields])
