"""Column roles, cleaning rules and question parameters. Every one can be replaced by the caller."""

from __future__ import annotations

from dataclasses import dataclass, field

# Header names of the raw file, the published names they get, and the
# placeholder texts of the join keys. They have to match existing files and warehouses.
RAW_TO_PUBLISHED = {
    "COLLISION_ID": "collision_id",
    "CRASH DATE": "crash_date",
    "CRASH TIME": "crash_time",
    "BOROUGH": "borough",
    "ZIP CODE": "zip_code",
    "ON STREET NAME": "on_street_name",
    "LATITUDE": "latitude",
    "LONGITUDE": "longitude",
    "NUMBER OF PERSONS INJURED": "persons_injured",
    "NUMBER OF PERSONS KILLED": "persons_killed",
    "NUMBER OF PEDESTRIANS INJURED": "pedestrians_injured",
    "NUMBER OF PEDESTRIANS KILLED": "pedestrians_killed",
    "NUMBER OF CYCLIST INJURED": "cyclists_injured",
    "NUMBER OF CYCLIST KILLED": "cyclists_killed",
    "NUMBER OF MOTORIST INJURED": "motorists_injured",
    "NUMBER OF MOTORIST KILLED": "motorists_killed",
    "VEHICLE TYPE CODE 1": "vehicle_type_1",
    "VEHICLE TYPE CODE 2": "vehicle_type_2",
    "VEHICLE TYPE CODE 3": "vehicle_type_3",
    "VEHICLE TYPE CODE 4": "vehicle_type_4",
    "VEHICLE TYPE CODE 5": "vehicle_type_5",
    "CONTRIBUTING FACTOR VEHICLE 1": "factor_1",
    "CONTRIBUTING FACTOR VEHICLE 2": "factor_2",
    "CONTRIBUTING FACTOR VEHICLE 3": "factor_3",
    "CONTRIBUTING FACTOR VEHICLE 4": "factor_4",
    "CONTRIBUTING FACTOR VEHICLE 5": "factor_5",
}
REQUIRED_COLUMNS = ("COLLISION_ID", "CRASH DATE", "BOROUGH", "ZIP CODE", "LATITUDE", "LONGITUDE")
PLACEHOLDERS = {
    "crash_time": "UNKNOWN_TIME",
    "borough": "UNKNOWN_BOROUGH",
    "zip_code": "UNKNOWN_ZIP",
    "on_street_name": "UNKNOWN_STREET",
    "vehicle_type": "UNKNOWN_VEHICLE",
    "factor": "UNKNOWN_FACTOR",
    "coordinate": -9999.0,
}

COUNT_COLUMNS = tuple(f"{who}_{what}" for who in ("persons", "pedestrians", "cyclists", "motorists")
                      for what in ("injured", "killed"))
VEHICLE_COLUMNS = tuple(f"vehicle_type_{n}" for n in range(1, 6))
FACTOR_COLUMNS = tuple(f"factor_{n}" for n in range(1, 6))
PARTITION_COLUMNS = ("partition_year", "partition_month")


@dataclass(frozen=True)
class RawColumns:
    """Which raw header plays which role."""

    names: dict[str, str] = field(default_factory=lambda: dict(RAW_TO_PUBLISHED))
    required: tuple[str, ...] = REQUIRED_COLUMNS


@dataclass(frozen=True)
class CleanRules:
    latitude_range: tuple[float, float] = (40.4, 40.9)
    longitude_range: tuple[float, float] = (-74.3, -73.7)
    date_format: str = "MM/dd/yyyy"
    time_format: str = "H:mm"
    default_time: str = "00:00"
    outlier_above: int = 20
    weekend_days: tuple[int, ...] = (1, 7)
    placeholders: dict = field(default_factory=lambda: dict(PLACEHOLDERS))


@dataclass(frozen=True)
class QuestionRules:
    rate_years: tuple[int, int] = (2012, 2025)
    rate_scale: int = 1000
    trend_first_year: int = 2012
    period_split_year: int = 2019
    severe_injured_at_least: int = 3
    geo_limit: int | None = None  # all located incidents
    # hour ranges are inclusive; every other hour is ``night_label``
    day_parts: tuple[tuple[str, int, int], ...] = (
        ("Morning", 5, 11),
        ("Afternoon", 12, 16),
        ("Evening", 17, 20),
    )
    night_label: str = "Night"
