"""Chart-ready frames, picker and highlight frames, and the sentence report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casestar.operators.windows import (
    distinct_text,
    pivot_matrix,
    positions,
    roll_up,
    top_k,
)

RATE = "fatality_rate_per_1000_crashes"

# Section titles and sentence formats of the insight report, with the columns
# that fill them. They have to match reports already published.
SECTIONS = (
    ("Q1 Interpretation", (
        ("The highest borough-year fatality rate was %s in %d, with %.2f fatalities per {scale} crashes.",
         ("borough", "year", RATE)),
    )),
    ("Q2 Interpretation", (
        ("The peak pedestrian injury combination was hour %d, day_of_week %d, with factor '%s'.",
         ("hour", "day_of_week", "contributing_factor")),
        ("This combination recorded %d pedestrian injuries.", ("total_pedestrian_injuries",)),
    )),
    ("Q3 Interpretation", (
        ("The most frequent borough/vehicle/severity combination was %s with vehicle type '%s' "
         "and severity '%s'.", ("borough", "vehicle_type_1", "crash_severity")),
        ("This group recorded %d crashes.", ("crash_count",)),
    )),
    ("Q4 Interpretation", ()),
    ("Q5 Interpretation", (
        ("The top factor in multi-vehicle crashes with 3+ injuries was '%s' during '%s'.",
         ("contributing_factor", "time_of_day")),
        ("This group recorded %d crashes.", ("crash_count",)),
    )),
)

# Order that makes the leading row of each section's result unique.
LEADING = {
    "Q1 Interpretation": (F.desc, RATE, ("borough", "year")),
    "Q2 Interpretation": (F.desc, "total_pedestrian_injuries",
                          ("hour", "day_of_week", "contributing_factor")),
    "Q3 Interpretation": (F.desc, "crash_count", ("borough", "vehicle_type_1", "crash_severity")),
    "Q5 Interpretation": (F.desc, "crash_count", ("contributing_factor", "time_of_day")),
}


def insight_rows(results: Mapping[str, DataFrame], commentary: Mapping[str, list[str]] | None = None,
                 sections=SECTIONS, rate_scale: int = 1000) -> DataFrame:
    """The report as rows (section_no, line_no, line).

    ``results`` maps a section title to its result frame; an empty result leaves its section
    out. ``commentary`` adds the caller's fixed sentences after the computed ones. A section
    is its title, its sentences as list items, and an empty line.
    """
    notes = commentary or {}
    parts = []
    for number, (title, sentences) in enumerate(sections, start=1):
        if title not in results:
            continue
        rate = RATE.replace("1000", str(rate_scale))
        # a section without sentences only needs to know that there is a result
        order = _leading_order(title, rate)
        leader = top_k(results[title], order, 1) if order else results[title].limit(1)
        computed = [F.format_string("- " + text.replace("{scale}", str(rate_scale)),
                                    *[_printable(leader, rate if c == RATE else c) for c in columns])
                    for text, columns in sentences]
        fixed = [F.lit(f"- {text}") for text in notes.get(title, [])]
        lines = F.array(F.lit(title), *computed, *fixed, F.lit(""))
        parts.append(leader.select(F.lit(number).alias("section_no"),
                                   F.posexplode(lines).alias("at", "line")))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select("section_no", (F.col("at") + 1).alias("line_no"), "line")


def _printable(df: DataFrame, column: str) -> Column:
    # format_string knows no decimals
    if isinstance(df.schema[column].dataType, T.DecimalType):
        return F.col(column).cast("double")
    return F.col(column)


def _leading_order(title: str, rate: str):
    if title not in LEADING:
        return []
    direction, measure, ties = LEADING[title]
    return [direction(rate if measure == RATE else measure), *ties]


def borough_year_label() -> Column:
    return F.concat_ws("-", F.col("borough"), F.col("year").cast("string"))


def with_borough_year(rates: DataFrame) -> DataFrame:
    return rates.withColumn("borough_year", borough_year_label())


def top_rates(rates: DataFrame, k: int = 10) -> DataFrame:
    best = top_k(rates, [F.desc(RATE), "borough", "year"], k)
    return with_borough_year(best).select("borough_year", RATE)


def injuries_by_hour(heatmap: DataFrame) -> DataFrame:
    return roll_up(heatmap, ["hour"], "total_pedestrian_injuries",
                   "total_pedestrian_injuries").orderBy("hour")


def heatmap_matrix(heatmap: DataFrame, fill: int | None = 0) -> DataFrame:
    return pivot_matrix(heatmap, "day_of_week", "hour", range(24), "total_pedestrian_injuries",
                        prefix="h", fill=fill)


def borough_severity(by_vehicle: DataFrame) -> DataFrame:
    return roll_up(by_vehicle, ["borough", "crash_severity"], "crash_count", "crash_count")


def severity_matrix(by_vehicle: DataFrame) -> DataFrame:
    return pivot_matrix(borough_severity(by_vehicle), "borough", "crash_severity",
                        ["Fatal", "Non-Fatal"], "crash_count")


def year_ticks(months: DataFrame) -> DataFrame:
    """Where each year starts on an axis that numbers the months from 0."""
    placed = positions(months, ["year", "month"], "x_index")
    return placed.groupBy("year").agg(F.min("x_index").alias("x_index")).orderBy("year")


def injuries_by_year(months: DataFrame) -> DataFrame:
    return roll_up(months, ["year"], "total_cyclist_injuries",
                   "total_cyclist_injuries").orderBy("year")


def map_points(points: DataFrame) -> DataFrame:
    return points.withColumnsRenamed({"latitude": "lat", "longitude": "lon"})


def dashboard_pickers(rates: DataFrame, by_vehicle: DataFrame, months: DataFrame,
                      factors: DataFrame) -> DataFrame:
    """Choices of each dashboard picker as (picker, value)."""
    choices = {
        "borough_year": distinct_text(rates, borough_year_label()),
        "borough": distinct_text(by_vehicle, "borough"),
        "year": distinct_text(months, "year"),
        "contributing_factor": distinct_text(factors, "contributing_factor"),
    }
    return reduce(DataFrame.unionByName, [
        values.select(F.lit(picker).alias("picker"), "value")
        for picker, values in choices.items()
    ])
