"""SQL text over the star view, with its years, thresholds and labels as arguments.

Arguments are bound as values, never pasted into the text, so a label may hold any character.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame

from casestar.config import QuestionRules
from casestar.operators.rollup import register_star_view
from casestar.sources.warehouse import Warehouse

# The business questions as text an analyst can start from.
QUESTIONS = {
    "crashes_by_borough": """
        SELECT borough, count(*) AS total_crashes
        FROM analytics_base
        WHERE borough IS NOT NULL
        GROUP BY borough
        ORDER BY total_crashes DESC, borough""",
    "fatality_rates": """
        WITH rated AS (
          SELECT borough, year, count(*) AS total_crashes,
                 sum(persons_killed) AS total_fatalities,
                 sum(persons_killed) * :rate_scale / count(*) AS fatality_rate
          FROM analytics_base
          WHERE borough IS NOT NULL AND year BETWEEN :first_year AND :last_year
          GROUP BY borough, year)
        SELECT *, rank() OVER (PARTITION BY year ORDER BY fatality_rate DESC)
                  AS fatality_rank_within_year
        FROM rated
        ORDER BY borough, year""",
    "pedestrian_peak_hours": """
        SELECT hour, day_of_week, factor_1 AS contributing_factor,
               sum(pedestrians_injured) AS total_pedestrian_injuries
        FROM analytics_base
        WHERE hour IS NOT NULL AND day_of_week IS NOT NULL AND factor_1 IS NOT NULL
        GROUP BY hour, day_of_week, factor_1
        ORDER BY total_pedestrian_injuries DESC, hour, day_of_week, contributing_factor""",
    "pedestrian_heatmap": """
        SELECT day_of_week, hour, sum(pedestrians_injured) AS total_pedestrian_injuries
        FROM analytics_base
        WHERE hour IS NOT NULL AND day_of_week IS NOT NULL
        GROUP BY day_of_week, hour
        ORDER BY day_of_week, hour""",
    "severity_by_vehicle": """
        SELECT borough, vehicle_type_1,
               CASE WHEN persons_killed > 0 THEN :fatal ELSE :not_fatal END AS crash_severity,
               count(*) AS crash_count
        FROM analytics_base
        WHERE borough IS NOT NULL AND vehicle_type_1 IS NOT NULL
        GROUP BY ALL
        ORDER BY crash_count DESC, borough, vehicle_type_1, crash_severity""",
    "cyclist_months": """
        WITH months AS (
          SELECT year, month, sum(cyclists_injured) AS total_cyclist_injuries,
                 CASE WHEN year >= :split_year THEN :after ELSE :before END AS period
          FROM analytics_base
          WHERE year >= :first_year
          GROUP BY ALL),
        compared AS (
          SELECT *, lag(total_cyclist_injuries) OVER (ORDER BY year, month)
                    AS previous_month_injuries
          FROM months)
        SELECT *, total_cyclist_injuries - previous_month_injuries AS month_over_month_change,
               concat_ws('-', year, lpad(month, 2, '0')) AS year_month
        FROM compared
        ORDER BY year, month""",
    "cyclist_periods": """
        SELECT CASE WHEN year >= :split_year THEN :after ELSE :before END AS period,
               sum(cyclists_injured) AS total_cyclist_injuries,
               avg(cyclists_injured) AS avg_row_cyclist_injuries
        FROM analytics_base
        WHERE year >= :first_year
        GROUP BY ALL
        ORDER BY period""",
    "severe_crash_factors": """
        WITH counted AS (
          SELECT factor_1 AS contributing_factor,
                 CASE WHEN hour BETWEEN :start_1 AND :end_1 THEN :part_1
                      WHEN hour BETWEEN :start_2 AND :end_2 THEN :part_2
                      WHEN hour BETWEEN :start_3 AND :end_3 THEN :part_3
                      ELSE :rest END AS time_of_day,
                 count(*) AS crash_count
          FROM analytics_base
          WHERE persons_injured >= :injured_at_least AND vehicle_type_2 IS NOT NULL
            AND factor_1 IS NOT NULL AND hour IS NOT NULL
          GROUP BY ALL)
        SELECT *, row_number() OVER (PARTITION BY time_of_day
                                     ORDER BY crash_count DESC, contributing_factor)
                  AS factor_rank_within_time_of_day
        FROM counted
        ORDER BY crash_count DESC, contributing_factor, time_of_day""",
    "located_points": """
        SELECT latitude, longitude
        FROM analytics_base
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
}

# Crashes of a range of days by severity: the days are the date dimension's, and the folders of
# the fact that hold none of them are not read.
SEVERITY_OF_DAYS = """
    SELECT borough, CASE WHEN persons_killed >= :fatal_from THEN :fatal ELSE :not_fatal END
             AS severity, count(*) AS crashes, sum(persons_injured) AS injured
    FROM analytics_base
    WHERE crash_date BETWEEN :first_day AND :last_day AND borough IS NOT NULL
    GROUP BY ALL
    ORDER BY borough, severity"""


def run_sql(warehouse: Warehouse, text: str, **arguments) -> DataFrame:
    """SQL over ``analytics_base``, the star of this warehouse, with ``:name`` arguments."""
    register_star_view(warehouse)
    return warehouse.spark.sql(text, args=arguments)


def question_arguments(rules: QuestionRules = QuestionRules()) -> dict[str, dict[str, object]]:
    """The arguments with which each text of ``QUESTIONS`` follows ``rules``."""
    period = {"first_year": rules.trend_first_year, "split_year": rules.period_split_year,
              "after": f"Post-{rules.period_split_year}",
              "before": f"Pre-{rules.period_split_year}"}
    parts = {f"{key}_{at}": value for at, part in enumerate(rules.day_parts, start=1)
             for key, value in zip(("part", "start", "end"), part)}
    return {
        "fatality_rates": {"rate_scale": Decimal(f"{rules.rate_scale}.0"),
                           "first_year": rules.rate_years[0], "last_year": rules.rate_years[1]},
        "severity_by_vehicle": {"fatal": "Fatal", "not_fatal": "Non-Fatal"},
        "cyclist_months": period,
        "cyclist_periods": period,
        "severe_crash_factors": {"injured_at_least": rules.severe_injured_at_least,
                                 "rest": rules.night_label, **parts},
    }


def question_sql(warehouse: Warehouse, name: str, rules: QuestionRules = QuestionRules(),
                 **changes) -> DataFrame:
    """One of ``QUESTIONS`` with the arguments of ``rules``; ``changes`` replace some of them."""
    return run_sql(warehouse, QUESTIONS[name],
                   **question_arguments(rules).get(name, {}) | changes)
