"""Every answer of a warehouse, written as small files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from casestar.config import QuestionRules
from casestar.plans import questions as ask
from casestar.plans.report import insight_rows
from casestar.schemas import result_schema
from casestar.sources.readers import read_result_csv
from casestar.sources.warehouse import Warehouse
from casestar.sources.writers import write_result_csv, write_text_report


# Results whose rows are bounded by the calendar or by the rules, so that one file suits them.
BOUNDED = frozenset(("partition_summary", "q2_hour_day_heatmap", "q4_cyclist_injury_trends_monthly",
                     "q4_pre_post_2019_summary"))


def answers(warehouse: Warehouse, rules: QuestionRules = QuestionRules()) -> dict[str, DataFrame]:
    """Result name to result."""
    return {
        "partition_summary": warehouse.folders(),
        "q1_borough_fatality_rates": ask.fatality_rates(warehouse, rules),
        "q2_peak_hours_pedestrian_injuries": ask.pedestrian_peak_hours(warehouse),
        "q2_hour_day_heatmap": ask.pedestrian_heatmap(warehouse),
        "q3_vehicle_fatal_nonfatal_by_borough": ask.severity_by_vehicle(warehouse),
        "q4_cyclist_injury_trends_monthly": ask.cyclist_months(warehouse, rules),
        "q4_pre_post_2019_summary": ask.cyclist_periods(warehouse, rules),
        "q5_multi_vehicle_3plus_injuries_factors": ask.severe_crash_factors(warehouse, rules),
        "bonus_geo_density_points": ask.located_points(warehouse, rules),
    }


def publish_answers(warehouse: Warehouse, folder: str, rules: QuestionRules = QuestionRules(),
                    commentary: Mapping[str, list[str]] | None = None) -> None:
    """Write each answer as CSV, then the report. The report reads the written answers, so
    no question runs twice."""
    for name, result in answers(warehouse, rules).items():
        write_result_csv(result, f"{folder}/csv/{name}", single_file=name in BOUNDED)

    def written(name: str) -> DataFrame:
        return read_result_csv(warehouse.spark, f"{folder}/csv/{name}",
                               result_schema(name, rules.rate_scale))

    report = insight_rows({
        "Q1 Interpretation": written("q1_borough_fatality_rates"),
        "Q2 Interpretation": written("q2_peak_hours_pedestrian_injuries"),
        "Q3 Interpretation": written("q3_vehicle_fatal_nonfatal_by_borough"),
        "Q4 Interpretation": written("q4_cyclist_injury_trends_monthly"),
        "Q5 Interpretation": written("q5_multi_vehicle_3plus_injuries_factors"),
    }, commentary, rate_scale=rules.rate_scale)
    write_text_report(report, f"{folder}/text/insights_summary", order=("section_no", "line_no"))
