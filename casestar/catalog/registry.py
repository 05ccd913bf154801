"""Registered queries: name -> (spark, sf_dir) -> DataFrame, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.catalog import fixture
from casestar.catalog.fixture import RULES
from casestar.config import COUNT_COLUMNS, RAW_TO_PUBLISHED, CleanRules, RawColumns
from casestar.operators import clean as C
from casestar.operators import quality as Q
from casestar.operators.dimensions import (
    PublishedDimension,
    build_dimension,
    published_dimension,
)
from casestar.operators.facts import build_fact, fact_base
from casestar.operators.ordering import order_violations
from casestar.operators.rollup import FOREIGN_KEYS, register_star_view, star_base
from casestar.operators.windows import highlight, pick, top_k
from casestar.plans import audit, etl, sql
from casestar.plans import questions as ask
from casestar.plans import report as show
from casestar.sources import landing, readers, writers

Query = Callable[[SparkSession, str], DataFrame]
CLEANING = CleanRules()
COORDINATES = etl.COORDINATES


def _published_names(spark: SparkSession, sf: str) -> DataFrame:
    return C.rename_raw(fixture.raw_zone(spark, sf), RawColumns().names)


def _raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    line = F.concat_ws("|", *RAW_TO_PUBLISHED.values())
    return _published_names(spark, sf).select(line.alias("value"))


def _unique(spark: SparkSession, sf: str) -> DataFrame:
    return etl.unique_records(fixture.raw_zone(spark, sf))


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    return etl.typed_coordinates(_unique(spark, sf))


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return etl.clean_records(fixture.raw_zone(spark, sf))


def _cleaned(*columns: str) -> Query:
    return lambda spark, sf: _clean(spark, sf).select("collision_id", *columns)


def _table(name: str) -> Query:
    return lambda spark, sf: fixture.warehouse(spark, sf).table(name)


def _question(plan, ruled: bool = False) -> Query:
    if ruled:
        return lambda spark, sf: plan(fixture.warehouse(spark, sf), RULES)
    return lambda spark, sf: plan(fixture.warehouse(spark, sf))


def _rounded(df: DataFrame, column: str) -> DataFrame:
    """Decimal or double to a double of six places, which both engines print alike."""
    return df.withColumn(column, F.round(F.col(column).cast("double"), 6))


def _rates(spark: SparkSession, sf: str) -> DataFrame:
    return ask.fatality_rates(fixture.warehouse(spark, sf), RULES)


def _heat(spark: SparkSession, sf: str) -> DataFrame:
    return ask.pedestrian_heatmap(fixture.warehouse(spark, sf))


def _months(spark: SparkSession, sf: str) -> DataFrame:
    return ask.cyclist_months(fixture.warehouse(spark, sf), RULES)


def _severity(spark: SparkSession, sf: str) -> DataFrame:
    return ask.severity_by_vehicle(fixture.warehouse(spark, sf))


def _factors(spark: SparkSession, sf: str) -> DataFrame:
    return ask.severe_crash_factors(fixture.warehouse(spark, sf), RULES)


# sources and sinks

def src_csv_all_string(spark: SparkSession, sf: str) -> DataFrame:
    path = fixture.scratch_path(spark, sf, "csv_zone")
    writers.write_raw_csv(fixture.raw_zone(spark, sf), path)
    return C.rename_raw(readers.read_standard_csv(spark, path), RawColumns().names)


def src_parquet_counts(spark: SparkSession, sf: str) -> DataFrame:
    return Q.table_counts({"raw": fixture.raw_zone(spark, sf)}
                          | fixture.warehouse(spark, sf).tables())


def sink_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fixture.scratch_path(spark, sf, "fact_flat")
    fact = fixture.warehouse(spark, sf).table("fact_crash").drop("partition_year", "partition_month")
    return writers.staged(fact, path)


def sink_partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fixture.scratch_path(spark, sf, "fact_partitioned")
    writers.write_partitioned(fixture.star(spark, sf).fact(etl.ALL_DIMENSIONS), path,
                              ["partition_year", "partition_month"])
    return readers.read_table(spark, path)


def partition_pruned_scan(spark: SparkSession, sf: str) -> DataFrame:
    return (fixture.warehouse(spark, sf).table("fact_crash")
            .filter((F.col("partition_year") == 1998) & F.col("partition_month").between(3, 5))
            .select("collision_id", "persons_injured", "partition_year", "partition_month"))


def sink_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fixture.scratch_path(spark, sf, "heat_csv")
    writers.write_result_csv(_heat(spark, sf), path)
    return readers.read_result_csv(spark, path, "q2_hour_day_heatmap")


def src_result_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A published result plus one that was never published, which reads as empty."""
    path = fixture.scratch_path(spark, sf, "months_csv")
    writers.write_result_csv(_months(spark, sf), path)
    result = "q4_cyclist_injury_trends_monthly"
    return readers.read_result_csv(spark, path, result).unionByName(
        readers.read_result_csv(spark, f"{path}-absent", result))


def land_raw_verify(spark: SparkSession, sf: str) -> DataFrame:
    source = fixture.scratch_path(spark, sf, "source_csv")
    zone = fixture.scratch_path(spark, sf, "landed_csv")
    writers.write_raw_csv(fixture.raw_zone(spark, sf), source)
    return landing.land_observed(spark, source, zone, "COLLISION_ID").report(spark)


def land_raw_quoted(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as quoted records with doubled quotes and commas, landed and read back."""
    source = fixture.scratch_path(spark, sf, "quoted_csv")
    zone = fixture.scratch_path(spark, sf, "landed_quoted")
    quoted = F.concat(F.translate("text", "\r\n", "  "), F.lit(' "end", '), "source")
    fixture.given(spark, sf, "documents").select("lang", quoted.alias("text"), "doc_id").write.option(
        "header", True).option("quoteAll", True).option("escape", '"').csv(source)
    landed = landing.land_observed(spark, source, zone, "doc_id")
    text = F.col("text")
    return readers.read_raw_csv(spark, zone, ["lang", "text", "doc_id"]).groupBy("lang").agg(
        F.count("*").alias("records"), F.sum(F.length(text)).alias("characters"),
        F.sum(F.length(text) - F.length(F.replace(text, F.lit('"')))).alias("quotes"),
        F.sum(F.col("doc_id").cast("long")).alias("ids"),
        F.lit(landed.is_complete).alias("is_complete"))


def topk_preview(spark: SparkSession, sf: str) -> DataFrame:
    peaks = ask.pedestrian_peak_hours(fixture.warehouse(spark, sf))
    return top_k(peaks, [F.desc("total_pedestrian_injuries"), "hour", "day_of_week",
                         "contributing_factor"], 15)


def sql_over_view(spark: SparkSession, sf: str) -> DataFrame:
    """SQL text over the registered star."""
    register_star_view(fixture.warehouse(spark, sf))
    return spark.sql("""
        SELECT is_weekend, property_damage_only, count(*) AS crashes,
               sum(persons_injured) AS injured
        FROM analytics_base
        WHERE on_street_name IS NOT NULL
        GROUP BY is_weekend, property_damage_only
    """)


def _sql_question(name: str, rounded: str | None = None) -> Query:
    def answer(spark: SparkSession, sf: str) -> DataFrame:
        found = sql.question_sql(fixture.warehouse(spark, sf), name, RULES)
        return _rounded(found, rounded) if rounded else found
    return answer


def sql_q1_rate_rank(spark: SparkSession, sf: str) -> DataFrame:
    rates = sql.question_sql(fixture.warehouse(spark, sf), "fatality_rates", RULES)
    return _rounded(rates, "fatality_rate").withColumnRenamed("fatality_rate", show.RATE)


def sql_pruned_by_date(spark: SparkSession, sf: str) -> DataFrame:
    """A range of days, a threshold and labels as arguments; folders are pruned by the days."""
    return sql.run_sql(fixture.warehouse(spark, sf), sql.SEVERITY_OF_DAYS,
                       first_day=date(1996, 11, 20), last_day=date(1997, 2, 10), fatal_from=1,
                       fatal="someone's death", not_fatal='no ":death"')


# quality

def dq_required_columns(spark: SparkSession, sf: str) -> DataFrame:
    return Q.required_columns(fixture.raw_zone(spark, sf),
                              [*RawColumns().required, "CROSS STREET NAME"])


def dq_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return Q.duplicate_keys(fixture.raw_zone(spark, sf), "COLLISION_ID")


def dq_file_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes per extension of a folder holding the raw lines as text and the order keys as CSV."""
    folder = fixture.scratch_path(spark, sf, "audited")
    _raw_lines(spark, sf).write.text(f"{folder}/lines")
    fixture.given(spark, sf, "lineitem").select("l_orderkey").write.csv(f"{folder}/keys")
    return (Q.file_audit(spark, folder).groupBy("extension", "is_accepted")
            .agg(F.sum("size_bytes").alias("total_bytes"))
            .withColumn("total_mb", F.col("total_bytes") / F.lit(1048576.0)))


def dq_encoding_audit(spark: SparkSession, sf: str) -> DataFrame:
    return Q.encoding_audit(fixture.given(spark, sf, "documents"), ["text", "lang", "source"])


def etl_step_audit(spark: SparkSession, sf: str) -> DataFrame:
    return Q.step_audit(_published_names(spark, sf), "collision_id", "crash_date",
                        CLEANING.date_format)


def dq_coordinate_audit(spark: SparkSession, sf: str) -> DataFrame:
    unique = etl.unique_coordinates(fixture.raw_zone(spark, sf))
    return Q.coordinate_audit(unique, *COORDINATES, CLEANING.latitude_range,
                              CLEANING.longitude_range)


def build_audit(spark: SparkSession, sf: str) -> DataFrame:
    """As the build observed it while it wrote; the raw table is not read again."""
    return fixture.warehouse(spark, sf).audit()


def build_audit_recounted(spark: SparkSession, sf: str) -> DataFrame:
    return audit.recounted_audit(fixture.raw_zone(spark, sf), fixture.warehouse(spark, sf))


def dq_flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return Q.count_flags(_clean(spark, sf), {
        "property_damage_only_rows": F.col("property_damage_only"),
        "injury_count_flagged_rows": F.col("injury_count_flagged"),
    })


def _integrity(spark: SparkSession, sf: str) -> DataFrame:
    return Q.fact_integrity(fixture.warehouse(spark, sf).table("fact_crash"),
                            fixture.star(spark, sf).clean, "collision_id", etl.FOREIGN_KEY_ORDER,
                            base_is_unique=True)


def fact_integrity_gate(spark: SparkSession, sf: str) -> DataFrame:
    return Q.gate_checks(_integrity(spark, sf), "collision_id", etl.FOREIGN_KEY_ORDER)


def partition_summary(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.warehouse(spark, sf).folders()


# cleaning

def clean_drop_blank_id(spark: SparkSession, sf: str) -> DataFrame:
    return (_published_names(spark, sf).transform(C.drop_blank_key, "collision_id")
            .select("collision_id", "crash_date", "crash_time"))


def clean_cast_coords(spark: SparkSession, sf: str) -> DataFrame:
    return _typed(spark, sf).select("collision_id", *COORDINATES)


def clean_zero_to_null(spark: SparkSession, sf: str) -> DataFrame:
    return _typed(spark, sf).transform(C.zero_to_null, COORDINATES).select(
        "collision_id", *COORDINATES)


def clean_bbox(spark: SparkSession, sf: str) -> DataFrame:
    return etl.valid_coordinates(_typed(spark, sf), CLEANING).select("collision_id", *COORDINATES)


def clean_join_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = {out: role for dim in etl.standard_dimensions(CLEANING).values()
            for out, role in dim.natural.items() if role[1] is not None}
    return _clean(spark, sf).transform(C.normalize_keys, keys).select("collision_id", *keys)


# star schema

def dim_surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    warehouse = fixture.warehouse(spark, sf)
    frames = [warehouse.table(name).agg(
        F.count(F.lit(1)).alias("row_count"), F.min(key).alias("first_key"),
        F.max(key).alias("last_key"), F.countDistinct(key).alias("distinct_keys"),
    ).select(F.lit(name).alias("table_name"), "*") for name, key in FOREIGN_KEYS.items()]
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def dim_location_rebuilt(spark: SparkSession, sf: str) -> DataFrame:
    """The locations of a first delivery, numbered, then of all records: old keys stay."""
    star = fixture.star(spark, sf)
    dim = star.dims["dim_location"]
    first = build_dimension(star.clean.where(F.col("partition_year") < 1997), dim,
                            fixture.scratch_path(spark, sf, "first_locations"))
    published = PublishedDimension(writers.staged(
        published_dimension(first.frame, dim), fixture.scratch_path(spark, sf, "locations")),
        first.payload_bytes)
    again = build_dimension(star.clean, dim, fixture.scratch_path(spark, sf, "all_locations"),
                            previous=published)
    return published_dimension(again.frame, dim)


def join_null_safe(spark: SparkSession, sf: str) -> DataFrame:
    star = fixture.star(spark, sf)
    location = {"dim_location": star.dims["dim_location"]}
    keyed = {"dim_location": fixture.null_safe_location(spark, sf)}
    base = fact_base(star.clean, location.values(), null_safe=True)
    return build_fact(base, location, keyed, null_safe=True,
                      columns=["collision_id", "location_key"])


# charts and report

def _labelled_rates(spark: SparkSession, sf: str) -> DataFrame:
    rates = _rounded(show.with_borough_year(_rates(spark, sf)), show.RATE)
    return rates.select("borough_year", show.RATE)


def report_insights(spark: SparkSession, sf: str) -> DataFrame:
    return show.insight_rows({
        "Q1 Interpretation": _rates(spark, sf),
        "Q2 Interpretation": ask.pedestrian_peak_hours(fixture.warehouse(spark, sf)),
        "Q3 Interpretation": _severity(spark, sf),
        "Q4 Interpretation": _months(spark, sf),
        "Q5 Interpretation": _factors(spark, sf),
    })


# the order in which a registered query promises its rows; a minus means descending
_PEAKS = ["-total_pedestrian_injuries", "hour", "day_of_week", "contributing_factor"]
ORDERS = {
    "agg_count_by_group": ["-total_crashes", "borough"],
    "q1_rate_rank": ["borough", "year"],
    "q2_peak_hours": _PEAKS,
    "q2_heatmap": ["day_of_week", "hour"],
    "q3_severity": ["-crash_count", "borough", "vehicle_type_1", "crash_severity"],
    "q4_monthly_lag": ["year", "month"],
    "q4_period_summary": ["period"],
    "q5_factor_rank": ["-crash_count", "contributing_factor", "time_of_day"],
    "partition_summary": ["partition_year", "partition_month"],
    "topk_preview": _PEAKS,
    "dash_top10_rates": [f"-{show.RATE}"],
    "dash_ped_by_hour": ["hour"],
    "dash_year_ticks": ["year"],
    "dash_cyclist_by_year": ["year"],
    "sql_pruned_by_date": ["borough", "severity"],
}
ORDERS |= {f"sql_{name}": order for name, order in ORDERS.items()
           if name.startswith(("agg_", "q"))}


def order_check(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the ordered questions, and how many of them are out of order: none."""
    asked = queries()
    found = [order_violations(asked[name](spark, sf), ORDERS[name])
             .select(F.lit(name).alias("query"), "*")
             for name in ORDERS if name.startswith("q")]
    return reduce(DataFrame.unionByName, found)


def queries() -> dict[str, Query]:
    return {
        "src_csv_all_string": src_csv_all_string,
        "src_parquet_counts": src_parquet_counts,
        "sink_parquet_roundtrip": sink_parquet_roundtrip,
        "sink_partitioned_roundtrip": sink_partitioned_roundtrip,
        "partition_pruned_scan": partition_pruned_scan,
        "sink_csv_roundtrip": sink_csv_roundtrip,
        "src_result_csv": src_result_csv,
        "land_raw_verify": land_raw_verify,
        "land_raw_quoted": land_raw_quoted,
        "star_base": lambda spark, sf: star_base(fixture.warehouse(spark, sf)),
        "sql_over_view": sql_over_view,
        "sql_pruned_by_date": sql_pruned_by_date,
        "sql_agg_count_by_group": _sql_question("crashes_by_borough"),
        "sql_q1_rate_rank": sql_q1_rate_rank,
        "sql_q2_peak_hours": _sql_question("pedestrian_peak_hours"),
        "sql_q2_heatmap": _sql_question("pedestrian_heatmap"),
        "sql_q3_severity": _sql_question("severity_by_vehicle"),
        "sql_q4_monthly_lag": _sql_question("cyclist_months"),
        "sql_q4_period_summary": _sql_question("cyclist_periods", "avg_row_cyclist_injuries"),
        "sql_q5_factor_rank": _sql_question("severe_crash_factors"),
        "sql_geo_points": lambda spark, sf: show.map_points(
            _sql_question("located_points")(spark, sf)),
        "topk_preview": topk_preview,
        "dq_required_columns": dq_required_columns,
        "dq_duplicate_keys": dq_duplicate_keys,
        "dq_file_audit": dq_file_audit,
        "dq_encoding_audit": dq_encoding_audit,
        "etl_step_audit": etl_step_audit,
        "dq_coordinate_audit": dq_coordinate_audit,
        "dq_flag_counts": dq_flag_counts,
        "build_audit": build_audit,
        "build_audit_recounted": build_audit_recounted,
        "fact_integrity": _integrity,
        "fact_integrity_gate": fact_integrity_gate,
        "partition_summary": partition_summary,
        "order_check": order_check,
        "clean_drop_blank_id": clean_drop_blank_id,
        "clean_dedup": _unique,
        "clean_cast_coords": clean_cast_coords,
        "clean_zero_to_null": clean_zero_to_null,
        "clean_bbox": clean_bbox,
        "clean_parse_date": _cleaned("crash_date"),
        "clean_cast_counts": _cleaned(*COUNT_COLUMNS),
        "clean_pdo_flag": _cleaned("property_damage_only"),
        "clean_outlier_flag": _cleaned("injury_count_flagged"),
        "clean_event_hour": _cleaned("crash_time", "hour"),
        "clean_join_keys": clean_join_keys,
        "dim_date": _table("dim_date"),
        "dim_location": _table("dim_location"),
        "dim_vehicle": _table("dim_vehicle"),
        "dim_factor": _table("dim_factor"),
        "dim_surrogate_keys": dim_surrogate_keys,
        "dim_location_rebuilt": dim_location_rebuilt,
        "fact_base": lambda spark, sf: fixture.cleaned(spark, sf).base(),
        "fact_build": lambda spark, sf: fixture.star(spark, sf).fact(),
        "fact_build_broadcast": lambda spark, sf: fixture.star(spark, sf).fact(etl.ALL_DIMENSIONS),
        "join_null_safe": join_null_safe,
        "agg_count_by_group": _question(ask.crashes_by_borough),
        "q1_rate_rank": lambda spark, sf: _rounded(_rates(spark, sf), show.RATE),
        "q2_peak_hours": _question(ask.pedestrian_peak_hours),
        "q2_heatmap": _heat,
        "q3_severity": _severity,
        "q3_borough_severity": lambda spark, sf: show.borough_severity(_severity(spark, sf)),
        "q4_monthly_lag": _months,
        "q4_period_summary": lambda spark, sf: _rounded(
            ask.cyclist_periods(fixture.warehouse(spark, sf), RULES), "avg_row_cyclist_injuries"),
        "q5_factor_rank": _factors,
        "geo_points": lambda spark, sf: show.map_points(
            ask.located_points(fixture.warehouse(spark, sf), RULES)),
        "pivot_heatmap": lambda spark, sf: show.heatmap_matrix(_heat(spark, sf)),
        "pivot_heatmap_unfilled": lambda spark, sf: show.heatmap_matrix(_heat(spark, sf), fill=None),
        "pivot_severity": lambda spark, sf: show.severity_matrix(_severity(spark, sf)),
        "dash_top10_rates": lambda spark, sf: _rounded(
            show.top_rates(_rates(spark, sf)), show.RATE),
        "dash_ped_by_hour": lambda spark, sf: show.injuries_by_hour(_heat(spark, sf)),
        "dash_year_ticks": lambda spark, sf: show.year_ticks(_months(spark, sf)),
        "dash_cyclist_by_year": lambda spark, sf: show.injuries_by_year(_months(spark, sf)),
        "dash_borough_year": _labelled_rates,
        "dash_highlight": lambda spark, sf: highlight(
            _labelled_rates(spark, sf), "borough_year", "ASIA-1997"),
        "dash_highlight_factor": lambda spark, sf: highlight(
            _factors(spark, sf), "contributing_factor", "1-URGENT"),
        "dash_highlight_year": lambda spark, sf: highlight(
            show.injuries_by_year(_months(spark, sf)), "year", 1998),
        "dash_filter_borough": lambda spark, sf: pick(_severity(spark, sf), "borough", "EUROPE"),
        "dash_picker_values": lambda spark, sf: show.dashboard_pickers(
            _rates(spark, sf), _severity(spark, sf), _months(spark, sf), _factors(spark, sf)),
        "report_insights": report_insights,
    }
