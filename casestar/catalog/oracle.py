"""The same queries as plain SQL for an independent engine, one text per registered name.

Written from the rules, not from the DataFrame code: a window picks the survivor of a
duplicate id, row_number gives the keys, and every question runs on a full star join.
"""

from __future__ import annotations

from casestar.config import COUNT_COLUMNS, FACTOR_COLUMNS, RAW_TO_PUBLISHED, VEHICLE_COLUMNS

RAW_NAMES = list(RAW_TO_PUBLISHED.values())
OTHERS = ", ".join(f"{name} NULLS FIRST" for name in RAW_NAMES if name != "collision_id")

RAW = """
SELECT
 CASE WHEN l_partkey % 997 = 1 THEN NULL WHEN l_partkey % 991 = 2 THEN '  '
      ELSE CAST(l_orderkey*10 + l_linenumber AS STRING) END AS collision_id,
 CASE WHEN l_partkey % 499 = 3 THEN '2000-01-15'
      ELSE lpad(CAST(month(l_shipdate) AS STRING),2,'0') || '/' ||
           lpad(CAST(day(l_shipdate) AS STRING),2,'0') || '/' ||
           CAST(year(l_shipdate) AS STRING) END AS crash_date,
 CASE WHEN l_partkey % 101 = 4 THEN NULL
      ELSE CAST(l_partkey % 24 AS STRING) || ':' ||
           lpad(CAST(l_suppkey % 60 AS STRING),2,'0') END AS crash_time,
 CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE r_name END AS borough,
 CAST(c_nationkey AS STRING) AS zip_code,
 CASE WHEN l_suppkey % 11 = 0 THEN NULL
      WHEN l_suppkey % 5 = 0 THEN ' ' || s_name || ' ' ELSE s_name END AS on_street_name,
 CASE WHEN l_partkey % 17 = 0 THEN '0.0' WHEN l_partkey % 19 = 0 THEN '0'
      WHEN l_partkey % 223 = 6 THEN 'n/a'
      ELSE '40.' || lpad(CAST(30 + l_partkey % 70 AS STRING),2,'0') END AS latitude,
 CASE WHEN l_partkey % 17 = 0 THEN '0.0'
      ELSE '-73.' || lpad(CAST(60 + l_suppkey % 40 AS STRING),2,'0') END AS longitude,
 CASE WHEN l_partkey % 211 = 5 THEN NULL WHEN l_partkey % 227 = 3 THEN '3.0'
      WHEN l_linenumber <= 4 THEN '0'
      ELSE CAST(CAST(l_quantity AS INT) % 26 AS STRING) END AS persons_injured,
 CASE WHEN l_partkey % 50 = 7 THEN '1' ELSE '0' END AS persons_killed,
 CASE WHEN l_linenumber <= 4 THEN '0' ELSE CAST(l_suppkey % 3 AS STRING) END AS pedestrians_injured,
 '0' AS pedestrians_killed,
 CASE WHEN l_partkey % 223 = 6 THEN 'n/a' WHEN l_linenumber <= 4 THEN '0'
      ELSE CAST((l_partkey + l_suppkey) % 4 AS STRING) END AS cyclists_injured,
 '0' AS cyclists_killed, '0' AS motorists_injured, '0' AS motorists_killed,
 CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE p_type END AS vehicle_type_1,
 CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END AS vehicle_type_2,
 CAST(NULL AS STRING) AS vehicle_type_3, CAST(NULL AS STRING) AS vehicle_type_4,
 CAST(NULL AS STRING) AS vehicle_type_5,
 CASE WHEN l_suppkey % 7 = 0 THEN ' ' || o_orderpriority ELSE o_orderpriority END AS factor_1,
 CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE c_mktsegment END AS factor_2,
 CAST(NULL AS STRING) AS factor_3, CAST(NULL AS STRING) AS factor_4,
 CAST(NULL AS STRING) AS factor_5
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
 JOIN supplier ON l_suppkey = s_suppkey"""

KEYED = "SELECT * FROM raw WHERE collision_id IS NOT NULL AND trim(collision_id) <> ''"

UNIQUE = f"""
SELECT * FROM keyed
QUALIFY row_number() OVER (PARTITION BY collision_id ORDER BY {OTHERS}) = 1"""

TYPED = """
SELECT u.* REPLACE (
   TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude)
FROM uniq u"""

NONZERO = """
SELECT t.* REPLACE (nullif(latitude, 0.0e0) AS latitude, nullif(longitude, 0.0e0) AS longitude)
FROM typed t"""

BOXED = """
SELECT n.* REPLACE (
   CASE WHEN latitude BETWEEN 40.4e0 AND 40.9e0 THEN latitude END AS latitude,
   CASE WHEN longitude BETWEEN -74.3e0 AND -73.7e0 THEN longitude END AS longitude)
FROM nonzero n"""


def _count_text(name: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({name} AS DECIMAL(38,6))) AS INT) AS {name}"


DATED = f"""
SELECT b.* REPLACE (
   CAST(b.collision_id AS BIGINT) AS collision_id,
   CAST(try_strptime(b.crash_date, '%m/%d/%Y') AS DATE) AS crash_date,
   {", ".join(_count_text(name) for name in COUNT_COLUMNS)}),
   CAST(hour(try_strptime(concat_ws(' ', b.crash_date, coalesce(trim(b.crash_time), '00:00')),
                          '%m/%d/%Y %H:%M')) AS INTEGER) AS "hour"
FROM boxed b
WHERE try_strptime(b.crash_date, '%m/%d/%Y') IS NOT NULL"""

CLEAN = f"""
SELECT d.*,
   ({" AND ".join(f"{name} = 0" for name in COUNT_COLUMNS)}) AS property_damage_only,
   coalesce(persons_injured > 20, false) AS injury_count_flagged,
   CAST(year(crash_date) AS INTEGER) AS partition_year,
   CAST(month(crash_date) AS INTEGER) AS partition_month,
   coalesce(trim(crash_time), 'UNKNOWN_TIME') AS j_crash_time,
   coalesce(trim(borough), 'UNKNOWN_BOROUGH') AS j_borough,
   coalesce(trim(zip_code), 'UNKNOWN_ZIP') AS j_zip_code,
   coalesce(trim(on_street_name), 'UNKNOWN_STREET') AS j_on_street_name,
   coalesce(latitude, -9999.0e0) AS j_latitude,
   coalesce(longitude, -9999.0e0) AS j_longitude,
   {", ".join(f"coalesce(trim({name}), 'UNKNOWN_VEHICLE') AS j_{name}" for name in VEHICLE_COLUMNS)},
   {", ".join(f"coalesce(trim({name}), 'UNKNOWN_FACTOR') AS j_{name}" for name in FACTOR_COLUMNS)}
FROM dated d"""

J_LOCATION = "j_borough, j_zip_code, j_on_street_name, j_latitude, j_longitude"
J_VEHICLE = ", ".join(f"j_{name}" for name in VEHICLE_COLUMNS)
J_FACTOR = ", ".join(f"j_{name}" for name in FACTOR_COLUMNS)

D_DATE = """
SELECT row_number() OVER (ORDER BY crash_date, j_crash_time) AS date_key, crash_date, j_crash_time,
   min(crash_time) AS crash_time, min("hour") AS "hour",
   CAST(dayofweek(crash_date) + 1 AS INTEGER) AS day_of_week,
   CAST(month(crash_date) AS INTEGER) AS "month", CAST(year(crash_date) AS INTEGER) AS "year",
   dayofweek(crash_date) IN (0, 6) AS is_weekend
FROM clean GROUP BY crash_date, j_crash_time"""

LOCATION_VALUES = """min(borough) AS borough, min(zip_code) AS zip_code,
   min(on_street_name) AS on_street_name, min(latitude) AS latitude, min(longitude) AS longitude,
   false AS geo_imputed"""

FIRST_SEEN = f"""
SELECT *, partition_year < 1997 AS is_old,
   bool_or(partition_year < 1997) OVER (PARTITION BY {J_LOCATION}) AS known
FROM clean"""

D_LOCATION = f"""
SELECT row_number() OVER (ORDER BY {J_LOCATION}) AS location_key, {J_LOCATION},
   min(borough) AS borough, min(zip_code) AS zip_code, min(on_street_name) AS on_street_name,
   min(latitude) AS latitude, min(longitude) AS longitude, false AS geo_imputed
FROM clean GROUP BY {J_LOCATION}"""


def _text_dimension(key: str, columns) -> str:
    naturals = ", ".join(f"j_{name}" for name in columns)
    return (f"SELECT row_number() OVER (ORDER BY {naturals}) AS {key}, {naturals}, "
            + ", ".join(f"min({name}) AS {name}" for name in columns)
            + f" FROM clean GROUP BY {naturals}")


PUBLISHED_DATE = ('date_key, crash_date, crash_time, "hour", day_of_week, "month", "year", '
                  "is_weekend")
PUBLISHED_LOCATION = ("location_key, borough, zip_code, on_street_name, latitude, longitude, "
                      "geo_imputed")

FACT = f"""
SELECT collision_id, date_key, location_key, vehicle_key, factor_key, {", ".join(COUNT_COLUMNS)},
   property_damage_only, injury_count_flagged, partition_year, partition_month
FROM clean
 LEFT JOIN (SELECT date_key, crash_date, j_crash_time FROM d_date) USING (crash_date, j_crash_time)
 LEFT JOIN (SELECT location_key, {J_LOCATION} FROM d_location) USING ({J_LOCATION})
 LEFT JOIN (SELECT vehicle_key, {J_VEHICLE} FROM d_vehicle) USING ({J_VEHICLE})
 LEFT JOIN (SELECT factor_key, {J_FACTOR} FROM d_factor) USING ({J_FACTOR})"""

STAR = f"""
SELECT collision_id, {", ".join(COUNT_COLUMNS)}, property_damage_only, injury_count_flagged,
   d.crash_date, d.crash_time, d."hour", d.day_of_week, d."month", d."year", d.is_weekend,
   l.borough, l.zip_code, l.on_street_name, l.latitude, l.longitude,
   {", ".join(f"v.{name}" for name in VEHICLE_COLUMNS)},
   {", ".join(f"w.{name}" for name in FACTOR_COLUMNS)},
   partition_year, partition_month
FROM fact f LEFT JOIN d_date d ON f.date_key = d.date_key
 LEFT JOIN d_location l ON f.location_key = l.location_key
 LEFT JOIN d_vehicle v ON f.vehicle_key = v.vehicle_key
 LEFT JOIN d_factor w ON f.factor_key = w.factor_key"""

RATES = """
SELECT borough, "year", count(*) AS total_crashes,
   CAST(sum(persons_killed) AS BIGINT) AS total_fatalities,
   CAST(rank() OVER (PARTITION BY "year"
        ORDER BY CAST(sum(persons_killed) AS DOUBLE) / count(*) DESC) AS INTEGER)
        AS fatality_rank_within_year,
   round(sum(persons_killed) * 1000.0e0 / count(*), 6) AS fatality_rate_per_1000_crashes
FROM star WHERE borough IS NOT NULL AND "year" BETWEEN 1996 AND 2000 GROUP BY borough, "year\""""

PEAKS = """
SELECT "hour", day_of_week, factor_1 AS contributing_factor,
   CAST(sum(pedestrians_injured) AS BIGINT) AS total_pedestrian_injuries
FROM star WHERE "hour" IS NOT NULL AND factor_1 IS NOT NULL
GROUP BY "hour", day_of_week, factor_1"""

HEAT = """
SELECT day_of_week, "hour", CAST(sum(pedestrians_injured) AS BIGINT) AS total_pedestrian_injuries
FROM star WHERE "hour" IS NOT NULL GROUP BY day_of_week, "hour\""""

SEVERITY = """
SELECT borough, vehicle_type_1,
   CASE WHEN persons_killed > 0 THEN 'Fatal' ELSE 'Non-Fatal' END AS crash_severity,
   count(*) AS crash_count
FROM star WHERE borough IS NOT NULL AND vehicle_type_1 IS NOT NULL GROUP BY 1, 2, 3"""

MONTHS = """
SELECT "year", "month", total_cyclist_injuries,
   CASE WHEN "year" >= 1998 THEN 'Post-1998' ELSE 'Pre-1998' END AS period,
   lag(total_cyclist_injuries) OVER (ORDER BY "year", "month") AS previous_month_injuries,
   total_cyclist_injuries - lag(total_cyclist_injuries) OVER (ORDER BY "year", "month")
     AS month_over_month_change,
   CAST("year" AS VARCHAR) || '-' || lpad(CAST("month" AS VARCHAR), 2, '0') AS year_month
FROM (SELECT "year", "month", CAST(sum(cyclists_injured) AS BIGINT) AS total_cyclist_injuries
      FROM star WHERE "year" >= 1995 GROUP BY "year", "month")"""

FACTORS = """
SELECT contributing_factor, time_of_day, crash_count,
   CAST(row_number() OVER (PARTITION BY time_of_day ORDER BY crash_count DESC, contributing_factor)
        AS INTEGER) AS factor_rank_within_time_of_day
FROM (SELECT factor_1 AS contributing_factor,
         CASE WHEN "hour" BETWEEN 5 AND 11 THEN 'Morning' WHEN "hour" BETWEEN 12 AND 16 THEN 'Afternoon'
              WHEN "hour" BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END AS time_of_day,
         count(*) AS crash_count
      FROM star WHERE persons_injured >= 3 AND vehicle_type_2 IS NOT NULL
        AND factor_1 IS NOT NULL AND "hour" IS NOT NULL
      GROUP BY 1, 2)"""

INTEGRITY = """
SELECT count(*) AS fact_rows, (SELECT count(*) FROM clean) AS base_rows,
   count(*) - (SELECT count(*) FROM clean) AS row_inflation,
   count(*) - count(DISTINCT collision_id) AS duplicate_ids,
   count(*) - count(collision_id) AS null_collision_id, count(*) - count(date_key) AS null_date_key,
   count(*) - count(location_key) AS null_location_key,
   count(*) - count(vehicle_key) AS null_vehicle_key, count(*) - count(factor_key) AS null_factor_key
FROM fact"""

# every named step, with the steps it reads
STEPS = {
    "raw": (RAW, ()),
    "keyed": (KEYED, ("raw",)),
    "uniq": (UNIQUE, ("keyed",)),
    "typed": (TYPED, ("uniq",)),
    "nonzero": (NONZERO, ("typed",)),
    "boxed": (BOXED, ("nonzero",)),
    "dated": (DATED, ("boxed",)),
    "clean": (CLEAN, ("dated",)),
    "d_date": (D_DATE, ("clean",)),
    "d_location": (D_LOCATION, ("clean",)),
    "first_seen": (FIRST_SEEN, ("clean",)),
    "d_vehicle": (_text_dimension("vehicle_key", VEHICLE_COLUMNS), ("clean",)),
    "d_factor": (_text_dimension("factor_key", FACTOR_COLUMNS), ("clean",)),
    "fact": (FACT, ("clean", "d_date", "d_location", "d_vehicle", "d_factor")),
    "integrity": (INTEGRITY, ("fact",)),
    "nulls": ("SELECT collision_id, trim(borough) AS b, trim(zip_code) AS z, "
              "trim(on_street_name) AS s, latitude AS la, longitude AS lo FROM clean", ("clean",)),
    "star": (STAR, ("fact", "d_date", "d_location", "d_vehicle", "d_factor")),
    "rates": (RATES, ("star",)),
    "peaks": (PEAKS, ("star",)),
    "heat": (HEAT, ("star",)),
    "severity": (SEVERITY, ("star",)),
    "months": (MONTHS, ("star",)),
    "factors": (FACTORS, ("star",)),
}


def _with(select: str, *steps: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in STEPS[name][1]:
            visit(needed)
        if name not in order:
            order.append(name)

    for step in steps:
        visit(step)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({STEPS[name][0]})" for name in order)
    return f"WITH {ctes}\n{select}"


def _shape(name: str, columns: int) -> str:
    return (f"SELECT '{name}' AS table_name, count(*) AS row_count, "
            f"CAST({columns} AS INTEGER) AS column_count FROM ")


RAW_LINE = f"concat_ws('|', {', '.join(RAW_NAMES)})"
RAW_LINE_BYTES = f"CAST(sum(strlen({RAW_LINE}) + 1) AS BIGINT)"
RAW_TEXT_BYTES = f"CAST(sum({' + '.join(f'coalesce(strlen({name}), 0)' for name in RAW_NAMES)}) AS BIGINT)"
ORDER_KEY_BYTES = "CAST(sum(strlen(CAST(l_orderkey AS VARCHAR)) + 1) AS BIGINT)"

CHECKS = ("null_collision_id", "null_date_key", "null_location_key", "null_vehicle_key",
          "null_factor_key", "row_inflation", "duplicate_ids")
GATE = " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, {name} AS observed, {name} = 0 AS passed FROM integrity"
    for name in CHECKS)


def _required(name: str, column: str | None) -> str:
    if column is None:
        return (f"SELECT '{name}' AS column_name, false AS is_present, "
                "CAST(NULL AS BIGINT) AS filled_rows")
    return (f"SELECT '{name}' AS column_name, true AS is_present, "
            f"count(*) FILTER (trim({column}) <> '') AS filled_rows FROM raw")


def _encoding(column: str) -> str:
    ascii_rows = f"count(*) FILTER (strlen({column}) = length({column}))"
    return (f"SELECT '{column}' AS column_name, count({column}) AS text_values, "
            f"count({column}) AS valid_utf8_values, {ascii_rows} AS ascii_values, "
            f"CAST({ascii_rows} AS DOUBLE) / count({column}) AS ascii_share FROM documents")


def _step(label: str, before: str, after: str) -> str:
    return (f"SELECT '{label}' AS step, b AS rows_before, b - a AS rows_removed, a AS rows_after "
            f"FROM (SELECT (SELECT count(*) FROM {before}) AS b, (SELECT count(*) FROM {after}) AS a)")


def _counts(section: str, source: str, **items: str) -> list[str]:
    return [f"SELECT '{section}' AS section, '{item}' AS item, {count} AS observed FROM {source}"
            for item, count in items.items()]


INTEGRITY_COUNTS = _counts("integrity", "integrity", **{name: name for name in (
    "fact_rows", "base_rows", *CHECKS)})


def _step_counts(label: str, before: str, after: str) -> list[str]:
    b, a = (f"(SELECT count(*) FROM {name})" for name in (before, after))
    return _counts(label, "(SELECT 1)", rows_before=b, rows_removed=f"{b} - {a}", rows_after=a)


def _key_summary(dim: str, key: str, step: str) -> str:
    return (f"SELECT '{dim}' AS table_name, count(*) AS row_count, min({key}) AS first_key, "
            f"max({key}) AS last_key, count(DISTINCT {key}) AS distinct_keys FROM {step}")


def _sentences(number: int, title: str, source: str, order: str, *lines: str) -> str:
    texts = [f"'{title}'", *lines, "''"]
    picked = f"(SELECT * FROM {source} ORDER BY {order} LIMIT 1)" if source else "(SELECT 1)"
    return " UNION ALL ".join(
        f"SELECT CAST({number} AS INTEGER) AS section_no, CAST({at} AS INTEGER) AS line_no, "
        f"{text} AS line FROM {picked}" for at, text in enumerate(texts, start=1))


# The sentence formats of the published insight report.
REPORT = " UNION ALL ".join([
    _sentences(
        1, "Q1 Interpretation", "rates", "fatality_rate_per_1000_crashes DESC, borough, \"year\"",
        "printf('- The highest borough-year fatality rate was %s in %d, with %.2f fatalities per "
        "1000 crashes.', borough, \"year\", fatality_rate_per_1000_crashes)"),
    _sentences(
        2, "Q2 Interpretation", "peaks",
        "total_pedestrian_injuries DESC, \"hour\", day_of_week, contributing_factor",
        "printf('- The peak pedestrian injury combination was hour %d, day_of_week %d, with factor "
        "''%s''.', \"hour\", day_of_week, contributing_factor)",
        "printf('- This combination recorded %d pedestrian injuries.', total_pedestrian_injuries)"),
    _sentences(
        3, "Q3 Interpretation", "severity",
        "crash_count DESC, borough, vehicle_type_1, crash_severity",
        "printf('- The most frequent borough/vehicle/severity combination was %s with vehicle type "
        "''%s'' and severity ''%s''.', borough, vehicle_type_1, crash_severity)",
        "printf('- This group recorded %d crashes.', crash_count)"),
    _sentences(4, "Q4 Interpretation", "", ""),
    _sentences(
        5, "Q5 Interpretation", "factors", "crash_count DESC, contributing_factor, time_of_day",
        "printf('- The top factor in multi-vehicle crashes with 3+ injuries was ''%s'' during "
        "''%s''.', contributing_factor, time_of_day)",
        "printf('- This group recorded %d crashes.', crash_count)"),
])

LABELLED = "(SELECT borough || '-' || CAST(\"year\" AS VARCHAR) AS borough_year, * FROM rates)"


def _cells(fill: bool) -> str:
    cell = 'CAST(sum(total_pedestrian_injuries) FILTER ("hour" = {h}) AS BIGINT)'
    shown = f"coalesce({cell}, 0)" if fill else cell
    return ", ".join(f"{shown.format(h=h)} AS h{h}" for h in range(24))


# the same answers from SQL text over the view
SAME_AS = {f"sql_{name}": name for name in (
    "agg_count_by_group", "q1_rate_rank", "q2_peak_hours", "q2_heatmap", "q3_severity",
    "q4_monthly_lag", "q4_period_summary", "q5_factor_rank", "geo_points")}


def oracle_sql() -> dict[str, str]:
    found = _oracle_sql()
    return found | {name: found[other] for name, other in SAME_AS.items()}


def _oracle_sql() -> dict[str, str]:
    raw_row = ", ".join(RAW_NAMES)
    fact_measures = ", ".join(COUNT_COLUMNS)
    return {
        # sources and sinks
        "src_csv_all_string": _with(f"SELECT {raw_row} FROM raw", "raw"),
        "src_parquet_counts": _with(" UNION ALL ".join([
            _shape("raw", 26) + "raw", _shape("fact_crash", 17) + "fact",
            _shape("dim_date", 8) + "d_date", _shape("dim_location", 7) + "d_location",
            _shape("dim_vehicle", 6) + "d_vehicle", _shape("dim_factor", 6) + "d_factor",
        ]), "fact"),
        "sink_parquet_roundtrip": _with(
            "SELECT * EXCLUDE (partition_year, partition_month) FROM fact", "fact"),
        "sink_partitioned_roundtrip": _with("SELECT * FROM fact", "fact"),
        "partition_pruned_scan": _with(
            "SELECT collision_id, persons_injured, partition_year, partition_month FROM fact "
            "WHERE partition_year = 1998 AND partition_month BETWEEN 3 AND 5", "fact"),
        "sink_csv_roundtrip": _with("SELECT * FROM heat", "heat"),
        "src_result_csv": _with("SELECT * FROM months", "months"),
        "land_raw_verify": _with(
            f"SELECT count(*) AS source_rows, {RAW_TEXT_BYTES} AS source_bytes, "
            f"count(*) AS landed_rows, {RAW_TEXT_BYTES} AS landed_bytes, true AS is_complete "
            "FROM raw", "raw"),
        "land_raw_quoted": """
SELECT lang, count(*) AS records, CAST(sum(length(t)) AS BIGINT) AS characters,
 CAST(sum(length(t) - length(replace(t, '"', ''))) AS BIGINT) AS quotes,
 CAST(sum(doc_id) AS BIGINT) AS ids, true AS is_complete
FROM (SELECT lang, doc_id, text || ' "end", ' || source AS t FROM documents) GROUP BY lang""",
        "star_base": _with("SELECT * FROM star", "star"),
        "sql_over_view": _with(
            "SELECT is_weekend, property_damage_only, count(*) AS crashes, "
            "CAST(sum(persons_injured) AS BIGINT) AS injured FROM star "
            "WHERE on_street_name IS NOT NULL GROUP BY 1, 2", "star"),
        "sql_pruned_by_date": _with(
            "SELECT borough, CASE WHEN persons_killed >= 1 THEN 'someone''s death' "
            "ELSE 'no \":death\"' END AS severity, count(*) AS crashes, "
            "CAST(sum(persons_injured) AS BIGINT) AS injured FROM star WHERE borough IS NOT NULL "
            "AND crash_date BETWEEN DATE '1996-11-20' AND DATE '1997-02-10' GROUP BY 1, 2", "star"),
        "topk_preview": _with(
            'SELECT * FROM peaks ORDER BY total_pedestrian_injuries DESC, "hour", day_of_week, '
            "contributing_factor LIMIT 15", "peaks"),
        # quality
        "dq_required_columns": _with(" UNION ALL ".join([
            _required("COLLISION_ID", "collision_id"), _required("CRASH DATE", "crash_date"),
            _required("BOROUGH", "borough"), _required("ZIP CODE", "zip_code"),
            _required("LATITUDE", "latitude"), _required("LONGITUDE", "longitude"),
            _required("CROSS STREET NAME", None),
        ]), "raw"),
        "dq_duplicate_keys": _with(
            "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, "
            "count(*) FILTER (n > 1) AS keys_with_duplicates "
            "FROM (SELECT collision_id, count(*) AS n FROM raw GROUP BY collision_id)", "raw"),
        "dq_file_audit": _with(
            f"SELECT '.txt' AS extension, false AS is_accepted, {RAW_LINE_BYTES} AS total_bytes, "
            f"{RAW_LINE_BYTES} / 1048576.0e0 AS total_mb FROM raw UNION ALL "
            f"SELECT '.csv', true, {ORDER_KEY_BYTES}, {ORDER_KEY_BYTES} / 1048576.0e0 FROM lineitem",
            "raw"),
        "dq_encoding_audit": " UNION ALL ".join(
            _encoding(name) for name in ("text", "lang", "source")),
        "etl_step_audit": _with(" UNION ALL ".join([
            _step("1 missing key", "raw", "keyed"), _step("2 duplicate key", "keyed", "uniq"),
            _step("3 invalid date", "uniq", "dated"),
        ]), "dated"),
        "dq_coordinate_audit": _with(
            "SELECT count(*) FILTER (latitude = 0 AND longitude = 0) AS both_zero_rows, "
            "count(*) FILTER (latitude <> 0 AND (latitude < 40.4e0 OR latitude > 40.9e0)) "
            "AS latitude_out_of_range_rows, "
            "count(*) FILTER (longitude <> 0 AND (longitude < -74.3e0 OR longitude > -73.7e0)) "
            "AS longitude_out_of_range_rows FROM typed", "typed"),
        "build_audit": _with(" UNION ALL ".join([
            *_step_counts("1 missing key", "raw", "keyed"),
            *_step_counts("2 duplicate key", "keyed", "uniq"),
            *_step_counts("3 invalid date", "uniq", "dated"),
            *_counts(
                "coordinates", "typed",
                both_zero_rows="count(*) FILTER (latitude = 0 AND longitude = 0)",
                latitude_out_of_range_rows="count(*) FILTER (latitude <> 0 "
                "AND (latitude < 40.4e0 OR latitude > 40.9e0))",
                longitude_out_of_range_rows="count(*) FILTER (longitude <> 0 "
                "AND (longitude < -74.3e0 OR longitude > -73.7e0))"),
            *_counts("flags", "clean",
                     property_damage_only_rows="count(*) FILTER (property_damage_only)",
                     injury_count_flagged_rows="count(*) FILTER (injury_count_flagged)"),
            *INTEGRITY_COUNTS,
            *_counts("fact_crash", "fact", row_count="count(*)"),
            *_counts("dim_date", "d_date", row_count="count(*)"),
            *_counts("dim_location", "d_location", row_count="count(*)"),
            *_counts("dim_vehicle", "d_vehicle", row_count="count(*)"),
            *_counts("dim_factor", "d_factor", row_count="count(*)"),
        ]), "integrity", "typed", "dated"),
        "build_audit_recounted": _with(" UNION ALL ".join([
            *_step_counts("1 missing key", "raw", "keyed"),
            *_step_counts("2 duplicate key", "keyed", "uniq"),
            *_step_counts("3 invalid date", "uniq", "dated"),
            *_counts(
                "coordinates", "typed",
                both_zero_rows="count(*) FILTER (latitude = 0 AND longitude = 0)",
                latitude_out_of_range_rows="count(*) FILTER (latitude <> 0 "
                "AND (latitude < 40.4e0 OR latitude > 40.9e0))",
                longitude_out_of_range_rows="count(*) FILTER (longitude <> 0 "
                "AND (longitude < -74.3e0 OR longitude > -73.7e0))"),
            *_counts("flags", "clean",
                     property_damage_only_rows="count(*) FILTER (property_damage_only)",
                     injury_count_flagged_rows="count(*) FILTER (injury_count_flagged)"),
            *_counts("fact_crash", "fact", row_count="count(*)"),
            *_counts("dim_date", "d_date", row_count="count(*)"),
            *_counts("dim_location", "d_location", row_count="count(*)"),
            *_counts("dim_vehicle", "d_vehicle", row_count="count(*)"),
            *_counts("dim_factor", "d_factor", row_count="count(*)"),
        ]), "fact", "typed", "dated"),
        "dq_flag_counts": _with(
            "SELECT count(*) FILTER (property_damage_only) AS property_damage_only_rows, "
            "count(*) FILTER (injury_count_flagged) AS injury_count_flagged_rows FROM clean", "clean"),
        "fact_integrity": _with("SELECT * FROM integrity", "integrity"),
        "fact_integrity_gate": _with(GATE, "integrity"),
        "partition_summary": _with(
            "SELECT DISTINCT partition_year, partition_month FROM fact", "fact"),
        "dim_location_rebuilt": _with(f"""
SELECT row_number() OVER (ORDER BY {J_LOCATION}) AS location_key, {LOCATION_VALUES}
FROM first_seen WHERE is_old GROUP BY {J_LOCATION}
UNION ALL
SELECT row_number() OVER (ORDER BY {J_LOCATION}) + (
  SELECT count(DISTINCT ({J_LOCATION})) FROM first_seen WHERE is_old), {LOCATION_VALUES}
FROM first_seen WHERE NOT known GROUP BY {J_LOCATION}""", "first_seen"),
        "order_check": _with(" UNION ALL ".join(
            f"SELECT '{name}' AS query, count(*) AS row_count, CAST(0 AS BIGINT) AS violations "
            f"FROM {source}" for name, source in (
                ("q1_rate_rank", "rates"), ("q2_peak_hours", "peaks"), ("q2_heatmap", "heat"),
                ("q3_severity", "severity"), ("q4_monthly_lag", "months"),
                ("q4_period_summary", "(SELECT DISTINCT period FROM months)"),
                ("q5_factor_rank", "factors"))),
            "rates", "peaks", "heat", "severity", "months", "factors"),
        # cleaning
        "clean_drop_blank_id": _with("SELECT collision_id, crash_date, crash_time FROM keyed", "keyed"),
        "clean_dedup": _with(f"SELECT {raw_row} FROM uniq", "uniq"),
        "clean_cast_coords": _with("SELECT collision_id, latitude, longitude FROM typed", "typed"),
        "clean_zero_to_null": _with("SELECT collision_id, latitude, longitude FROM nonzero", "nonzero"),
        "clean_bbox": _with("SELECT collision_id, latitude, longitude FROM boxed", "boxed"),
        "clean_parse_date": _with("SELECT collision_id, crash_date FROM dated", "dated"),
        "clean_cast_counts": _with(f"SELECT collision_id, {fact_measures} FROM dated", "dated"),
        "clean_pdo_flag": _with("SELECT collision_id, property_damage_only FROM clean", "clean"),
        "clean_outlier_flag": _with("SELECT collision_id, injury_count_flagged FROM clean", "clean"),
        "clean_event_hour": _with('SELECT collision_id, crash_time, "hour" FROM dated', "dated"),
        "clean_join_keys": _with(
            f"SELECT collision_id, j_crash_time, {J_LOCATION}, {J_VEHICLE}, {J_FACTOR} FROM clean",
            "clean"),
        # star schema
        "dim_date": _with(f"SELECT {PUBLISHED_DATE} FROM d_date", "d_date"),
        "dim_location": _with(f"SELECT {PUBLISHED_LOCATION} FROM d_location", "d_location"),
        "dim_vehicle": _with(f"SELECT vehicle_key, {', '.join(VEHICLE_COLUMNS)} FROM d_vehicle",
                             "d_vehicle"),
        "dim_factor": _with(f"SELECT factor_key, {', '.join(FACTOR_COLUMNS)} FROM d_factor",
                            "d_factor"),
        "dim_surrogate_keys": _with(" UNION ALL ".join([
            _key_summary("dim_date", "date_key", "d_date"),
            _key_summary("dim_location", "location_key", "d_location"),
            _key_summary("dim_vehicle", "vehicle_key", "d_vehicle"),
            _key_summary("dim_factor", "factor_key", "d_factor"),
        ]), "d_date", "d_location", "d_vehicle", "d_factor"),
        "fact_base": _with(
            f"SELECT collision_id, crash_date, j_crash_time, {J_LOCATION}, {J_VEHICLE}, {J_FACTOR}, "
            f"{fact_measures}, property_damage_only, injury_count_flagged, partition_year, "
            "partition_month FROM clean", "clean"),
        "fact_build": _with("SELECT * FROM fact", "fact"),
        "fact_build_broadcast": _with("SELECT * FROM fact", "fact"),
        "join_null_safe": _with(
            "SELECT collision_id, location_key FROM nulls JOIN (SELECT *, row_number() OVER (ORDER BY "
            "b NULLS FIRST, z NULLS FIRST, s NULLS FIRST, la NULLS FIRST, lo NULLS FIRST) "
            "AS location_key FROM (SELECT DISTINCT b, z, s, la, lo FROM nulls)) k "
            "ON nulls.b IS NOT DISTINCT FROM k.b AND nulls.z IS NOT DISTINCT FROM k.z "
            "AND nulls.s IS NOT DISTINCT FROM k.s AND nulls.la IS NOT DISTINCT FROM k.la "
            "AND nulls.lo IS NOT DISTINCT FROM k.lo", "nulls"),
        # questions
        "agg_count_by_group": _with(
            "SELECT borough, count(*) AS total_crashes FROM star WHERE borough IS NOT NULL "
            "GROUP BY borough", "star"),
        "q1_rate_rank": _with("SELECT * FROM rates", "rates"),
        "q2_peak_hours": _with("SELECT * FROM peaks", "peaks"),
        "q2_heatmap": _with("SELECT * FROM heat", "heat"),
        "q3_severity": _with("SELECT * FROM severity", "severity"),
        "q3_borough_severity": _with(
            "SELECT borough, crash_severity, CAST(sum(crash_count) AS BIGINT) AS crash_count "
            "FROM severity GROUP BY 1, 2", "severity"),
        "q4_monthly_lag": _with("SELECT * FROM months", "months"),
        "q4_period_summary": _with(
            "SELECT CASE WHEN \"year\" >= 1998 THEN 'Post-1998' ELSE 'Pre-1998' END AS period, "
            "CAST(sum(cyclists_injured) AS BIGINT) AS total_cyclist_injuries, "
            "round(CAST(sum(cyclists_injured) AS DOUBLE) / count(cyclists_injured), 6) "
            "AS avg_row_cyclist_injuries FROM star WHERE \"year\" >= 1995 GROUP BY 1", "star"),
        "q5_factor_rank": _with("SELECT * FROM factors", "factors"),
        "geo_points": _with(
            "SELECT latitude AS lat, longitude AS lon FROM star WHERE latitude IS NOT NULL "
            "AND longitude IS NOT NULL", "star"),
        # charts and report
        "pivot_heatmap": _with(
            f"SELECT day_of_week, {_cells(True)} FROM heat GROUP BY day_of_week", "heat"),
        "pivot_heatmap_unfilled": _with(
            f"SELECT day_of_week, {_cells(False)} FROM heat GROUP BY day_of_week", "heat"),
        "pivot_severity": _with(
            "SELECT borough, "
            "CAST(coalesce(sum(crash_count) FILTER (crash_severity = 'Fatal'), 0) AS BIGINT) "
            'AS "Fatal", '
            "CAST(coalesce(sum(crash_count) FILTER (crash_severity = 'Non-Fatal'), 0) AS BIGINT) "
            'AS "Non-Fatal" FROM severity GROUP BY borough', "severity"),
        "dash_top10_rates": _with(
            f"SELECT borough_year, fatality_rate_per_1000_crashes FROM {LABELLED} "
            'ORDER BY fatality_rate_per_1000_crashes DESC, borough, "year" LIMIT 10', "rates"),
        "dash_ped_by_hour": _with(
            'SELECT "hour", CAST(sum(total_pedestrian_injuries) AS BIGINT) '
            'AS total_pedestrian_injuries FROM heat GROUP BY "hour"', "heat"),
        "dash_year_ticks": _with(
            'SELECT "year", CAST(min(place) AS INTEGER) AS x_index FROM (SELECT "year", row_number() '
            'OVER (ORDER BY "year", "month") - 1 AS place FROM months) GROUP BY "year"', "months"),
        "dash_cyclist_by_year": _with(
            'SELECT "year", CAST(sum(total_cyclist_injuries) AS BIGINT) AS total_cyclist_injuries '
            'FROM months GROUP BY "year"', "months"),
        "dash_borough_year": _with(
            f"SELECT borough_year, fatality_rate_per_1000_crashes FROM {LABELLED}", "rates"),
        "dash_highlight": _with(
            "SELECT borough_year, fatality_rate_per_1000_crashes, borough_year = 'ASIA-1997' "
            f"AS is_highlighted FROM {LABELLED}", "rates"),
        "dash_highlight_factor": _with(
            "SELECT *, contributing_factor = '1-URGENT' AS is_highlighted FROM factors", "factors"),
        "dash_highlight_year": _with(
            'SELECT "year", CAST(sum(total_cyclist_injuries) AS BIGINT) AS total_cyclist_injuries, '
            '"year" = 1998 AS is_highlighted FROM months GROUP BY "year"', "months"),
        "dash_filter_borough": _with("SELECT * FROM severity WHERE borough = 'EUROPE'", "severity"),
        "dash_picker_values": _with(
            f"SELECT DISTINCT 'borough_year' AS picker, borough_year AS value FROM {LABELLED} "
            "UNION ALL SELECT DISTINCT 'borough', borough FROM severity "
            "UNION ALL SELECT DISTINCT 'year', CAST(\"year\" AS VARCHAR) FROM months "
            "UNION ALL SELECT DISTINCT 'contributing_factor', contributing_factor FROM factors",
            "rates", "severity", "months", "factors"),
        "report_insights": _with(f"SELECT section_no, line_no, line FROM ({REPORT})",
                                 "rates", "peaks", "severity", "factors"),
    }
