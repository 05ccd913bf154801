from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F
from samples import raw_frame

from casestar.config import COUNT_COLUMNS, RawColumns
from casestar.functions import day_part, lenient_int, lenient_long, rate_per, severity
from casestar.operators import clean as C
from casestar.operators import quality as Q
from casestar.config import QuestionRules
from casestar.plans.etl import clean_records


def column(df, name, by="collision_id"):
    return [row[name] for row in df.orderBy(by).collect()]


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "at int, x string")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_counts_are_cast_leniently(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    cases = {"n/a": None, "3.0": 3, " 3 ": 3, "": None, "1.7": 1, "-1.9": -1, "3.9999999": 3,
             ".5": 0, "+4": 4, "1e3": None, "2147483648": None, "1.2.3": None, None: None}
    df = texts(spark, *cases)
    assert column(df.select("at", lenient_int(F.col("x")).alias("n")), "n", "at") == list(cases.values())
    big = texts(spark, "9223372036854775807", "9223372036854775808", "12.0")
    assert column(big.select("at", lenient_long(F.col("x")).alias("n")), "n", "at") == [
        9223372036854775807, None, 12]


def test_rows_without_a_key_are_dropped(spark):
    raw = raw_frame(spark, {"collision_id": None}, {"collision_id": ""}, {"collision_id": "  "},
                    {"collision_id": "7"})
    assert column(clean_records(raw), "collision_id") == [7]


def test_smallest_duplicate_survives_whatever_the_partitioning(spark):
    records = [{"collision_id": "7", "borough": b, "zip_code": z}
               for b, z in (("QUEENS", "2"), (None, "9"), ("BRONX", None), (None, "1"))]
    for parts in (1, 5):
        kept = clean_records(raw_frame(spark, *records).repartition(parts)).collect()
        assert [(r.borough, r.zip_code) for r in kept] == [(None, "1")]


def test_dedup_forms_agree_and_a_given_order_comes_first(spark):
    rows = [(k, v, w) for k in ("a", "b", None) for v, w in ((3, "x"), (1, "y"), (1, None), (2, "z"))]
    df = spark.createDataFrame(rows, "k string, v int, w string")
    one = {tuple(r) for r in C.dedup_by_key(df, "k").collect()}
    assert one == {("a", 1, None), ("b", 1, None), (None, 1, None)}
    counted = C.first_with_copies(df, "k", "n").collect()
    assert {(r.k, r.v, r.w) for r in counted} == one and {r.n for r in counted} == {4}
    by_text = {tuple(r) for r in C.dedup_by_key(df.na.fill("q"), "k", ["w"]).collect()}
    assert by_text == {("a", 1, "q"), ("b", 1, "q"), ("q", 1, "q")}
    assert C.dedup_any(df, "k").count() == 3


def test_coordinates(spark):
    lats = ["0", "40.4", "40.9", "40.39", "40.91", "n/a", None, "0.0"]
    raw = raw_frame(spark, *[{"latitude": x} for x in lats])
    cleaned = clean_records(raw)
    assert column(cleaned, "latitude") == [None, 40.4, 40.9, None, None, None, None, None]
    assert column(cleaned, "longitude") == [-73.9] * 8
    typed = C.lenient_cast(raw_frame(spark, *[{"latitude": a, "longitude": b} for a, b in (
        ("0", "-73.9"), ("0", "0.0"), ("50", "-73.9"), (None, "0"), ("40.5", "-80"))])
        .transform(C.rename_raw, RawColumns().names), {"latitude": "double", "longitude": "double"})
    audit = Q.coordinate_audit(typed, "latitude", "longitude", (40.4, 40.9), (-74.3, -73.7)).first()
    assert tuple(audit) == (1, 1, 1)


def test_invalid_dates_drop_the_row(spark):
    raw = raw_frame(spark, *[{"crash_date": x} for x in (
        "02/30/2020", "2020-01-15", "1/2/2020", None, "02/29/2020")])
    assert column(clean_records(raw), "crash_date") == [datetime.date(2020, 2, 29)]


def test_bad_time_keeps_the_row_and_missing_time_is_midnight(spark):
    raw = raw_frame(spark, *[{"crash_time": x} for x in (None, "25:07", "5:07", "05:07", " ", "23:59")])
    cleaned = clean_records(raw)
    assert column(cleaned, "hour") == [0, None, 5, 5, None, 23]
    assert column(cleaned, "crash_time") == [None, "25:07", "5:07", "05:07", " ", "23:59"]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "UTC"])
def test_hour_does_not_depend_on_the_session_time_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    raw = raw_frame(spark, {"crash_date": "03/08/2020", "crash_time": "2:30"},
                    {"crash_date": "12/31/1969", "crash_time": "23:15"})
    assert column(clean_records(raw), "hour") == [2, 23]


def test_property_damage_flag_is_three_valued(spark):
    raw = raw_frame(spark, {"persons_injured": None}, {"persons_injured": None, "cyclists_killed": "1"},
                    {}, {"motorists_killed": "2"})
    assert column(clean_records(raw), "property_damage_only") == [None, False, True, False]
    assert len(COUNT_COLUMNS) == 8


def test_outlier_flag_is_strict(spark):
    raw = raw_frame(spark, *[{"persons_injured": x} for x in ("20", "21", None)])
    assert column(clean_records(raw), "injury_count_flagged") == [False, True, False]


def test_severity_and_day_parts(spark):
    df = spark.createDataFrame([(i, k) for i, k in enumerate((None, 0, 1))], "at int, k int")
    assert column(df.select("at", severity(F.col("k")).alias("s")), "s", "at") == [
        "Non-Fatal", "Non-Fatal", "Fatal"]
    hours = spark.createDataFrame([(h,) for h in (4, 5, 11, 12, 16, 17, 20, 21)], "h int")
    rules = QuestionRules()
    part = day_part(F.col("h"), rules.day_parts, rules.night_label)
    assert column(hours.select("h", part.alias("p")), "p", "h") == [
        "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night"]


# published results: crashes, deaths, deaths per 1000 crashes
@pytest.mark.parametrize("total, part, rate", [
    (9511, 17, "1.7874040584586"), (19768, 32, "1.6187778227438"),
    (19688, 19, "0.9650548557497"), (21258, 26, "1.2230689622730"), (0, 0, "0E-13"),
])
def test_rate_has_thirteen_exact_digits(spark, total, part, rate):
    df = spark.createDataFrame([(total, part)], "total long, part long")
    found = df.select(rate_per(F.col("part"), F.col("total"), 1000).alias("r"))
    assert found.schema["r"].dataType.simpleString() == "decimal(38,13)"
    assert str(found.first().r) == rate


def test_duplicates_count_null_as_a_value(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), (None,)], "k string")
    assert tuple(Q.duplicate_keys(df, "k").first()) == (3, 2)
    assert tuple(Q.duplicate_keys(df.limit(0), "k").first()) == (0, 0)


def test_step_audit_adds_up(spark):
    raw = raw_frame(spark, {"collision_id": None}, {"collision_id": None}, {"collision_id": " "},
                    {"collision_id": "1"}, {"collision_id": "1"}, {"collision_id": "2"},
                    {"collision_id": "3", "crash_date": "bad"})
    frame = C.rename_raw(raw, RawColumns().names)
    steps = Q.step_audit(frame, "collision_id", "crash_date", "MM/dd/yyyy").orderBy("step").collect()
    assert [(s.rows_before, s.rows_removed, s.rows_after) for s in steps] == [
        (7, 3, 4), (4, 1, 3), (3, 1, 2)]


def test_encoding_audit_sees_bad_bytes_anywhere(spark, tmp_path):
    path = tmp_path / "raw.txt"
    path.write_bytes(b"plain\n" + "café\n".encode() + b"x" * 200_000 + b"\xff\xfe\n")
    audit = Q.encoding_audit(spark.read.text(str(path)), ["value"]).first()
    assert (audit.text_values, audit.valid_utf8_values, audit.ascii_values) == (3, 2, 1)
