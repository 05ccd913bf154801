from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from samples import raw_frame

from casestar.__main__ import main
from casestar.config import RAW_TO_PUBLISHED
from casestar.plans.ingest import RejectedFile, ingest, ingest_checked, validate_raw
from casestar.sources import landing, readers, writers
from casestar.sources.warehouse import open_warehouse

EXTRA = ["CROSS STREET NAME", "OFF STREET NAME", "LOCATION"]


def source_csv(path, lines=400):
    """A file as published: 29 columns, another order, CRLF, quoted and padded values."""
    header = EXTRA[:1] + list(reversed(RAW_TO_PUBLISHED)) + EXTRA[1:]
    values = {"CRASH DATE": "03/05/2020", "CRASH TIME": "5:07", "BOROUGH": '"BRONX, NORTH"',
              "ON STREET NAME": " MAIN STREET ", "LATITUDE": "40.7", "LONGITUDE": "-73.9",
              "LOCATION": '"(40.7, -73.9)"', "NUMBER OF PERSONS KILLED": "1"}
    body = [",".join((values | {"COLLISION_ID": str(n)}).get(name, "") for name in header)
            for n in range(lines)]
    path.write_bytes("\r\n".join([",".join(header), *body, ""]).encode())
    return str(path)


def test_landing_keeps_every_record_over_many_files(spark, conf, tmp_path):
    source = source_csv(tmp_path / "raw.csv")
    conf("spark.sql.files.maxPartitionBytes", "4000")
    conf("spark.sql.files.minPartitionNum", "8")
    report = ingest(spark, source, str(tmp_path / "zone")).first()
    assert (report.source_rows, report.landed_rows, report.is_complete) == (400, 400, True)
    assert landing.landed_files(spark, str(tmp_path / "zone")).count() > 1
    landed = readers.read_raw_csv(spark, str(tmp_path / "zone"))
    assert len(landed.columns) == 29
    assert landed.exceptAll(readers.read_raw_csv(spark, source)).count() == 0


def test_source_is_scanned_once_for_checks_and_copy(spark, tmp_path, monkeypatch):
    """The lines of the source are read by one full scan; the CSV reader only looks at a header."""
    source, zone = source_csv(tmp_path / "raw.csv"), str(tmp_path / "zone")
    scans = []
    written = writers.write_raw_csv
    monkeypatch.setattr(landing, "write_raw_csv", lambda df, path: (
        scans.append(df._jdf.queryExecution().toString()), written(df, path)))
    read = readers.read_raw_csv
    monkeypatch.setattr(landing, "read_raw_csv", lambda spark, path, *names: (
        scans.append(path) if path == zone else None, read(spark, path, *names))[1])
    report, checks = ingest_checked(spark, source, zone)
    assert len(scans) == 2 and scans[0].count("FileScan text") == 1 and scans[1] == zone
    assert "FileScan csv" not in scans[0]
    assert report.first().is_complete
    found = {r.check_name: (r.observed, r.passed) for r in checks.collect()}
    assert found == {r.check_name: (r.observed, r.passed)
                     for r in validate_raw(spark, source).collect()}
    assert found["rows"] == (400, True) and found["columns"] == (29, True)


ODD = (b'id,a b,c\r\n1,"A ""X"" B, C",BRONX\r\n2,short\r\n\r\n   \r\n3,"back\\",M,too,many\r\n'
       b'4,\xff\xfebad,x\r\n5,"open,x\r\n6,,""\r\n7," pad ", y \r"8",q"q,z"\n9,\xef\xbf\xbd,\xc3\xa9')


@pytest.mark.parametrize("extra", [b"", b"\nid,a b,c\n1,copy,x"])
def test_odd_lines_land_as_the_csv_reader_reads_them(spark, tmp_path, extra):
    """Also a record that equals the header, which only the CSV reader can tell from one."""
    (tmp_path / "s").mkdir()
    (tmp_path / "s/1.csv").write_bytes(ODD + extra)
    (tmp_path / "s/2.csv").write_bytes(b"id,a b,c\n")
    (tmp_path / "s/3.csv").write_bytes(b"")
    source, zone = str(tmp_path / "s"), str(tmp_path / "zone")
    landed = landing.land_observed(spark, source, zone, "id")
    wanted = readers.read_raw_csv(spark, source)
    assert sorted(map(repr, readers.read_raw_csv(spark, zone).collect())) == sorted(
        map(repr, wanted.collect()))
    assert landed.is_complete and landed.source["broken_lines"] == 1
    assert landed.source["rows"] == wanted.count() == (11 if extra else 9)
    assert landed.landed["duplicate_rows"] == (1 if extra else 0)
    checks = {r.check_name: r.observed for r in validate_raw(
        spark, source, key="id").collect()}
    assert checks["rows"] == wanted.count() and checks["lines that are not UTF-8"] == 1
    assert checks["duplicate keys"] == (1 if extra else 0)


def test_landing_fails_on_another_header(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s/1.csv").write_text("id,a\n1,x\n2,y\n")
    (tmp_path / "s/2.csv").write_text("a,id\nz,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        landing.land_observed(spark, str(tmp_path / "s"), str(tmp_path / "zone"))


def test_an_empty_file_lands_no_record(spark, tmp_path):
    (tmp_path / "e.csv").write_text("id,a\n")
    landed = landing.land_observed(spark, str(tmp_path / "e.csv"), str(tmp_path / "zone"), "id")
    assert landed.is_complete and landed.source["rows"] == landed.landed["rows"] == 0


def test_a_changed_copy_is_noticed(spark, tmp_path):
    source = source_csv(tmp_path / "raw.csv", 5)
    changed = tmp_path / "changed.csv"
    changed.write_text((tmp_path / "raw.csv").read_text().replace("40.7,", "7.40,", 1))
    report = landing.landing_report(spark, source, str(changed)).first()
    assert report.source_rows == report.landed_rows and not report.is_complete


def test_validation_names_what_is_wrong(spark, tmp_path):
    bad = tmp_path / "raw.txt"
    bad.write_text("COLLISION_ID,CRASH DATE\n1,x\n1,y\n,z\n")
    checks = {r.check_name: (r.observed, r.passed) for r in validate_raw(spark, str(bad)).collect()}
    assert checks == {
        "files with another extension": (1, False), "bytes": (bad.stat().st_size, True),
        "rows": (3, True), "columns": (2, True), "required columns missing": (4, False),
        "lines that are not UTF-8": (0, True), "duplicate keys": (1, False)}
    with pytest.raises(RejectedFile, match="extension, required columns"):
        ingest(spark, str(bad), str(tmp_path / "zone"))
    assert not (tmp_path / "zone").exists()


def test_duplicates_alone_do_not_reject(spark, tmp_path):
    source = source_csv(tmp_path / "raw.csv", 3)
    with open(source, "ab") as file:
        file.write(open(source, "rb").read().split(b"\r\n")[1] + b"\r\n")
    assert ingest(spark, source, str(tmp_path / "zone")).first().landed_rows == 4


def test_csv_values_survive_as_text(spark, tmp_path):
    raw = raw_frame(spark, {"borough": "  "}, {"borough": None}, {"borough": ' a "quoted", b\\ '},
                    {"zip_code": "01234"})
    writers.write_raw_csv(raw, str(tmp_path / "zone"))
    back = readers.read_standard_csv(spark, str(tmp_path / "zone"))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, raw.collect()))


def test_a_missing_file_fails_and_a_missing_result_is_empty(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_raw_csv(spark, str(tmp_path / "none"))
    empty = readers.read_result_csv(spark, str(tmp_path / "none"), "q2_hour_day_heatmap")
    assert empty.columns == ["day_of_week", "hour", "total_pedestrian_injuries"]
    assert empty.count() == 0


def test_text_report_is_ordered_and_right_trimmed(spark, tmp_path):
    lines = spark.createDataFrame([(2, "b  "), (1, "a "), (3, "")], "n int, line string")
    writers.write_text_report(lines, str(tmp_path / "report"), order=["n"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "report").glob("part-*")))
    assert text == "a\nb\n\n"


def test_command_line_from_file_to_answers(spark, tmp_path, monkeypatch):
    source = source_csv(tmp_path / "raw.csv", 20)
    zone, root, out = (str(tmp_path / name) for name in ("zone", "root", "out"))
    main(["land", source, zone])
    main(["build", zone, root])
    main(["answer", root, out])
    assert open_warehouse(spark, root).rows["fact_crash"] == 20
    rates = readers.read_result_csv(spark, f"{out}/csv/q1_borough_fatality_rates",
                                    "q1_borough_fatality_rates").collect()
    assert [(r.borough, r.year, r.total_crashes, r.total_fatalities) for r in rates] == [
        ("BRONX, NORTH", 2020, 20, 20)]
    report = "".join(p.read_text() for p in (tmp_path / "out/text/insights_summary").glob("part-*"))
    assert report.startswith("Q1 Interpretation\n- The highest borough-year fatality rate was BRONX, NORTH")


QUOTED = '''id,street,borough
1,"A ""X"" B, C",BRONX
3,"back\\",MANHATTAN
4,plain,BROOKLYN
'''


def test_quoted_fields_are_read_and_landed_as_written(spark, tmp_path):
    (tmp_path / "source").mkdir()
    (tmp_path / "source" / "a.csv").write_text(QUOTED)
    wanted = {("1", 'A "X" B, C', "BRONX"), ("3", "back\\", "MANHATTAN"),
              ("4", "plain", "BROOKLYN")}
    source, zone = str(tmp_path / "source"), str(tmp_path / "quoted_zone")
    assert {tuple(r) for r in readers.read_raw_csv(spark, source).collect()} == wanted
    landing.land_raw(spark, source, zone)
    assert {tuple(r) for r in readers.read_raw_csv(spark, zone).collect()} == wanted
    report = landing.landing_report(spark, source, zone).first()
    assert (report.source_rows, report.landed_rows, report.is_complete) == (3, 3, True)


def test_line_breaks_in_quotes_take_multi_line(spark, tmp_path):
    (tmp_path / "b.csv").write_text('id,street\n2,"line\nbreak"\n')
    rows = readers.read_raw_csv(spark, str(tmp_path / "b.csv"), multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("2", "line\nbreak")]


def test_another_header_order_fails(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "1.csv").write_text("id,borough,zip\n1,BRONX,10\n2,BRONX,11\n")
    (tmp_path / "c" / "2.csv").write_text("id,zip,borough\n3,12,QUEENS\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_raw_csv(spark, str(tmp_path / "c")).collect()
