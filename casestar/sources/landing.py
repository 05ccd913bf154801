"""Landing a raw CSV in the raw zone, and checking what arrived."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.functions import text_bytes
from casestar.operators.observed import Watch, row_count
from casestar.operators.quality import copies_profile, file_audit, one_row
from casestar.schemas import all_strings
from casestar.sources.readers import read_raw_csv
from casestar.sources.writers import write_raw_csv


def land_raw(spark: SparkSession, source: str, raw_zone: str) -> None:
    """Copy the records, replacing what the raw zone held.

    Values stay text as they were. Many tasks write many files, so each gets the header:
    copying bare lines would leave it in the first file only, and a reader that expects one
    per file would then lose a record in each of the others.
    """
    write_raw_csv(read_raw_csv(spark, source), raw_zone)


def landing_report(spark: SparkSession, source: str, raw_zone: str) -> DataFrame:
    """Records and bytes of text on both sides, and whether the records are the same.

    The comparison adds up a hash per record, so it needs no order and no shuffle.
    """
    def totals(path: str, side: str) -> DataFrame:
        records = read_raw_csv(spark, path)
        return records.agg(*[m.alias(f"{side}_{n}") for n, m in record_metrics(records).items()])

    both = one_row(totals(source, "source"), totals(raw_zone, "landed"))
    same = ((F.col("source_rows") == F.col("landed_rows"))
            & F.col("source_hash").eqNullSafe(F.col("landed_hash")))
    return both.withColumn("is_complete", same).drop("source_hash", "landed_hash")


def record_metrics(records: DataFrame) -> dict[str, Column]:
    """Rows, bytes of text, and a sum of hashes that does not depend on the order of records."""
    texts = [F.col(f"`{name}`") for name in records.columns]
    marked = [F.coalesce(text, F.lit("\0")) for text in texts]
    return {"rows": row_count(), "bytes": F.coalesce(F.sum(text_bytes(texts)), F.lit(0)),
            "hash": F.sum(F.xxhash64(*marked).cast("decimal(20,0)"))}


@dataclass(frozen=True)
class RawLines:
    """The lines of raw CSV files, each record on one line, under a common header line."""

    lines: DataFrame
    header: str | None
    names: list[str]
    files: int

    def is_record(self) -> Column:
        return self.is_filled() & (F.col("value") != F.lit(self.header))

    def is_filled(self) -> Column:
        """Lines of white space and control characters are no records to a CSV reader."""
        return F.col("value").rlike(r"[^\x00-\x20]")

    def parsed(self) -> Column:
        """A line as a record, read as ``read_raw_csv`` reads it: all text, RFC 4180 quotes."""
        return F.from_csv("value", all_strings(self.names).toDDL(), {"escape": '"'})


def raw_lines(spark: SparkSession, path: str, names=None) -> RawLines:
    """Lines with every byte as it is. Looks at the listing and at one line.

    ``names`` are the columns; without them they are looked up in the header.
    """
    lines = spark.read.text(path)
    names = list(names or read_raw_csv(spark, path).columns)
    found = RawLines(lines, None, names, file_audit(spark, path).where("size_bytes > 0").count())
    first = lines.where(found.is_filled()).first()
    return RawLines(lines, first and first.value, names, found.files)


@dataclass(frozen=True)
class Landed:
    """What was seen on the way into the raw zone, and what is there now."""

    source: dict[str, int]
    landed: dict[str, int]

    @property
    def is_complete(self) -> bool:
        return all(self.source[name] == self.landed[name] for name in ("rows", "bytes", "hash"))

    def report(self, spark: SparkSession) -> DataFrame:
        """As ``landing_report``, from the counts at hand."""
        row = [(self.source["rows"], self.source["bytes"], self.landed["rows"],
                self.landed["bytes"], self.is_complete)]
        return spark.createDataFrame(row, "source_rows bigint, source_bytes bigint, "
                                          "landed_rows bigint, landed_bytes bigint, "
                                          "is_complete boolean")


def land_observed(spark: SparkSession, source: str, raw_zone: str,
                  key: str | None = None) -> Landed:
    """Copy the records in one scan of the source that also counts, hashes and tests its lines.

    The lines are read as bytes, so encoding is tested on what the file holds, and parsed next to
    that test; totals are observed in the tasks that write the copy. The landed records are then
    read once, for their totals and the copies of each ``key``.

    Header lines are told by their text. If there are not as many as files (a record equals the
    header, a file has another one), the CSV reader decides, in a second scan, and fails if a
    header differs. Line breaks inside quotes take ``land_raw`` with a multi-line reader.
    """
    raw = raw_lines(spark, source)
    watch = Watch(spark)
    lines = watch.on(raw.lines, {
        "lines": row_count(),
        "broken_lines": F.count_if(~F.is_valid_utf8("value")),
        "header_lines": F.count_if(F.col("value") == F.lit(raw.header)),
    })
    records = lines.where(raw.is_record()).select(raw.parsed().alias("r")).select("r.*")
    write_raw_csv(watch.on(records, record_metrics(records)), raw_zone)
    seen = watch.values()
    if seen["header_lines"] != raw.files:
        again = Watch(spark)
        records = read_raw_csv(spark, source)
        write_raw_csv(again.on(records, record_metrics(records)), raw_zone)
        seen |= again.values()
    return Landed(seen, landed_totals(spark, raw_zone, raw.names, key))


def landed_totals(spark: SparkSession, raw_zone: str, names, key: str | None) -> dict[str, int]:
    """Totals of the landed records and, with ``key``, its duplicates, in one pass."""
    records = read_raw_csv(spark, raw_zone, names)
    metrics = [metric.alias(name) for name, metric in record_metrics(records).items()]
    if key not in names:
        found = records.agg(*metrics).first()
        return {name: found[name] or 0 for name in found.asDict()}
    by_key = records.groupBy(F.col(f"`{key}`").alias("key")).agg(*metrics)
    found = by_key.agg(*copies_profile("rows"), F.sum("bytes").alias("bytes"),
                       F.sum("hash").alias("hash")).first()
    return {"rows": found.row_count, "bytes": found.bytes or 0, "hash": found.hash or 0,
            "duplicate_rows": found.duplicate_rows}


def landed_files(spark: SparkSession, raw_zone: str) -> DataFrame:
    """The listing of the raw zone: path, name and size of each file."""
    return file_audit(spark, raw_zone).select("path", "file_name", "size_bytes")
