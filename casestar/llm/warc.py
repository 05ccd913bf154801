"""Legacy ARC archives and their conversion to WARC.

Method. An ARC file starts with a version block that names the fields of its URL records: version
1 has five, version 2 ten. The converter reads that line, then record after record: a header
line, split by the fields of the version, and as many bytes as it declares. From these it makes
WARC records: an identifier derived from URL, date and content, the date as a WARC timestamp, the
type from the scheme and the content type, block and payload digests. Equal payloads of at least
``revisit_bytes`` become revisits of one response.

Archives are written by Spark's text writer with a record separator, so they commit and retry
like any table, lie in the shared folder, and a lost task leaves nothing behind.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.llm.common import place, staged

# Fixed values of the formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
       "Archive-length",
}
WARC_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT_BYTES = 1000
FILE_BYTES = 16 << 20
PAGE_HEADER = "X-Page-Id"


def _bytes_in(df: DataFrame, column: str) -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]


def write_arc(pages: DataFrame, path: str, version: int, archive_date: str = "20240101000000",
              file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages`` (``page_id, url, html``) as gzipped ARC files of about ``file_bytes``.

    The network document of a record is an HTTP response whose header carries the page id. White
    space in a URL is percent-encoded; a null URL is written as ``unknown:``.
    """
    files = 1 + _bytes_in(pages, "html") // file_bytes
    url = F.coalesce(F.col("url"), F.lit("unknown:"))
    url = F.when(url.rlike(r"[\x00-\x20\x7f]"), F.url_encode(url)).otherwise(url)
    url = F.when(url == "", F.lit("unknown:")).otherwise(url)
    body = F.coalesce(F.col("html"), F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n{PAGE_HEADER}: "),
                    F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n\r\n"))
    length = (F.octet_length(head) + F.octet_length(body)).cast("string")
    more = [F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("-")] if version == 2 else []
    line = F.concat_ws(" ", url, F.lit("0.0.0.0"), F.lit(archive_date), F.lit("text/html"), *more,
                       length)
    fields = ARC_FIELDS[version] + "\n"
    block = f"{version} 0 casestar\n{fields}"
    first = " ".join(["filedesc://pages.arc", "0.0.0.0", archive_date, "text/plain",
                      *(["200", "-", "-", "0", "pages.arc"] if version == 2 else []),
                      str(len(block))])
    first_row = (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0)
    record = F.concat(line, F.lit("\n"), head, body)
    # the first row of each task, which writes one file, brings the version block with it
    rows = pages.select("page_id", "url", "html")
    (rows.repartition(files, F.xxhash64("page_id", "url"))
     .select(F.when(first_row, F.concat(F.lit(f"{first}\n{block}\n"), record))
                 .otherwise(record).alias("value"))
     .write.option("lineSep", "\n").option("compression", "gzip").text(path))


def inflated(content: bytes) -> bytes:
    """A gzipped file of one or more members; other content as it is."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        parts.append(member.decompress(content))
        content = member.unused_data.lstrip(b"\0")
    return b"".join(parts)


def arc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The URL records of an ARC file: fields by name, and the declared number of bytes.

    The version block gives version and field names; a file that starts without one, or is cut
    short, is an error that names the place.
    """
    content, at, names = inflated(content), 0, None
    while at < len(content):
        if content[at:at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = content.find(b"\n", at)
        end = len(content) if end < 0 else end
        line = content[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        fields = dict(zip(names, line)) if names else None
        if (names and len(line) != len(names)) or not line[-1].isdigit():
            raise ValueError(f"ARC header expected at byte {at}: {' '.join(line)[:80]!r}")
        length = int(line[-1])
        body = content[end + 1:end + 1 + length]
        if len(body) < length:
            raise ValueError(f"ARC record at byte {at} declares {length} bytes, {len(body)} follow")
        if names is None:
            if not line[0].startswith("filedesc:"):
                raise ValueError("an ARC file starts with a version block")
            version, wanted = body.split(b"\n")[:2]
            names = wanted.decode().strip().split(" ")
            if ARC_FIELDS.get(int(version.split(b" ")[0])) != " ".join(names):
                raise ValueError(f"unknown ARC version block: {version!r}")
        else:
            yield fields, body
        at = end + 1 + length


def warc_date(arc_date: str) -> str:
    """``YYYYMMDDhhmmss``, or a shorter date, as a WARC timestamp."""
    digits = re.sub(r"\D", "", arc_date)[:14]
    padded = digits + "00000101000000"[len(digits):]
    return datetime.strptime(padded, "%Y%m%d%H%M%S").replace(
        tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(url: str, date: str, digest: str, page: str) -> str:
    """The same record always gets the same identifier."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join((url, date, digest, page)))}>"


def converted(arc_files: DataFrame) -> DataFrame:
    """What the converter makes of each URL record, before it knows of equal payloads:
    ``page_id, url, date, kind, content_type, head, payload`` with ``digest`` (hexadecimal SHA-1
    of the payload) and ``record_id``. ``arc_files`` has a column ``content``."""
    names = ["page_id", "url", "date", "kind", "content_type", "head", "payload", "digest",
             "record_id"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, body in arc_records(content.as_py()):
                    url, date = fields["URL"], warc_date(fields["Archive-date"])
                    web = url.startswith(("http:", "https:", "unknown:")) or body[:5] == b"HTTP/"
                    cut = body.find(b"\r\n\r\n") + 4 if body[:5] == b"HTTP/" else 0
                    head, payload = body[:max(cut, 0)], body[max(cut, 0):]
                    page = re.search(rb"(?im)^X-Page-Id: *(\S*)\r?$", head)
                    number = page[1].decode() if page else ""
                    digest = hashlib.sha1(payload).hexdigest()
                    rows.append((int(number) if number else None, url, date,
                                 "response" if web and head else "resource",
                                 "application/http; msgtype=response" if head
                                 else fields["Content-type"],
                                 head, payload, digest, record_id(url, date, digest, number)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*rows) if rows else [()] * len(names),
                        [pa.int64(), *[pa.string()] * 4, pa.binary(), pa.binary(), pa.string(),
                         pa.string()])], names=names)

    return arc_files.select("content").mapInArrow(
        each, "page_id long, url string, date string, kind string, content_type string, "
              "head binary, payload binary, digest string, record_id string")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The archive files of a folder, one row each."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def arc_to_warc(spark: SparkSession, arc_paths: list[str], warc_path: str,
                revisit_bytes: int = REVISIT_BYTES) -> None:
    """Convert ARC files to gzipped WARC files.

    Two passes over the ARC files: the first only keeps digests and finds the response of each
    group of equal payloads (the largest page id), the second writes the records. The digests of
    a group are reduced before they are shuffled.
    """
    files = read_files(spark, arc_paths[0])
    for path in arc_paths[1:]:
        files = files.unionByName(read_files(spark, path))
    records = converted(files)
    large = (records.where(F.octet_length("payload") >= revisit_bytes)
             .select("digest", F.struct("page_id", "record_id", "url", "date").alias("first")))
    firsts = staged(large.groupBy("digest").agg(F.max("first").alias("first"),
                                                F.count("*").alias("copies"))
                    .where("copies > 1").select(F.col("digest").alias("_digest"), "first"),
                    "responses")
    text = [F.col("head").cast("string"), F.col("payload").cast("string")]
    joined = records.join(firsts, F.col("digest") == F.col("_digest"), "left")
    revisit = F.col("first.record_id") != F.col("record_id")
    revisit = F.coalesce(revisit & (F.octet_length("payload") >= revisit_bytes), F.lit(False))
    block = F.when(revisit, text[0]).otherwise(F.concat(*text))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.when(revisit, "revisit").otherwise(F.col("kind"))),
        field("WARC-Record-ID", F.col("record_id")),
        field("WARC-Date", F.col("date")),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(block.cast("binary")))),
        field("X-Payload-Length", F.octet_length("payload").cast("string")),
        F.when(revisit, F.concat(
            field("WARC-Profile", F.lit(REVISIT_PROFILE)),
            field("WARC-Refers-To", F.col("first.record_id")),
            field("WARC-Refers-To-Target-URI", F.col("first.url")),
            field("WARC-Refers-To-Date", F.col("first.date")),
            field("X-Refers-To-Page-Id", F.coalesce(F.col("first.page_id").cast("string"),
                                                    F.lit(""))))).otherwise(F.lit("")),
        field("Content-Type", F.col("content_type")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"))
    (joined.select(F.concat(header, block).alias("value"))
     .write.option("lineSep", WARC_END).option("compression", "gzip").text(warc_path))


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of a WARC file: header fields in lower case, and the block."""
    content, at = inflated(content), 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"WARC record expected at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in
                  (line.partition(":") for line in lines[1:])}
        start = end + 4
        length = int(fields["content-length"])
        block = content[start:start + length]
        if len(block) < length or content[start + length:start + length + 4] != b"\r\n\r\n":
            raise ValueError(f"WARC record at byte {at} declares {length} bytes")
        yield fields, block
        at = start + length + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of each record, with
    both digests checked against the bytes read."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in warc_records(content.as_py()):
                    cut = block.find(b"\r\n\r\n") + 4 if block[:5] == b"HTTP/" else 0
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    revisit = fields["warc-type"] == "revisit"
                    if hashlib.sha1(block).hexdigest() != fields["warc-block-digest"][5:] or not (
                            revisit or hashlib.sha1(block[cut:]).hexdigest() == digest):
                        raise ValueError(f"digest of {fields['warc-record-id']} does not match")
                    page = re.search(rb"(?im)^X-Page-Id: *(\S*)\r?$", block[:cut])
                    other = fields.get("x-refers-to-page-id")
                    rows.append((int(page[1]) if page and page[1] else None,
                                 int(fields["x-payload-length"]) if revisit
                                 else len(block) - cut, digest,
                                 "revisit" if revisit else "response",
                                 int(other) if other else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, kinds)],
                    names=names)

    files = read_files(spark, path).select("content")
    return files.mapInArrow(each, "page_id long, payload_bytes long, payload_digest string, "
                                  "record_type string, refers_to long")


def archived(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``pages`` through ARC files of both versions (even ids in version 1, others in version 2)
    and WARC files, read back: one row per row.

    A null page is the empty payload. Of repeated rows with one id, those with equal payloads of
    at least ``revisit_bytes`` share one identifier and are all responses. Other columns are
    ignored.
    """
    spark, folder = pages.sparkSession, place(pages.sparkSession, "archives")
    even = F.coalesce(F.col("page_id") % 2 == 0, F.lit(True))
    write_arc(pages.where(even), f"{folder}/arc1", 1)
    write_arc(pages.where(~even), f"{folder}/arc2", 2)
    arc_to_warc(spark, [f"{folder}/arc1", f"{folder}/arc2"], f"{folder}/warc", revisit_bytes)
    return read_warc(spark, f"{folder}/warc")
