"""Metrics frames and the publication gate. Each metric frame is one pass over its input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casestar.functions import is_blank
from casestar.operators.clean import first_with_copies
from casestar.operators.observed import fingerprint, row_count, same_values


class GateFailure(RuntimeError):
    """A warehouse that must not be published."""


def required_columns(df: DataFrame, names) -> DataFrame:
    """One row per required column: is it there, and how many of its values are filled?

    All columns are profiled in one aggregate; a missing column has null as its count.
    """
    present = [name for name in names if name in df.columns]
    filled = df.agg(*[F.count_if(~is_blank(F.col(f"`{name}`").cast("string"))).alias(f"c{at}")
                      for at, name in enumerate(present)], F.count(F.lit(1)).alias("all_rows"))
    report = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(name in present).alias("is_present"),
            (F.col(f"c{present.index(name)}") if name in present
             else F.lit(None).cast("bigint")).alias("filled_rows"),
        )
        for name in names
    ]
    return filled.select(F.explode(F.array(*report)).alias("r")).select("r.*")


def missing_columns(df: DataFrame, names) -> list[str]:
    return [name for name in names if name not in df.columns]


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key value; null counts as one of the values."""
    return key_profile(df, key).drop("row_count")


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """``duplicate_keys`` and the number of rows, from one pass."""
    counted = df.groupBy(F.col(f"`{key}`")).agg(F.count(F.lit(1)).alias("copies"))
    return counted.agg(*copies_profile("copies"))


def copies_profile(copies: str) -> list[Column]:
    """Rows, rows beyond the first and repeated keys, from one row per key with its copies."""
    return [
        F.coalesce(F.sum(copies), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col(copies) - 1), F.lit(0)).alias("duplicate_rows"),
        F.count_if(F.col(copies) > 1).alias("keys_with_duplicates"),
    ]


def file_audit(spark: SparkSession, path: str, accepted=(".csv",)) -> DataFrame:
    """One row per file below ``path``: name, extension, whether accepted, size.

    Only the listing is read: the ``content`` column is never asked for.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
              .select("path", "length"))
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    extension = F.lower(F.regexp_extract(F.col("file_name"), r"(\.[^.]*)$", 1))
    return (listed.withColumn("file_name", name)
            .withColumn("extension", extension)
            .select(
                "path", "file_name", "extension",
                F.col("extension").isin(*accepted).alias("is_accepted"),
                F.col("length").alias("size_bytes"),
                (F.col("length") / F.lit(1048576.0)).alias("size_mb"),
            ))


def encoding_audit(df: DataFrame, columns) -> DataFrame:
    """One row per text column: how many values are valid UTF-8, and how many plain ASCII.

    Run on ``spark.read.text`` lines it audits a whole raw file, since that source keeps the
    bytes as they are. Whole values are checked, not a leading sample.
    """
    sums = []
    for at, name in enumerate(columns):
        text = F.col(f"`{name}`")
        sums += [
            F.count(text).alias(f"n{at}"),
            F.count_if(F.is_valid_utf8(text)).alias(f"u{at}"),
            F.count_if(F.is_valid_utf8(text)
                       & (F.octet_length(text) == F.char_length(text))).alias(f"a{at}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"n{at}").alias("text_values"),
            F.col(f"u{at}").alias("valid_utf8_values"),
            F.col(f"a{at}").alias("ascii_values"),
            F.when(F.col(f"n{at}") > 0, F.col(f"a{at}") / F.col(f"n{at}")).alias("ascii_share"),
        )
        for at, name in enumerate(columns)
    ]
    return df.agg(*sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def count_flags(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(test).alias(name) for name, test in predicates.items()])


def coordinate_audit(df: DataFrame, latitude: str, longitude: str, latitude_range,
                     longitude_range) -> DataFrame:
    """Counts over parsed coordinates, before zeros and outliers are nulled."""
    return count_flags(df, coordinate_predicates(latitude, longitude, latitude_range,
                                                 longitude_range))


def coordinate_predicates(latitude: str, longitude: str, latitude_range,
                          longitude_range) -> dict[str, Column]:
    lat, lon = F.col(latitude), F.col(longitude)
    return {
        "both_zero_rows": (lat == 0) & (lon == 0),
        "latitude_out_of_range_rows": (lat != 0) & ~lat.between(*map(float, latitude_range)),
        "longitude_out_of_range_rows": (lon != 0) & ~lon.between(*map(float, longitude_range)),
    }


def step_audit(raw: DataFrame, key: str, date_text: str, date_format: str) -> DataFrame:
    """Rows before, removed and after each row-dropping step, from one grouped pass.

    Blank and null keys are grouped like any other and told apart afterwards, so the raw
    table is read once, not once per counter. The survivor of a key is its smallest row by all
    columns, so its date follows from the columns up to the date; the others are not read.
    """
    rest = [name for name in raw.columns if name != key]
    leading = rest[:rest.index(date_text) + 1]
    survivors = first_with_copies(raw.select(key, *leading), key, "_copies")
    has_key = ~is_blank(F.col(key))
    dated = F.try_to_date(F.col(date_text), date_format).isNotNull()
    totals = survivors.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum(F.when(has_key, F.col("_copies"))), F.lit(0)).alias("rows_keyed"),
        F.count_if(has_key).alias("rows_unique"),
        F.count_if(has_key & dated).alias("rows_dated"),
    )
    steps = [
        ("1 missing key", "rows_read", "rows_keyed"),
        ("2 duplicate key", "rows_keyed", "rows_unique"),
        ("3 invalid date", "rows_unique", "rows_dated"),
    ]
    rows = [
        F.struct(
            F.lit(label).alias("step"),
            F.col(before).alias("rows_before"),
            (F.col(before) - F.col(after)).alias("rows_removed"),
            F.col(after).alias("rows_after"),
        )
        for label, before, after in steps
    ]
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table; bare counts are answered from Parquet footers."""
    counted = [df.agg(F.count(F.lit(1)).alias("row_count"))
                 .select(F.lit(name).alias("table_name"), "row_count",
                         F.lit(len(df.columns)).alias("column_count"))
               for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def fact_integrity(fact: DataFrame, base: DataFrame, key: str, foreign_keys,
                   base_is_unique: bool = False) -> DataFrame:
    """One metrics row about a fact table and the frame it was built from.

    With ``base_is_unique`` (no key of ``base`` is missing or repeats) a pass over each frame sums
    fingerprints of the keys first. If they agree, no key repeats in the fact either, and the keys
    are never shuffled. Otherwise, and without the flag, distinct keys are counted.
    """
    if base_is_unique:
        found = key_sums(fact, base, key, foreign_keys).first()
        if keys_agree(found):
            return fact.sparkSession.createDataFrame(
                [integrity_row(found, 0, key, foreign_keys)], integrity_schema(key, foreign_keys))
    distinct = fact.agg(F.countDistinct(key).alias("distinct_ids"))
    return one_row(key_sums(fact, base, key, foreign_keys), distinct).select(
        "fact_rows", "base_rows",
        (F.col("fact_rows") - F.col("base_rows")).alias("row_inflation"),
        (F.col("fact_rows") - F.col("distinct_ids")).alias("duplicate_ids"),
        *[f"null_{name}" for name in (key, *foreign_keys)],
    )


def fact_metrics(key: str, foreign_keys) -> dict[str, Column]:
    """Rows, null keys and the fingerprint of the ids of a fact."""
    return {"fact_rows": row_count(),
            **{f"null_{name}": F.count_if(F.col(name).isNull()) for name in (key, *foreign_keys)},
            **fingerprint(key, "fact_ids")}


def base_metrics(key: str) -> dict[str, Column]:
    return {"base_rows": row_count(), **fingerprint(key, "base_ids")}


def key_sums(fact: DataFrame, base: DataFrame, key: str, foreign_keys) -> DataFrame:
    """Both sides' metrics in one row; each side is one pass and no key is shuffled."""
    def total(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
        return df.agg(*[metric.alias(name) for name, metric in metrics.items()])

    return one_row(total(fact, fact_metrics(key, foreign_keys)), total(base, base_metrics(key)))


def keys_agree(metrics) -> bool:
    return (metrics["fact_rows"] == metrics["base_rows"]
            and same_values(metrics, "fact_ids", "base_ids"))


def integrity_row(metrics, duplicate_ids: int, key: str, foreign_keys) -> dict[str, int]:
    return {"fact_rows": metrics["fact_rows"], "base_rows": metrics["base_rows"],
            "row_inflation": metrics["fact_rows"] - metrics["base_rows"],
            "duplicate_ids": duplicate_ids,
            **{f"null_{name}": metrics[f"null_{name}"] for name in (key, *foreign_keys)}}


def integrity_schema(key: str, foreign_keys) -> str:
    return ", ".join(f"{name} bigint" for name in (
        "fact_rows", "base_rows", "row_inflation", "duplicate_ids",
        *[f"null_{name}" for name in (key, *foreign_keys)]))


def one_row(*frames: DataFrame) -> DataFrame:
    """Side-by-side columns of one-row frames, without a join."""
    stacked = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def zero_checks(key: str, foreign_keys) -> list[str]:
    """Metrics of ``fact_integrity`` that have to be zero."""
    return [f"null_{name}" for name in (key, *foreign_keys)] + ["row_inflation", "duplicate_ids"]


def gate_checks(metrics: DataFrame, key: str, foreign_keys) -> DataFrame:
    """The metrics as one row per check."""
    rows = [F.struct(F.lit(name).alias("check_name"),
                     F.col(name).cast("bigint").alias("observed"),
                     (F.col(name) == 0).alias("passed")) for name in zero_checks(key, foreign_keys)]
    return metrics.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def gate(observed: Row | dict, key: str, foreign_keys) -> None:
    """Raise ``GateFailure`` naming every failed check of a ``fact_integrity`` row."""
    failed = [f"{name}={observed[name]}" for name in zero_checks(key, foreign_keys)
              if observed[name] != 0]
    if failed:
        raise GateFailure("warehouse not published: " + ", ".join(failed))


def partition_summary(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """The partitions of a folder-partitioned table that hold files, in order.

    Answered from the listing: no file is opened. A folder without files does not count, and a
    file outside ``key=value`` folders of these columns is an error.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
              .where("length > 0").select("path"))
    inside = F.substring(F.col("path"), F.length(F.regexp_extract("path", _TABLE.format(
        path.rstrip("/").rsplit("/", 1)[-1]), 0)) + 1, 1 << 20)
    named = listed.select(*[_folder_value(inside, f) for f in columns])
    return named.distinct().orderBy(*columns.names)


# everything up to the table's own folder
_TABLE = r"^.*/\Q{}\E(?=/)"
# Fixed value: the folder name of a null.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _folder_value(inside: Column, field: T.StructField) -> Column:
    """The value of a column in a path, typed; other folder names raise."""
    text = F.regexp_extract(inside, rf"/\Q{field.name}\E=([^/]*)/", 1)
    missing = F.raise_error(F.concat(F.lit(f"not partitioned by {field.name}: "), inside))
    # a plus sign stands for itself in folder names
    value = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return (F.when(text == "", missing.cast("string"))
            .when(text != _NULL_FOLDER, value)).cast(field.dataType).alias(field.name)
