"""Raw text records to a gated, published star schema."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.config import COUNT_COLUMNS, PARTITION_COLUMNS, CleanRules, RawColumns
from casestar.functions import is_blank, lenient_long
from casestar.operators.clean import (
    above_flag,
    all_zero_flag,
    dedup_by_key,
    drop_blank_key,
    event_hour,
    lenient_cast,
    null_out_of_range,
    parse_date_drop_invalid,
    rename_raw,
    zero_to_null,
)
from casestar.operators.dimensions import (
    Dimension,
    build_dimension,
    published_dimension,
    standard_dimensions,
)
from casestar.operators.facts import (
    BROADCAST_LIMIT_BYTES,
    build_fact,
    fact_base,
    fits_broadcast,
    hot_natural_keys,
)
from casestar.operators.keys import KeyedTable
from casestar.operators.observed import Watch, added, row_count, watched
from casestar.operators.quality import (
    GateFailure,
    base_metrics,
    coordinate_predicates,
    fact_integrity,
    fact_metrics,
    gate,
    integrity_row,
    keys_agree,
)
from casestar.session import released_shuffles
from casestar.sources.retention import VERSION_PREFIX, drop_lease, take_lease
from casestar.sources.warehouse import AUDIT, Warehouse, latest_warehouse, publish
from casestar.sources.writers import rebalanced, write_table

COORDINATES = ["latitude", "longitude"]
ALL_DIMENSIONS = ("dim_date", "dim_location", "dim_vehicle", "dim_factor")
FLAGS = ("property_damage_only", "injury_count_flagged")
COORDINATE_COUNTS = ("both_zero_rows", "latitude_out_of_range_rows", "longitude_out_of_range_rows")
FOREIGN_KEY_ORDER = ("date_key", "location_key", "vehicle_key", "factor_key")


def unique_records(raw: DataFrame, columns: RawColumns = RawColumns(),
                   watch: Watch | None = None) -> DataFrame:
    """Published names, keyed rows only, one row per id; all still text."""
    named = rename_raw(raw, columns.names)
    return (watched(named, watch, key_metrics("collision_id"))
            .transform(drop_blank_key, "collision_id")
            .transform(dedup_by_key, "collision_id"))


def key_metrics(key: str) -> dict[str, Column]:
    return {"rows_read": row_count(), "rows_keyed": F.count_if(~is_blank(F.col(key)))}


def typed_metrics(rules: CleanRules) -> dict[str, Column]:
    tests = coordinate_predicates(*COORDINATES, rules.latitude_range, rules.longitude_range)
    return {"rows_unique": row_count(), "ids_respelled": F.count_if(is_respelled("collision_id")),
            **{n: F.count_if(test) for n, test in tests.items()}}


def is_respelled(key: str) -> Column:
    """Whether the typed id would be written otherwise than the text is, or is missing."""
    return ~F.col(key).eqNullSafe(lenient_long(F.col(key)).cast("string"))


def clean_metrics() -> dict[str, Column]:
    return {**{f"{flag}_rows": F.count_if(F.col(flag)) for flag in FLAGS},
            **base_metrics("collision_id")}


def typed_coordinates(unique: DataFrame) -> DataFrame:
    return lenient_cast(unique, {name: "double" for name in COORDINATES})


def unique_coordinates(raw: DataFrame, columns: RawColumns = RawColumns()) -> DataFrame:
    """Id and typed coordinates of each row of ``unique_records``.

    The survivor of an id is its smallest row by all columns in their order, so its coordinates
    follow from the columns up to them; the others are neither read nor shuffled.
    """
    upto = max(list(columns.names.values()).index(name) for name in COORDINATES)
    leading = {source: name for at, (source, name) in enumerate(columns.names.items())
               if at <= upto or name == "collision_id"}
    unique = unique_records(raw, replace(columns, names=leading))
    return typed_coordinates(unique).select("collision_id", *COORDINATES)


def valid_coordinates(typed: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    return (typed.transform(zero_to_null, COORDINATES)
            .transform(null_out_of_range, {"latitude": rules.latitude_range,
                                           "longitude": rules.longitude_range}))


def clean_records(raw: DataFrame, columns: RawColumns = RawColumns(),
                  rules: CleanRules = CleanRules(), watch: Watch | None = None) -> DataFrame:
    """The cleaned wide table: one shuffle, for the ids; all else is a projection.

    A ``watch`` counts what each step reads, drops and flags while the table is written.
    """
    typed = unique_records(raw, columns, watch).transform(typed_coordinates)
    clean = (watched(typed, watch, typed_metrics(rules))
            .transform(valid_coordinates, rules)
            .withColumn("date_text", F.col("crash_date"))
            .transform(parse_date_drop_invalid, "date_text", rules.date_format, "crash_date")
            .transform(lenient_cast, {name: "int" for name in COUNT_COLUMNS})
            .transform(all_zero_flag, list(COUNT_COLUMNS), "property_damage_only")
            .transform(above_flag, "persons_injured", rules.outlier_above, "injury_count_flagged")
            .transform(event_hour, "date_text", "crash_time", "hour", rules.date_format,
                       rules.time_format, rules.default_time)
            .withColumns({
                "collision_id": lenient_long(F.col("collision_id")),
                "partition_year": F.year("crash_date"),
                "partition_month": F.month("crash_date"),
            })
            .drop("date_text"))
    return watched(clean, watch, clean_metrics())


@dataclass(frozen=True)
class StagedClean:
    """The cleaned table of a new version, written under ``path``, and the dimensions to come."""

    path: str
    clean: DataFrame
    parts: tuple[DataFrame, ...]  # the same rows, as the passes wrote them
    dims: dict[str, Dimension]
    counts: dict[str, int]  # observed while the clean table was written

    def base(self) -> DataFrame:
        """The fact base needs the specs of the dimensions, not their rows."""
        return fact_base(self.clean, self.dims.values())


@dataclass(frozen=True)
class StagedStar(StagedClean):
    """What the fact is built from: written tables under ``path`` that will not change any more."""

    keyed: dict[str, KeyedTable]

    def hot(self, broadcast=()) -> dict[str, list[int]]:
        """Hot natural keys of the dimensions that are not broadcast, in one pass over the columns
        of those keys."""
        shuffled = [name for name in self.dims
                    if name not in broadcast or not fits_broadcast(self.keyed[name])]
        return hot_natural_keys(self.base(), self.dims, shuffled)

    def fact(self, broadcast=()) -> DataFrame:
        """The fact; its hot natural keys are looked up first."""
        return build_fact(self.base(), self.dims, self.keyed, broadcast=broadcast,
                          hot=self.hot(broadcast))

    def fact_parts(self, broadcast=()) -> Iterator[DataFrame]:
        """The fact as one frame per part of the clean table."""
        hot = self.hot(broadcast)
        for part in self.parts:
            yield build_fact(fact_base(part, self.dims.values()), self.dims, self.keyed,
                             broadcast=broadcast, hot=hot)


def build_warehouse(spark: SparkSession, raw: DataFrame, root: str,
                    columns: RawColumns = RawColumns(), rules: CleanRules = CleanRules(),
                    partition_by=PARTITION_COLUMNS, broadcast=ALL_DIMENSIONS,
                    keep_keys: bool = False, passes: int = 1) -> Warehouse:
    """Build, check and publish a new version of the warehouse under ``root``.

    With ``passes`` the rows are cleaned and joined a share of the ids at a time, see
    ``session.passes_for``: ``raw`` is read once a pass, shuffle files take a share of the disk.

    ``keep_keys`` takes the rows and keys of the dimensions over from the version that is
    readable now, if there is one, and only adds what is new. Keys that left the warehouse stay
    valid across such builds.
    """
    previous = latest_warehouse(spark, root) if keep_keys else None
    return publish_star(stage_star(raw, root, columns, rules, previous, passes), root,
                        partition_by, broadcast)


def stage_star(raw: DataFrame, root: str, columns: RawColumns = RawColumns(),
               rules: CleanRules = CleanRules(),
               previous: Warehouse | None = None, passes: int = 1) -> StagedStar:
    """Write the cleaned table and the dimensions of a new version.

    Every job that follows reads these tables, so a lost executor costs a re-read and all
    jobs see the same survivors and the same keys.
    """
    return stage_dimensions(stage_clean(raw, root, columns, rules, passes), root, previous)


def stage_clean(raw: DataFrame, root: str, columns: RawColumns = RawColumns(),
                rules: CleanRules = CleanRules(), passes: int = 1) -> StagedClean:
    """Write the cleaned table of a new version and check its ids.

    Each of the ``passes`` cleans the rows of its share of the ids. Copies of an id fall in the
    same pass, so the survivors do not depend on the number of passes.
    """
    spark, version = raw.sparkSession, f"{VERSION_PREFIX}{uuid.uuid4().hex}"
    path = f"{root}/{version}"
    folders = [f"{path}/_stage/clean/{at}" for at in range(passes)]
    with _leased(spark, root, version), released_shuffles(spark):
        counts = added(_clean_share(share_of_ids(raw, columns, at, passes), folder, columns, rules)
                       for at, folder in enumerate(folders))
        schema = clean_records(raw, columns, rules).schema
        clean, *parts = [spark.read.schema(schema).parquet(*paths)
                         for paths in (folders, *zip(folders))]
        if counts["ids_respelled"]:  # else the typed ids are as unique as the texts were
            check_ids(clean)
    return StagedClean(path, clean, tuple(parts), standard_dimensions(rules), counts)


def share_of_ids(raw: DataFrame, columns: RawColumns, at: int, passes: int) -> DataFrame:
    """The raw rows of one of ``passes`` shares of the ids, told by a hash of the text. Where only
    some of the tables under ``raw`` make the id, the optimizer filters those before the joins."""
    if passes == 1:
        return raw
    key = next(source for source, name in columns.names.items() if name == "collision_id")
    return raw.where(F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(passes)) == at)


def _clean_share(raw: DataFrame, path: str, columns: RawColumns,
                 rules: CleanRules) -> dict[str, int]:
    """Write the clean rows of ``raw``; what was observed meanwhile."""
    watch = Watch(raw.sparkSession)
    with watch.running():
        write_table(clean_records(raw, columns, rules, watch), path)
    if watch.is_exact():
        return watch.values()
    # rows before the shuffle may have been counted twice
    return watch.values() | count_keyed(raw, columns)


def stage_dimensions(table: StagedClean, root: str, previous: Warehouse | None = None) -> StagedStar:
    """Write the dimensions of a version whose cleaned table is staged."""
    spark, version = table.clean.sparkSession, table.path.rsplit("/", 1)[-1]
    with _leased(spark, root, version), released_shuffles(spark):
        keyed = build_dimensions(table.clean, table.dims, table.path, previous)
    return StagedStar(table.path, table.clean, table.parts, table.dims, table.counts, keyed)


@contextmanager
def _leased(spark: SparkSession, root: str, version: str):
    """A lease that stays for the steps to follow, unless the block fails."""
    take_lease(spark, root, version)
    try:
        yield
    except BaseException:
        drop_lease(spark, root, version)
        raise


def count_keyed(raw: DataFrame, columns: RawColumns) -> dict[str, int]:
    """What the watch counts before the shuffle, in a pass of its own."""
    metrics = key_metrics("collision_id")
    return rename_raw(raw, columns.names).agg(
        *[metric.alias(name) for name, metric in metrics.items()]).first().asDict()


def check_ids(clean: DataFrame, examples: int = 5) -> None:
    """Stop before the first dimension if typed ids are missing or repeat: the gate would refuse
    the finished build for them."""
    repeated = (clean.groupBy("collision_id").agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1 or collision_id is null"))
    found = repeated.agg(
        F.coalesce(F.sum(F.when(F.col("collision_id").isNull(), F.col("n"))), F.lit(0)).alias("null"),
        F.count("collision_id").alias("repeated")).first()
    if found.null or found.repeated:
        some = [r.collision_id for r in repeated.where("collision_id is not null")
                .orderBy("collision_id").limit(examples).collect()]
        raise GateFailure(f"null_collision_id={found.null}, duplicate_ids={found.repeated}: {some}")


def publish_star(star: StagedStar, root: str, partition_by=PARTITION_COLUMNS,
                 broadcast=ALL_DIMENSIONS) -> Warehouse:
    """Write the fact, check it, and make the version visible.

    An earlier version stays the readable one until the gate has passed.
    ``partition_by=()`` writes the fact unpartitioned. ``broadcast`` names the dimensions that
    may be broadcast; each still has to pass the check of its measured size.
    """
    spark, version = star.clean.sparkSession, star.path.rsplit("/", 1)[-1]
    take_lease(spark, root, version)
    try:
        with released_shuffles(spark):
            published = _gated(star, partition_by, broadcast)
        publish(published, root, version, time.time_ns())
    finally:
        drop_lease(spark, root, version)
    return published


def _gated(star: StagedStar, partition_by, broadcast) -> Warehouse:
    """The fact written and checked, with the audit beside it."""
    spark = star.clean.sparkSession
    metrics = fact_metrics("collision_id", FOREIGN_KEY_ORDER)
    counts = []
    for at, fact in enumerate(star.fact_parts(broadcast)):
        watch = Watch(spark)
        if partition_by:
            # observed behind the rebalancing, in the tasks that write
            fact = rebalanced(fact, partition_by)
        write_table(watch.on(fact, metrics), f"{star.path}/fact_crash",
                    mode="append" if at else "overwrite", partition_by=partition_by)
        counts.append(watch.values())

    found = star.counts | added(counts)
    written = Warehouse(spark, star.path, rows={}, payload_bytes={}).table("fact_crash")
    # answered from the footers of the files
    in_files = written.count()
    if in_files != found["fact_rows"]:
        raise GateFailure(f"the fact files hold {in_files} of {found['fact_rows']} rows")
    if keys_agree(found):  # the ids of the clean table are unique, see check_ids
        observed = integrity_row(found, 0, "collision_id", FOREIGN_KEY_ORDER)
    else:
        observed = fact_integrity(written, star.clean, "collision_id",
                                  FOREIGN_KEY_ORDER).first().asDict()
    rows = {"fact_crash": observed["fact_rows"]} | {n: k.rows for n, k in star.keyed.items()}
    write_audit(spark, star.path, found, observed, rows)
    gate(observed, "collision_id", FOREIGN_KEY_ORDER)

    return Warehouse(spark, star.path, rows=rows, payload_bytes={
        n: k.payload_bytes for n, k in star.keyed.items()})


def write_audit(spark: SparkSession, path: str, counts: dict[str, int],
                integrity: dict[str, int], rows: dict[str, int]) -> None:
    """The counts of a build as ``section``, ``item``, ``observed``, next to its tables. A refused
    build has them too."""
    steps = (("1 missing key", "rows_read", "rows_keyed"),
             ("2 duplicate key", "rows_keyed", "rows_unique"),
             ("3 invalid date", "rows_unique", "base_rows"))
    audit = [(step, item, value) for step, before, after in steps for item, value in (
        ("rows_before", counts[before]), ("rows_removed", counts[before] - counts[after]),
        ("rows_after", counts[after]))]
    audit += [("coordinates", name, counts[name]) for name in COORDINATE_COUNTS]
    audit += [("flags", f"{flag}_rows", counts[f"{flag}_rows"]) for flag in FLAGS]
    audit += [("integrity", name, value) for name, value in integrity.items()]
    audit += [(table, "row_count", count) for table, count in rows.items()]
    spark.createDataFrame(audit, AUDIT).coalesce(1).write.mode("overwrite").json(f"{path}/audit")


def build_dimensions(clean: DataFrame, dims, path: str,
                     previous: Warehouse | None = None) -> dict[str, KeyedTable]:
    """All dimensions, staged and written. They are independent, so their jobs run side by side."""
    def build(dim) -> KeyedTable:
        table = build_dimension(clean, dim, f"{path}/_stage/{dim.name}",
                                previous=previous and previous.dimension(dim.name),
                                broadcast_limit=BROADCAST_LIMIT_BYTES)
        write_table(published_dimension(table.frame, dim), f"{path}/{dim.name}")
        return table

    build = inheritable_thread_target(clean.sparkSession)(build)
    with ThreadPoolExecutor(max_workers=len(dims)) as pool:
        running = {name: pool.submit(build, dim) for name, dim in dims.items()}
        return {name: task.result() for name, task in running.items()}
