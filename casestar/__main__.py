"""Command line: land a raw file, build a warehouse, answer the questions, clean up.

    python -m casestar land SOURCE RAW_ZONE
    python -m casestar build RAW_ZONE WAREHOUSE
    python -m casestar answer WAREHOUSE FOLDER
    python -m casestar sweep WAREHOUSE [--keep N] [--lease-hours H] [--dry-run]
"""

from __future__ import annotations

import argparse

from casestar.config import PARTITION_COLUMNS
from casestar.plans.answers import publish_answers
from casestar.plans.etl import build_warehouse
from casestar.plans.ingest import ingest_checked, size_shuffles
from casestar.session import get_session
from casestar.sources.readers import read_raw_csv
from casestar.sources.retention import LEASE_HOURS, sweep
from casestar.sources.warehouse import open_warehouse


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="casestar")
    parser.add_argument("--master", help="left to spark-submit if not given")
    steps = parser.add_subparsers(dest="step", required=True)
    for step, source, target in (("land", "source", "raw_zone"), ("build", "raw_zone", "warehouse"),
                                 ("answer", "warehouse", "folder")):
        command = steps.add_parser(step)
        command.add_argument(source)
        command.add_argument(target)
        if step == "build":
            command.add_argument("--flat", action="store_true", help="do not partition the fact")
            command.add_argument("--keep-keys", action="store_true",
                                 help="take dimension keys over from the readable version")
            command.add_argument("--audit", action="store_true", help="show what the build counted")
    command = steps.add_parser("sweep", help="remove versions that nobody can open any more")
    command.add_argument("source", metavar="warehouse")
    command.add_argument("--keep", type=int, default=1, help="published versions that stay")
    command.add_argument("--lease-hours", type=float, default=LEASE_HOURS)
    command.add_argument("--dry-run", action="store_true")
    options = parser.parse_args(arguments)
    spark = get_session(master=options.master)
    if options.step == "land":
        size_shuffles(spark, options.source)
        for table in ingest_checked(spark, options.source, options.raw_zone):
            table.show(truncate=False)
    elif options.step == "build":
        size_shuffles(spark, options.raw_zone)
        raw = read_raw_csv(spark, options.raw_zone)
        built = build_warehouse(spark, raw, options.warehouse,
                                partition_by=() if options.flat else PARTITION_COLUMNS,
                                keep_keys=options.keep_keys)
        if options.audit:
            built.audit().show(100, truncate=False)
    elif options.step == "sweep":
        for item in sweep(spark, options.source, options.keep, options.lease_hours,
                          options.dry_run):
            print(f"{item.path}: {item.reason}")
    else:
        publish_answers(open_warehouse(spark, options.warehouse), options.folder)


if __name__ == "__main__":
    main()
