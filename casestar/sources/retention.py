"""Which versions of a warehouse stay: mark what is published or being built, sweep the rest.

A build holds a lease, a file named after its version, from before its folder exists until it is
published or refused. A build that died leaves a lease that runs out.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from casestar.sources.warehouse import MANIFEST

VERSION_PREFIX = "v-"
LEASES, STAGE = "_building", "_stage"
LEASE_HOURS = 24.0


@dataclass(frozen=True)
class Removed:
    path: str
    reason: str


class _Files:
    """The file system of a path, as the session reaches it."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def listed(self, folder: str) -> dict[str, float]:
        """Names in a folder with the seconds at which they were last changed."""
        if not self._system.exists(self._path(folder)):
            return {}
        return {entry.getPath().getName(): entry.getModificationTime() / 1000
                for entry in self._system.listStatus(self._path(folder))}

    def put(self, path: str) -> None:
        self._system.create(self._path(path), True).close()

    def remove(self, path: str) -> bool:
        return self._system.delete(self._path(path), True)

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))


def take_lease(spark: SparkSession, root: str, version: str) -> None:
    """Say that a version is being built; taking it again renews it."""
    _Files(spark, root).put(f"{root}/{LEASES}/{version}")


def drop_lease(spark: SparkSession, root: str, version: str) -> None:
    _Files(spark, root).remove(f"{root}/{LEASES}/{version}")


def sweep(spark: SparkSession, root: str, keep: int = 1, lease_hours: float = LEASE_HOURS,
          dry_run: bool = False) -> list[Removed]:
    """Remove version folders that are neither among the last ``keep`` published ones nor leased,
    the ``_stage`` folders of the published ones that stay, and leases that have run out.

    Folders are listed before leases and leases before the manifest: a build that begins
    meanwhile is not on the list, and one that is published meanwhile still has its lease or is
    in the manifest already. Choose ``lease_hours`` longer than a build takes, and ``keep`` so
    that readers of an older version are done. ``dry_run`` only tells what would go.
    """
    if keep < 1:
        raise ValueError("the readable version stays: keep at least 1")
    files = _Files(spark, root)
    folders = [name for name in files.listed(root) if name.startswith(VERSION_PREFIX)]
    now = time.time()
    leases = files.listed(f"{root}/{LEASES}")
    running = {name for name, at in leases.items() if now - at < lease_hours * 3600}
    published = published_versions(spark, root)
    kept = set(published[:keep])

    found = []
    for name in sorted(folders):
        if name in running:
            continue
        if name not in kept:
            reason = "superseded" if name in published else "never published"
            found.append(Removed(f"{root}/{name}", reason))
        elif files.exists(f"{root}/{name}/{STAGE}"):
            found.append(Removed(f"{root}/{name}/{STAGE}", "staging of a published version"))
    found += [Removed(f"{root}/{LEASES}/{name}", "lease has run out")
              for name in sorted(set(leases) - running)]
    if not dry_run:
        for item in found:
            files.remove(item.path)
    return found


def published_versions(spark: SparkSession, root: str) -> list[str]:
    """Versions in the manifest, the one published last first."""
    try:
        entries = spark.read.schema(MANIFEST).json(f"{root}/manifest")
        # one row per published version
        return [row.version for row in entries.groupBy("version").agg(
            F.max("published_at").alias("at")).orderBy(F.desc("at"), F.desc("version")).collect()]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
