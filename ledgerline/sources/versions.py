"""Tables that change together or not at all.

A load writes every table into a folder of its own version; nobody reads it yet. One small manifest, written last,
names the folders that are current, and it appears at once or not at all. Readers go through the manifest, so
they see the state before a load or after it, never between two tables. A load that ends before its manifest
leaves folders that no manifest names; the next load removes them and takes the same number.

The version before the current one is kept, so that readers who opened it can finish. One load at a time may
write to a target; of two that try the same version, only one can publish it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS = "_manifests"
_SCHEMA = "tables array<struct<name:string,folder:string,rows:bigint>>"


@dataclass(frozen=True)
class Manifest:
    """The current version: the folder of each table, relative to the target, and its rows."""

    version: int
    folders: Mapping[str, str]
    rows: Mapping[str, int]


def version_folder(name: str, version: int) -> str:
    return f"{name}/version={version}"


def current(spark: SparkSession, target: str) -> Manifest | None:
    """The manifest of the newest published version, None before the first."""
    manifests = spark.read.schema(f"{_SCHEMA}, version bigint")
    try:
        newest = manifests.json(f"{target}/{MANIFESTS}").orderBy(F.desc("version")).first()
    except AnalysisException:
        return None
    if newest is None:
        return None
    tables = newest["tables"]
    return Manifest(newest["version"], {t["name"]: t["folder"] for t in tables}, {t["name"]: t["rows"] for t in tables})


def open_tables(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """All tables of the current version; they stay what they are while later versions are written."""
    manifest = current(spark, target)
    folders = manifest.folders if manifest else {}
    return {name: spark.read.parquet(f"{target}/{folder}") for name, folder in folders.items()}


def publish(spark: SparkSession, target: str, version: int, rows: Mapping[str, int]) -> Manifest:
    """Make a version current. Writing the same version twice is an error, so two loads cannot both succeed."""
    tables = [(name, version_folder(name, version), n) for name, n in rows.items()]
    line = spark.createDataFrame([(tables,)], _SCHEMA)
    line.coalesce(1).write.mode("errorifexists").json(f"{target}/{MANIFESTS}/version={version}")
    return Manifest(version, {name: folder for name, folder, _ in tables}, dict(rows))


def clean(spark: SparkSession, target: str, names: list[str], keep: int = 1) -> list[str]:
    """Remove what the current version and the ``keep`` versions before it do not name; returns what went.

    That is older versions, and whatever a load that was never published has left behind.
    """
    manifest = current(spark, target)
    newest = manifest.version if manifest else 0
    kept = {f"version={v}" for v in range(max(1, newest - keep), newest + 1)}
    gone = []
    for folder in [MANIFESTS, *names]:
        files, children = _children(spark, f"{target}/{folder}")
        for child in children:
            if child.getName() not in kept:
                files.delete(child, True)
                gone.append(f"{folder}/{child.getName()}")
    return gone


def files_without_version(spark: SparkSession, target: str, name: str) -> list[str]:
    """Data files of a table that stand in the target itself, from before it had versions."""
    _, children = _children(spark, f"{target}/{name}")
    return [c.toString() for c in children if not c.getName().startswith((".", "_", "version="))]


def _children(spark: SparkSession, folder: str):
    """(file system, paths in a folder, none if there is no such folder)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    place = path(folder)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files, [s.getPath() for s in files.listStatus(place)] if files.exists(place) else []
