"""Writers: guarded tables, quarantined rows, flat exports, run metadata and models."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.versions import version_folder


def stored_rows(spark: SparkSession, path: str) -> int | None:
    """Rows stored under a path, or None where there is no table."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException:
        return None


def guard_targets(spark: SparkSession, paths: dict[str, str], reset: bool, must_exist: bool = False) -> None:
    """Refuse to load into tables that hold rows, unless they are to be replaced."""
    guard_rows({name: stored_rows(spark, path) for name, path in paths.items()}, reset, must_exist)


def guard_rows(found: Mapping[str, int | None], reset: bool, must_exist: bool = False) -> None:
    """The same for tables with known numbers of rows, None where there is no table."""
    if must_exist and any(rows is None for rows in found.values()):
        raise RuntimeError(f"missing tables: {[name for name, rows in found.items() if rows is None]}")
    filled = {name: rows for name, rows in found.items() if rows}
    if filled and not reset:
        raise RuntimeError(f"tables are not empty: {filled}; pass reset=True to replace them")


def _write_and_count(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write rows and count them in the tasks that write them, behind every shuffle: a task counts once."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"] or 0


def write_table(df: DataFrame, path: str, reset: bool = False, cluster_by: str | None = None) -> int:
    """Store a table in parallel; returns its number of rows.

    ``cluster_by`` sorts the files by a column, such as the order time, so that a date slicer skips
    most files and row groups by their statistics; it costs one range shuffle.
    """
    if cluster_by:
        df = df.repartitionByRange(cluster_by).sortWithinPartitions(cluster_by)
    return _write_and_count(df, lambda rows: rows.write.mode("overwrite" if reset else "append").parquet(path))


def write_quarantine(
    rejected: DataFrame, path: str, table: str, reason: str = "reject_reason", version: int | None = None
) -> int:
    """Store rejected rows under the table and the foreign key they failed, replacing the last run, or as a version."""
    named = rejected.withColumn("table", F.lit(table)).withColumn("fk_column", F.col(reason))
    folder = f"{path.rstrip('/')}/{table if version is None else version_folder(table, version)}"
    return _write_and_count(
        named, lambda rows: rows.write.mode("overwrite").partitionBy("table", "fk_column").parquet(folder)
    )


def export_csv(df: DataFrame, path: str, order_by: list[str] | None = None, single_file: bool = False) -> None:
    """Flat export with a header; ``single_file`` is for report-sized results only."""
    if order_by:
        df = df.orderBy(*order_by)
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").csv(path, header=True)


def export_run_metadata(spark: SparkSession, path: str, **facts: object) -> None:
    """One JSON record about a run, such as the engine used and its holdout errors."""
    spark.createDataFrame([facts]).coalesce(1).write.mode("overwrite").json(path)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
