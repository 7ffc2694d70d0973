"""Session settings and the few physical helpers that operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENGINE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.checkpoint.compress": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Adaptive execution merges small shuffle partitions at run time but never makes more, so a cluster starts
# from an upper bound. A session built elsewhere should set the same.
CLUSTER_CONF = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000"}

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def build_session(app: str = "ledgerline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = (master or "").startswith("local")
    for key, value in {**ENGINE_CONF, **({} if local else CLUSTER_CONF), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; only a local session may fall back to a temporary one."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="ledgerline-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def freeze(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there afterwards.

    Used where several passes must see the same partitions or the same rows: an executor lost
    between two passes costs a re-read, never a different answer.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Within, rows of wide projections run in methods that the JVM compiles: it interprets any above 8,000 bytes.

    Spark then splits the expressions of such a stage instead of fusing them into one method. Same results.
    """
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, "8000")
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def code_border(df: DataFrame) -> DataFrame:
    """The same rows; Spark generates the code before and behind apart. Each part may then be fused and still be compiled.

    A count is observed here and nobody reads it: of what passes rows on, it is the cheapest that ends a fused stage.
    """
    return df.observe(f"border-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Hint a broadcast only after checking the row count; above the bound Spark shuffles.

    ``df`` should be frozen or a cheap scan, since checking it runs one bounded job.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
