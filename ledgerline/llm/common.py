"""Helpers that several text operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir

ASCII_SPACE = "[\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as compressed Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage where a result is read several times: an executor lost later costs a re-read of
    shared files, never a recomputation with other row ids.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/ledgerline-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True for the fold kept for evaluation: crc32 of the id as text modulo ``folds`` (null id: crc of '')."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text) % folds == fold


def text_function(batches, kind: str):
    """Arrow function over batches of columns, evaluated once for each row.

    It is marked nondeterministic so that the optimiser never copies the costly call, say into a filter.
    """

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from batches(arrays)

    return F.arrow_udf(run, kind).asNondeterministic()


def texts_function(batches, kind: str):
    """The same for a function of several columns."""

    def run(arrays: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        yield from batches(arrays)

    return F.arrow_udf(run, kind).asNondeterministic()


def sha256_text(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
