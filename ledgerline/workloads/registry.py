"""Registration of queries with the inventory ids they cover and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.workloads.binding import Binding, with_tables


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None, places: int = 4):
    """Register ``fn(binding) -> DataFrame``; doubles are rounded to ``places`` for comparison."""

    def register(fn: Callable[[Binding], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(fn(Binding(spark, folder)), places)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, tuple(covers.split()), run, with_tables(sql) if sql else None)
        return fn

    return register


def portable(df: DataFrame, places: int) -> DataFrame:
    """Plain types that two engines print alike: bigint, rounded double, text, boolean."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(f.dataType, T.DecimalType):
            col = F.round(col.cast("double"), places)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            col = F.round(col, places)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            col = F.array_join(col, "|")
        out.append(col.alias(f.name))
    return df.select(*out)
