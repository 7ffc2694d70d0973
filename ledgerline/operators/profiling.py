"""Table profiles: shapes, NULLs, distinct values, samples, join keys and distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import normalise_name, shorten
from ledgerline.operators.ranking import quantiles
from ledgerline.sources.contracts import ForeignKey


# Characters of a value that a sample shows.
SHOWN = 25


def _present(field) -> Column:
    """A column with NaN as NULL and one zero, the way distinct values are counted."""
    col = F.col(f"`{field.name}`")
    if field.dataType.simpleString() in ("double", "float"):
        return F.when(F.isnan(col), None).when(col == 0, F.lit(0.0)).otherwise(col)
    return col


def _text(field) -> Column:
    return _present(field).cast("string")


def _key_text(field) -> Column:
    """What tells a value from every other one of its column: itself where its text does no more, else its text."""
    plain = isinstance(field.dataType, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampNTZType))
    return _present(field) if plain else _text(field)


def _cell(field) -> list[Column]:
    """Two independent 64-bit hashes that stand for a value of any length, NULL for NULL."""
    value = _key_text(field)
    return [F.when(value.isNotNull(), F.xxhash64(F.lit(seed), value)).alias(name) for seed, name in ((1, "one"), (2, "two"))]


def _typed(col: Column, kind: T.DataType) -> Column:
    """A value whose hash tells it from every other one of its type: one zero, one NaN, NULL inside it marked.

    Plain types stay as they are; nested values, whose NULLs a hash passes over, become text that marks them.
    """
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(col), F.lit(float("nan")).cast(kind)).when(col == 0, F.lit(0.0).cast(kind)).otherwise(col)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return _written(col, kind)
    return col


def _written(col: Column, kind: T.DataType) -> Column:
    """Text of a nested value: lengths before parts, so that no two values are written alike."""

    def part(text: Column) -> Column:
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))

    if isinstance(kind, T.StructType):
        text = F.concat(F.lit("{"), *[part(_written(col.getField(f.name), f.dataType)) for f in kind.fields])
    elif isinstance(kind, T.ArrayType):
        text = F.array_join(F.transform(col, lambda x: part(_written(x, kind.elementType))), ",")
    elif isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(col), lambda e: F.concat(part(_written(e["key"], kind.keyType)), part(_written(e["value"], kind.valueType))))
        text = F.array_join(F.array_sort(entries), ",")
    elif isinstance(kind, T.BinaryType):
        return F.hex(col)
    elif isinstance(kind, T.TimestampType):
        # An instant, which local time does not name for certain.
        return F.unix_micros(col).cast("string")
    else:
        return _typed(col, kind).cast("string")
    return F.when(col.isNotNull(), text)


def row_hash(fields: Sequence[T.StructField]) -> list[Column]:
    """Two independent 64-bit hashes of the typed columns of a row, NULL marked apart in each column."""
    cells = [c for f in fields for c in (_typed(F.col(f"`{f.name}`"), f.dataType), F.col(f"`{f.name}`").isNull())]
    return [F.xxhash64(F.lit(seed), *cells) for seed in (1, 2)]


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """Rows, columns, missing cells and repeated rows.

    Rows are told apart by a wide hash of their typed values, which moves instead of the row, with a map-side count.
    """
    fields = df.schema.fields
    missing = sum((F.when(_present(f).isNull(), 1).otherwise(0) for f in fields), F.lit(0))
    one, two = row_hash(fields)
    grouped = df.select(one.alias("__one"), two.alias("__two"), missing.alias("__cells")).groupBy("__one", "__two").agg(
        F.count(F.lit(1)).alias("__copies"), F.sum("__cells").alias("__missing")
    )
    return grouped.agg(
        F.lit(table).alias("table"),
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("rows"),
        F.lit(len(fields)).cast("bigint").alias("columns"),
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum("__missing"), F.lit(0)).alias("null_cells"),
    )


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, samples: int = 5, order_by: str | None = None,
    approx: bool = False,
) -> DataFrame:
    """Per column: type, filled and missing cells, distinct values and a few sample values.

    Cells are counted per (column, wide hash of the value) first: one shuffle with map-side counts, whatever
    the number of columns and the length of their values. Of a value only the start that a sample shows
    travels, as part of the key: counts then are the only state of a group, which fits a hash table, and no task
    sorts its cells. Samples are the smallest distinct values, or the first ones by ``order_by``; without
    ``samples`` no value travels. ``approx`` estimates distinct values in one aggregation and takes no samples.
    """
    fields = [f for f in df.schema.fields if f.name != order_by and (columns is None or f.name in columns)]
    names = F.array(*[F.lit(f.name) for f in fields])
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in fields])
    if approx:
        measures = [F.struct(F.count(_present(f)).alias("non_null"), F.approx_count_distinct(_key_text(f)).alias("distinct_values")) for f in fields]
        whole = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*measures).alias("m")).where("rows > 0")
        summary, counted = whole.select("rows", F.posexplode("m").alias("column", "m")).select("column", "rows", "m.*"), None
    else:
        start = [lambda f: F.substring(_text(f), 1, SHOWN + 1).alias("value")] if samples else []
        cells = F.array(*[F.struct(F.lit(i).alias("column"), *_cell(f), *[s(f) for s in start]) for i, f in enumerate(fields)])
        long = df.select(F.explode(cells).alias("c"), *([F.col(order_by).alias("__at")] if order_by else []))
        first_seen = [F.min("__at").alias("__at")] if order_by else []
        key = ["column", "one", "two", *(["value"] if samples else [])]
        counted = long.select("c.*", *(["__at"] if order_by else [])).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.count("one").alias("filled"), *first_seen)
        # Both readers of the counts use all their columns, so they share one scan and one shuffle.
        used = ["value"] if samples else []
        summary = counted.groupBy("column").agg(
            F.sum("n").alias("rows"),
            F.sum("filled").alias("non_null"),
            F.count("one").alias("distinct_values"),
            F.count("two").alias("cells"),
            *[F.count(c).alias("values") for c in used],
            *first_seen,
        ).where(" AND ".join(["cells >= 0", *["values >= 0" for _ in used], *["(__at IS NULL OR __at IS NOT NULL)" for _ in first_seen]]))
    out = summary.select(
        "column",
        types[F.col("column")].alias("dtype"),
        "non_null",
        (F.col("rows") - F.col("non_null")).alias("nulls"),
        (F.try_divide(F.col("rows") - F.col("non_null"), F.col("rows")) * 100).alias("null_pct"),
        "distinct_values",
    )
    if counted is None or not samples:
        return out.withColumn("column", names[F.col("column")])
    # A rank filter is applied per task before the shuffle, so at most `samples` rows per column move.
    first = Window.partitionBy("column").orderBy(*(["__at"] if order_by else []), "value", "one", "two")
    picked = (
        counted.where("filled > 0 AND n > 0")
        .withColumn("__rank", F.row_number().over(first))
        .where(F.col("__rank") <= samples)
        .groupBy("column")
        .agg(F.array_sort(F.collect_list(F.struct("__rank", shorten(F.col("value"), SHOWN).alias("value")))).alias("s"))
        .select("column", F.array_join(F.col("s.value"), ", ").alias("sample_values"))
    )
    return out.join(picked, "column", "left").withColumn("column", names[F.col("column")])


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 3) -> DataFrame:
    return df.orderBy(*order_by).limit(rows)


def inclusion(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct child values, and how many of them the parent has."""
    values = child.select(F.col(column).alias("__key")).where("__key is not null").distinct()
    known = parent.select(F.col(parent_column).alias("__key")).where("__key is not null").distinct()
    matched = values.join(known.withColumn("__hit", F.lit(1)), "__key", "left")
    return matched.agg(F.count(F.lit(1)).alias("child_values"), F.count("__hit").alias("matched_values"))


def candidate_join_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of one normalised name in several tables, with the overlap of their values.

    Names come from the schemas alone; only real pairs are joined, on distinct values.
    """
    owners: dict[str, list[tuple[str, str]]] = {}
    for table, df in tables.items():
        for column in df.columns:
            owners.setdefault(normalise_name(column), []).append((table, column))
    out = None
    for name, places in sorted(owners.items()):
        for (left, left_column), (right, right_column) in combinations(sorted(places), 2):
            pair = inclusion(tables[left], left_column, tables[right], right_column).select(
                F.lit(name).alias("column"),
                F.lit(left).alias("left_table"),
                F.lit(right).alias("right_table"),
                F.col("child_values").alias("left_values"),
                F.col("matched_values").alias("shared_values"),
            )
            out = pair if out is None else out.unionByName(pair)
    if out is None:
        raise ValueError("no column name appears in more than one table")
    return out


def foreign_key_checklist(
    tables: Mapping[str, DataFrame], expected: Sequence[tuple[str, ForeignKey]]
) -> DataFrame:
    """Per expected key: are both columns there, and what share of child values has a parent."""
    out = None
    for table, fk in expected:
        present = fk.column in tables[table].columns and fk.parent_column in tables[fk.parent].columns
        label = f"{table}.{fk.column} -> {fk.parent}.{fk.parent_column}"
        if present:
            line = inclusion(tables[table], fk.column, tables[fk.parent], fk.parent_column)
        else:
            line = tables[table].limit(0).agg(
                F.lit(None).cast("bigint").alias("child_values"), F.lit(None).cast("bigint").alias("matched_values")
            )
        line = line.select(
            F.lit(label).alias("foreign_key"),
            F.lit(present).alias("present"),
            "child_values",
            "matched_values",
            F.try_divide(F.col("matched_values").cast("double"), F.col("child_values")).alias("inclusion"),
        )
        out = line if out is None else out.unionByName(line)
    return out


def describe(df: DataFrame, columns: Sequence[str], places: int = 1) -> DataFrame:
    """Count, mean, spread, exact quartiles and extremes: one row per column."""
    moments = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.stddev_samp(F.col(c).cast("double")).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    long = moments.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("m")) for c in columns])).alias("x")
    ).select("x.column", "x.m.*")
    values = df.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
            )
        ).alias("x")
    ).select("x.*")
    quartiles = quantiles(values, "value", (0.25, 0.5, 0.75), by=["column"])
    joined = long.join(quartiles, "column", "left")
    rounded = {"mean": "mean", "std": "std", "min": "min", "q0": "q25", "q1": "q50", "q2": "q75", "max": "max"}
    return joined.select("column", "count", *[F.bround(F.col(k), places).alias(v) for k, v in rounded.items()])


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), column)
