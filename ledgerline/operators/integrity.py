"""Referential integrity: orphans, coverage, declared constraints and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import broadcast_if_small, freeze
from ledgerline.sources.contracts import ForeignKey, TableContract, spark_type


# Orphan keys up to this many go to every task; rows stay where they are then.
FEW_ORPHANS = 200_000


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct non-NULL child keys without a parent.

    Keys are made distinct before the join, so a key held by a third of the rows moves once.
    """
    keys = child.select(F.col(column).alias("__key")).where("__key is not null").distinct()
    return keys.join(parent.select(F.col(parent_column).alias("__key")), "__key", "left_anti")


def mark_orphans(
    child: DataFrame,
    foreign_keys: Sequence[ForeignKey],
    parents: Mapping[str, DataFrame],
    reason: str = "reject_reason",
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Add the first foreign key a row fails, in the declared order, or NULL.

    Rows are matched against the orphan keys only, which are few in any healthy load and then broadcast; a
    foreign key without any costs nothing. A missing key is no orphan, so such rows get a key of their own for
    the join and cannot meet on one reducer. ``keys_from`` is a cheaper table with the same keys.
    """
    marked = child.withColumn(reason, F.lit(None).cast("string"))
    for fk in foreign_keys:
        missing = freeze(orphan_keys(keys_from or child, fk.column, parents[fk.parent], fk.parent_column))
        if missing.isEmpty():
            continue
        missing = broadcast_if_small(missing.select(F.col("__key").cast("string").alias("__orphan")), FEW_ORPHANS)
        spread = F.concat(F.lit("no key "), F.xxhash64(*[F.col(f"`{c}`") for c in child.columns]).cast("string"))
        keyed = marked.withColumn("__key", F.coalesce(F.col(fk.column).cast("string"), spread))
        marked = (
            keyed.join(missing, keyed["__key"] == missing["__orphan"], "left")
            .withColumn(reason, F.coalesce(F.col(reason), F.when(F.col("__orphan").isNotNull(), F.lit(fk.column))))
            .drop("__orphan", "__key")
        )
    return marked.select(*child.columns, reason)


def split_orphans(marked: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(rows to keep, rows to quarantine)."""
    return marked.where(F.col(reason).isNull()).drop(reason), marked.where(F.col(reason).isNotNull())


def null_key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a missing foreign key; they stay in the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "fk_column", "null_rows")


def orphan_counts(
    tables: Mapping[str, DataFrame], checks: Sequence[tuple[str, ForeignKey]]
) -> DataFrame:
    """Rows per (table, foreign key) whose key has no parent; every count should be 0.

    A child is scanned once for all its keys, which are counted before they meet their parents, so a
    key held by a third of the rows moves as one row per task.
    """
    used, known = None, None
    for child in dict.fromkeys(table for table, _ in checks):
        keys = F.array(
            *[
                F.struct(F.lit(fk.column).alias("fk_column"), F.col(fk.column).cast("string").alias("key"))
                for table, fk in checks
                if table == child
            ]
        )
        counted = (
            tables[child]
            .select(F.lit(child).alias("child"), F.explode(keys).alias("k"))
            .select("child", "k.*")
            .groupBy("child", "fk_column", "key")
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        used = counted if used is None else used.unionByName(counted)
    for table, fk in checks:
        parent = tables[fk.parent].select(
            F.lit(table).alias("child"), F.lit(fk.column).alias("fk_column"),
            F.col(fk.parent_column).cast("string").alias("key"), F.lit(True).alias("known"),
        )
        known = parent if known is None else known.unionByName(parent)
    matched = used.join(known.distinct(), ["child", "fk_column", "key"], "left")
    orphan = F.col("key").isNotNull() & F.col("known").isNull()
    counts = matched.groupBy("child", "fk_column").agg(
        F.sum(F.when(orphan, F.col("rows")).otherwise(0)).alias("orphans")
    )
    listed = used.sparkSession.createDataFrame(
        [(table, fk.column) for table, fk in checks], "child string, fk_column string"
    )
    return listed.join(counts, ["child", "fk_column"], "left").fillna({"orphans": 0})


def never_listed(catalog: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """Catalog rows, and how many of them are ``NOT IN`` the listing.

    As in SQL, nothing is provably absent from a listing that contains a NULL key, and a NULL
    catalog key is absent from an empty listing only.
    """
    keys = freeze(listing.select(key).distinct())
    listed = keys.where(F.col(key).isNotNull()).withColumn("__listed", F.lit(True))
    shape = keys.agg(
        F.struct(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls"))
    ).scalar()
    flagged = catalog.join(listed, key, "left")
    absent = (
        F.when(F.col("rows") == 0, F.col("total_items"))
        .when(F.col("nulls") > 0, F.lit(0))
        .otherwise(F.col("unmatched"))
    )
    return (
        flagged.agg(
            F.count(F.lit(1)).alias("total_items"),
            F.count_if(F.col(key).isNotNull() & F.col("__listed").isNull()).alias("unmatched"),
        )
        .withColumn("shape", shape)
        .select("total_items", "unmatched", "shape.*")
        .select("total_items", absent.cast("bigint").alias("never_listed"))
    )


def constraint_violations(
    name: str, df: DataFrame, contract: TableContract, parents: Mapping[str, DataFrame]
) -> DataFrame:
    """One row per declared rule with the number of rows that break it.

    All column rules share one scan; the key rule and each foreign key aggregate on their key.
    """
    rules = []
    for column, declared in contract.types.items():
        value = F.col(column)
        if column in contract.key or column == contract.surrogate:
            rules.append((f"not null {column}", F.count_if(value.isNull())))
        if declared.startswith("varchar"):
            limit = int(declared[8:-1])
            rules.append((f"length {column} <= {limit}", F.count_if(F.length(value) > limit)))
        elif declared.startswith(("decimal", "int", "smallint")):
            unfit = value.isNotNull() & value.try_cast(spark_type(declared)).isNull()
            rules.append((f"range {column} {declared}", F.count_if(unfit)))
    row = df.agg(*[agg.alias(f"r{i}") for i, (_, agg) in enumerate(rules)])
    checked = row.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
                    for i, (rule, _) in enumerate(rules)
                ]
            )
        ).alias("v")
    ).select(F.lit(name).alias("table"), "v.rule", "v.violations")
    if contract.key:
        repeated = df.groupBy(*contract.key).agg((F.count(F.lit(1)) - 1).alias("extra"))
        checked = checked.unionByName(
            repeated.agg(
                F.lit(name).alias("table"),
                F.lit("unique " + ", ".join(contract.key)).alias("rule"),
                F.coalesce(F.sum("extra"), F.lit(0)).cast("bigint").alias("violations"),
            )
        )
    if contract.foreign_keys:
        labels = F.create_map(
            *[F.lit(x) for fk in contract.foreign_keys for x in (fk.column, f"references {fk.column} -> {fk.parent}")]
        )
        counted = orphan_counts({name: df, **parents}, [(name, fk) for fk in contract.foreign_keys])
        checked = checked.unionByName(
            counted.select(
                F.col("child").alias("table"),
                F.element_at(labels, F.col("fk_column")).alias("rule"),
                F.col("orphans").alias("violations"),
            )
        )
    return checked


def reconcile_counts(expected: Mapping[str, int], stored: Mapping[str, DataFrame]) -> DataFrame:
    """Expected and stored rows per table, with a verdict; see ``require_reconciled``."""
    out = None
    for name, rows in expected.items():
        line = stored[name].agg(
            F.lit(name).alias("table"), F.lit(rows).cast("bigint").alias("expected"), F.count(F.lit(1)).alias("stored")
        )
        out = line if out is None else out.unionByName(line)
    return out.withColumn("ok", F.col("expected") == F.col("stored"))


def require_reconciled(report: DataFrame) -> None:
    wrong = [r["table"] for r in report.where(~F.col("ok")).collect()]
    if wrong:
        raise AssertionError(f"stored rows differ from loaded rows in {wrong}")
