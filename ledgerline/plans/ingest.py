"""Load untidy CSVs into clean Parquet tables, with quarantine, reconciliation and a strict gate."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.operators.cleaning import (
    add_surrogate_key, chosen_readings, keep_first, quality_measures, reading_columns, reading_measures, type_columns,
)
from ledgerline.operators.integrity import (
    mark_orphans, null_key_counts, orphan_counts, reconcile_counts, require_reconciled, split_orphans,
)
from ledgerline.session import compiled_methods, ensure_checkpoint_dir, freeze
from ledgerline.sources import versions
from ledgerline.sources.contracts import CONTRACTS, LOAD_ORDER, TableContract, spark_type
from ledgerline.sources.files import ROW_ORDER, CsvTraits, normalise_headers, read_csv_robust, resolve_columns
from ledgerline.sources.sinks import guard_rows, write_quarantine, write_table

QUARANTINE = "_quarantine"


class CleaningRequired(RuntimeError):
    """Raised under ``strict`` when any value was coerced, or any row dropped or quarantined."""


@dataclass
class LoadReport:
    """What a load did, per table."""

    read: dict[str, int] = field(default_factory=dict)
    coerced: dict[str, int] = field(default_factory=dict)
    negative: dict[str, int] = field(default_factory=dict)
    deduplicated: dict[str, int] = field(default_factory=dict)
    quarantined: dict[str, int] = field(default_factory=dict)
    stored: dict[str, int] = field(default_factory=dict)

    def table(self, spark: SparkSession) -> DataFrame:
        columns = ("read", "coerced", "negative", "deduplicated", "quarantined", "stored")
        rows = [(t, *[int(getattr(self, c).get(t, 0)) for c in columns]) for t in self.read]
        return spark.createDataFrame(rows, "table string, " + ", ".join(f"{c} bigint" for c in columns))

    @property
    def cleaned(self) -> bool:
        return any(sum(d.values()) for d in (self.coerced, self.deduplicated, self.quarantined))


def prepare_table(
    name: str, raw: DataFrame, contract: TableContract, parents: Mapping[str, DataFrame], report: LoadReport
) -> tuple[DataFrame, DataFrame]:
    """(rows to store, rows to quarantine) of one table; fills the report.

    The typed rows are written once, as compressed columns, and counted while they are written: files are
    parsed once, dates under both readings, and every count describes what is stored.
    """
    typed = type_columns(resolve_columns(normalise_headers(raw), name, contract), contract, both_readings=True)
    order = [ROW_ORDER] if contract.key else []
    staged = f"{ensure_checkpoint_dir(raw.sparkSession)}/typed-{name}-{uuid.uuid4().hex}"
    seen = Observation()
    measures = quality_measures(typed, contract) | reading_measures(contract)
    counted = typed.observe(seen, *[c.alias(n) for n, c in measures.items()])
    counted.select(*contract.headers, *reading_columns(contract), *order).write.option("compression", "zstd").parquet(staged)
    counts = {measure: n or 0 for measure, n in seen.get.items()}
    report.read[name] = counts["rows"]
    report.coerced[name] = sum(n for measure, n in counts.items() if measure.startswith("lost_"))
    report.negative[name] = sum(n for measure, n in counts.items() if measure.startswith("negative_"))
    rows = chosen_readings(raw.sparkSession.read.parquet(staged), contract, counts)
    rows = number_splits(rows) if contract.key else rows.withColumn(ROW_ORDER, F.monotonically_increasing_id())
    if contract.key and {fk.column for fk in contract.foreign_keys} <= {*contract.key}:
        # All rows of a key have the same foreign keys, so rows to keep and rows to reject part before they are gathered.
        marked = mark_orphans(rows, contract.foreign_keys, parents, keys_from=rows)
        kept, rejected = (keep_first(part, contract.key, [ROW_ORDER]) for part in split_orphans(marked))
    else:
        first = keep_first(rows, contract.key, [ROW_ORDER]) if contract.key else rows
        kept, rejected = split_orphans(mark_orphans(first, contract.foreign_keys, parents, keys_from=rows))
    kept = kept.drop(ROW_ORDER)
    if contract.surrogate:
        kept = add_surrogate_key(freeze(kept), contract.surrogate, dense=True)
    surrogate = [contract.surrogate] if contract.surrogate else []
    return kept.select(*surrogate, *contract.headers), rejected.drop(ROW_ORDER)


def number_splits(rows: DataFrame) -> DataFrame:
    """The same row order as one number: the place of a split among all, and the row in it. File names take no part in sorting."""
    split = [F.col(f"{ROW_ORDER}.file").alias("__file"), F.col(f"{ROW_ORDER}.block").alias("__block")]
    # One row for each split, whatever the size of the data.
    place = F.row_number().over(Window.orderBy("__file", "__block")).cast("bigint")
    places = freeze(rows.select(*split).distinct().withColumn("__place", place))
    row = F.col(f"{ROW_ORDER}.row").bitwiseAND(F.lit((1 << 33) - 1))
    located = rows.select("*", *split).join(F.broadcast(places), ["__file", "__block"])
    return located.withColumn(ROW_ORDER, F.shiftleft("__place", 33) + row).drop("__file", "__block", "__place")


def load(
    spark: SparkSession,
    sources: Mapping[str, str],
    target: str,
    reset: bool = False,
    strict: bool = False,
    contracts: Mapping[str, TableContract] = CONTRACTS,
    order: Sequence[str] = LOAD_ORDER,
    cluster_by: Mapping[str, str] | None = None,
    traits: Mapping[str, CsvTraits] | None = None,
    must_exist: bool = False,
) -> LoadReport:
    """Load every table, parents first, prove that what is stored is what was loaded, then publish all at once.

    Until then, and if anything fails before, readers of the target (``versions.open_tables``) keep the state
    they had. ``must_exist`` asks for tables made by ``create_tables`` or an earlier load.
    ``cluster_by`` names a column per table to sort its files by, for pruning. ``traits`` spares the
    look at encoding and quoting of files for which they are known.
    """
    target = target.rstrip("/")
    before = versions.current(spark, target)
    guard_rows({name: _rows_before(spark, target, name, before) for name in order}, reset, must_exist)
    version = before.version + 1 if before else 1
    paths = {name: f"{target}/{versions.version_folder(name, version)}" for name in order}
    kept_apart = [f"{QUARANTINE}/{name}" for name in order if contracts[name].foreign_keys]
    if before:
        versions.clean(spark, target, [*order, *kept_apart])
    report, parents, expected = LoadReport(), {}, {}
    # Repairing the cells of a row takes more generated code than fits one compiled method.
    with compiled_methods(spark):
        for name in order:
            contract = contracts[name]
            raw = read_csv_robust(spark, sources[name], row_order=bool(contract.key), traits=(traits or {}).get(name))
            kept, rejected = prepare_table(name, raw, contract, parents, report)
            expected[name] = write_table(kept, paths[name], True, (cluster_by or {}).get(name))
            report.quarantined[name] = 0
            if contract.foreign_keys:
                report.quarantined[name] = write_quarantine(rejected, f"{target}/{QUARANTINE}", name, version=version)
            report.deduplicated[name] = report.read[name] - expected[name] - report.quarantined[name]
            parents[name] = spark.read.parquet(paths[name])
    check = freeze(reconcile_counts(expected, parents))
    report.stored = {r["table"]: r["stored"] for r in check.collect()}
    require_reconciled(check)
    versions.publish(spark, target, version, expected)
    versions.clean(spark, target, [*order, *kept_apart])
    if strict and report.cleaned:
        raise CleaningRequired(f"strict load had to clean: {report}")
    return report


def _rows_before(spark: SparkSession, target: str, name: str, before: versions.Manifest | None) -> int | None:
    """Rows of a table before a load: by the manifest, else in files that stand in the target without one."""
    if before:
        return before.rows.get(name)
    plain = versions.files_without_version(spark, target, name)
    return spark.read.parquet(*plain).count() if plain else None


def create_tables(
    spark: SparkSession, target: str, contracts: Mapping[str, TableContract] = CONTRACTS, order: Sequence[str] = LOAD_ORDER
) -> None:
    """Publish empty tables with the declared columns, for loads that must find their tables."""
    target = target.rstrip("/")
    if versions.current(spark, target):
        raise RuntimeError(f"{target} has tables already")
    for name in order:
        contract = contracts[name]
        surrogate = [f"`{contract.surrogate}` bigint"] if contract.surrogate else []
        kinds = ", ".join([*surrogate, *[f"`{c}` {spark_type(contract.types[c])}" for c in contract.headers]])
        write_table(spark.createDataFrame([], kinds), f"{target}/{versions.version_folder(name, 1)}", True)
    versions.publish(spark, target, 1, dict.fromkeys(order, 0))


def integrity_report(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, TableContract] = CONTRACTS
) -> tuple[DataFrame, DataFrame]:
    """(orphans per foreign key, orders rows per missing key) of stored tables."""
    checks = [(name, fk) for name in tables for fk in contracts[name].foreign_keys]
    missing = null_key_counts(tables["orders"], [fk.column for fk in contracts["orders"].foreign_keys])
    return orphan_counts(tables, checks), missing
