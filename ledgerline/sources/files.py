"""CSV reading that survives stray carriage returns, quoted line breaks and mixed encodings."""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.text import normalise_name
from ledgerline.sources.contracts import TableContract
from ledgerline.sources.quoted import ends_inside, read_records

# Cells that a data-frame reader takes as missing.
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
ROW_ORDER = "__row_order"


@dataclass(frozen=True)
class CsvTraits:
    """What one parallel pass over the raw lines tells about a file."""

    valid_utf8: bool
    quoted_line_breaks: bool

    @property
    def encoding(self) -> str:
        return "UTF-8" if self.valid_utf8 else "ISO-8859-1"


def inspect_csv(spark: SparkSession, path: str | list[str]) -> CsvTraits:
    """Check encoding and quoting without parsing, so that parsing stays splittable if it can.

    A file in which no line, taken by itself, ends inside a quoted cell has one record in each line.
    """
    by_file = inspect_csv_files(spark, path)
    return CsvTraits(
        valid_utf8=all(t.valid_utf8 for t in by_file.values()),
        quoted_line_breaks=any(t.quoted_line_breaks for t in by_file.values()),
    )


def inspect_csv_files(spark: SparkSession, path: str | list[str]) -> dict[str, CsvTraits]:
    """The traits of each file that needs care; files that are plain UTF-8 in plain lines are not listed."""
    line = F.col("value")
    marked = (
        spark.read.text(path, lineSep="\n")
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(
            F.count_if(~F.is_valid_utf8(line)).alias("invalid"),
            F.count_if(ends_inside(line, False)).alias("open"),
        )
        .where("invalid > 0 OR open > 0")
        .collect()
    )
    return {_plain(r["file"]): CsvTraits(r["invalid"] == 0, r["open"] > 0) for r in marked}


def _plain(file: str) -> str:
    """One spelling of a local path: listings and file metadata differ in slashes."""
    return re.sub(r"^file:/+", "file:/", file)


def read_csv_robust(
    spark: SparkSession, path: str, row_order: bool = False, traits: CsvTraits | None = None
) -> DataFrame:
    """Read a CSV as text columns.

    Line feeds end records; carriage returns are removed wherever they stand. Text that is not
    UTF-8 is read as Latin-1. Each file is judged on its own: lines of files without quoted line breaks are
    parsed as they come, those of the others on speculation (module ``quoted``); all are read in splits. With ``row_order`` a column gives the position in the input, for
    operators that keep the first of several rows. ``traits`` saves the look at files known to be alike.
    """
    if traits:
        return _read_alike(spark, path, traits, row_order)
    special = inspect_csv_files(spark, path)
    if not special:
        return _read_alike(spark, path, CsvTraits(True, False), row_order)
    groups: dict[CsvTraits, list[str]] = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        groups.setdefault(special.get(_plain(file), CsvTraits(True, False)), []).append(file)
    parts = [_read_alike(spark, files, own, row_order) for own, files in groups.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _read_alike(spark: SparkSession, path: str | list[str], traits: CsvTraits, row_order: bool) -> DataFrame:
    if traits.quoted_line_breaks:
        headers, raw = read_records(spark, path, traits.encoding)
        position = F.struct("file", "block", F.col("place").alias("row"))
    else:
        raw = spark.read.csv(
            path, header=True, lineSep="\n", quote='"', escape='"', encoding=traits.encoding, inferSchema=False
        )
        headers = raw.columns
        raw = raw.toDF(*[f"__c{i}" for i in range(len(headers))])
        position = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
    headers = [h.replace("\r", "").lstrip("\ufeff") for h in headers]
    cells = [_missing_to_null(F.replace(F.col(f"__c{i}"), F.lit("\r"), F.lit(""))).alias(h) for i, h in enumerate(headers)]
    if row_order:
        cells.append(position.alias(ROW_ORDER))
    return raw.select(*cells)


def _missing_to_null(cell: Column) -> Column:
    return F.when(~cell.isin(*MISSING_CELLS), cell)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Read a CSV with inferred types, for profiling a file nobody has described yet."""
    traits = inspect_csv(spark, path)
    return spark.read.csv(
        path,
        header=True,
        inferSchema=True,
        quote='"',
        escape='"',
        encoding=traits.encoding,
        multiLine=traits.quoted_line_breaks,
    )


def normalise_headers(df: DataFrame) -> DataFrame:
    """Lower-case headers with single underscores; a metadata change only."""
    return df.toDF(*[c if c == ROW_ORDER else normalise_name(c) for c in df.columns])


def resolve_columns(df: DataFrame, table: str, contract: TableContract) -> DataFrame:
    """Project accepted headers onto canonical names, before any job runs.

    The first accepted header that exists wins; a column without one is an error that lists the
    headers found; other columns are dropped with a warning.
    """
    present = [c for c in df.columns if c != ROW_ORDER]
    chosen = {name: next((a for a in accepted if a in present), None) for name, accepted in contract.headers.items()}
    unmatched = [name for name, header in chosen.items() if header is None]
    if unmatched:
        raise ValueError(f"{table}: no header for {unmatched}; the file has {sorted(present)}")
    ignored = [c for c in present if c not in chosen.values()]
    if ignored:
        warnings.warn(f"{table}: ignoring columns {ignored}", stacklevel=2)
    order = [F.col(ROW_ORDER)] if ROW_ORDER in df.columns else []
    return df.select(*[F.col(header).alias(name) for name, header in chosen.items()], *order)


def import_tables(spark: SparkSession, paths: dict[str, str]) -> list[str]:
    """Register files as views by name; Parquet unless the path ends in ``.csv``."""
    for name, path in paths.items():
        frame = read_csv_inferred(spark, path) if path.rstrip("/").endswith(".csv") else spark.read.parquet(path)
        frame.createOrReplaceTempView(name)
    return list(paths)


def query(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """SQL text to DataFrame; ``{name}`` in the text refers to a DataFrame passed by that name."""
    return spark.sql(text, **tables) if tables else spark.sql(text)
