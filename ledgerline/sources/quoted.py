"""CSV files whose quoted cells hold line breaks, read by many tasks.

Whether a line begins inside a quoted cell depends on all lines before it, so each line is parsed on speculation,
from both beginnings. What a line, or a split of lines, does to the beginning is a function of two states, and
such functions combine: splits are worked off side by side, their functions are combined in the order of the
file, and then every split knows how it begins. A split's lines up to its first true record border belong to the
last record of a split before it.

Lines that are records of their own go straight to the parser; only lines of records with line breaks are
gathered, by the place where their record begins.
"""

from __future__ import annotations

import csv
import io
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir

# Bytes of a record above which a quote must have been left open.
MOST_RECORD = 1 << 27
# Lines of a split that are worked off together, as a power of two: parts of a split go to tasks of their own.
PART_BITS = 14


def ends_inside(line: Column, begins_inside: bool) -> Column:
    """Whether a line ends inside a quoted cell: the parser's states at each quote (0 outside, 1 inside, 2 at a closing quote)."""

    def at_quote(state: Column, part: Column) -> Column:
        empty, border = part["text"] == "", part["text"].endswith(",")
        # A cell opens with a quote right after a border; two quotes in a row inside a cell are one character.
        return (
            F.when(state == 1, F.lit(2))
            .when((state == 2) & (empty | border), F.lit(1))
            .when((state == 0) & (border | (empty & part["first"])), F.lit(1))
            .otherwise(F.lit(0))
        )

    parts = F.split(line, '"', -1)
    before_quotes = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda text, i: F.struct(text.alias("text"), (i == 0).alias("first")))
    state = F.aggregate(before_quotes, F.lit(int(begins_inside)), at_quote)
    # Most lines with quotes have one quoted cell: two quotes need no steps. A quote stands at a border or behind another.
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    first, second = F.substring_index(line, '"', 1), F.substring_index(line, '"', 2)
    opens = second.endswith(",")
    two = opens | second.endswith('"') if begins_inside else opens & (first != "") & ~first.endswith(",")
    return F.when(~line.contains('"'), F.lit(begins_inside)).when(quotes == 2, two).otherwise(state == 1)


def _begins(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Add ``b0`` and ``b1``: whether a row begins inside a cell if its group begins outside, or inside.

    A row is a function ``e0``, ``e1`` of its beginning. The last row before that ends alike either way decides,
    and each row since then that turns one into the other.
    """
    ahead = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(F.when(F.col("e0") & ~F.col("e1"), 1).otherwise(0)).over(ahead), F.lit(0))
    fixed = F.last(F.when(F.col("e0") == F.col("e1"), F.struct("e0", "turned")), ignorenulls=True).over(ahead)
    begun = df.withColumn("turned", turned).withColumn("fixed", fixed)
    since = (F.col("turned") - F.col("fixed.turned")) % 2 == 1
    odd = F.col("turned") % 2 == 1
    decided = F.when(F.col("fixed").isNotNull(), F.col("fixed.e0") != since)
    return begun.withColumn("b0", F.coalesce(decided, odd)).withColumn("b1", F.coalesce(decided, ~odd)).drop("turned", "fixed")


def _after(begins: Column) -> Column:
    return F.when(begins, F.col("e1")).otherwise(F.col("e0"))


def lines_of(spark: SparkSession, paths: str | list[str], encoding: str) -> DataFrame:
    """(file, block, part, place, line, b0, b1, e0, e1) of every line, on shared disk.

    Splits and places are given in one job and written, since another job may cut the files otherwise.
    """
    raw = spark.read.text(paths, lineSep="\n")
    text = F.col("value") if encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    line = F.replace(text, F.lit("\r"), F.lit(""))
    read = raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), line.alias("line"),
    )
    marked = F.when((F.col("block") == 0) & F.col("line").startswith("﻿"), F.expr("substr(line, 2)")).otherwise(F.col("line"))
    # The lower 33 bits of a place number the rows of a task, in which the lines of a split stand in a row.
    part = F.shiftright(F.col("place").bitwiseAND(F.lit((1 << 33) - 1)), PART_BITS)
    read = read.withColumn("line", marked).withColumn("part", part)
    read = read.withColumn("e0", ends_inside(F.col("line"), False)).withColumn("e1", ends_inside(F.col("line"), True))
    folder = f"{ensure_checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    _begins(read, ["file", "block", "part"], "place").write.option("compression", "zstd").parquet(folder)
    return spark.read.parquet(folder)


def records_of(lines: DataFrame, most_bytes: int = MOST_RECORD) -> DataFrame:
    """(file, block, place, record): whole records, blank ones left out, at the place of their first line."""
    ends = F.max_by(F.struct(_after(F.col("b0")).alias("e0"), _after(F.col("b1")).alias("e1")), "place").alias("e")
    parts_of = ["file", "block", "part"]
    blocks = _begins(lines.groupBy(*parts_of).agg(ends).select(*parts_of, "e.*"), ["file"], "block", "part")
    # One row for each part of a split goes to every task; lines stay where they are.
    known = lines.join(F.broadcast(blocks.select(*parts_of, F.col("b0").alias("inside"))), parts_of)
    begins = F.when(F.col("inside"), F.col("b1")).otherwise(F.col("b0"))
    known = known.withColumn("begins", begins).withColumn("ends", _after(F.col("begins")))
    whole = known.where("NOT begins AND NOT ends AND trim(line) <> ''").select("file", "block", "place", F.col("line").alias("record"))

    parts = known.where("begins OR ends").select(*parts_of, "place", "line", "begins")
    at = F.when(~F.col("begins"), F.struct("block", "place"))
    so_far = Window.partitionBy(*parts_of).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    last = parts.groupBy(*parts_of).agg(F.max(at).alias("last"))
    carried = last.select(*parts_of, F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    owned = parts.withColumn("own", F.last(at, ignorenulls=True).over(so_far)).join(F.broadcast(carried), parts_of)
    owned = owned.withColumn("start", F.coalesce("own", "carried"))
    longest = owned.groupBy("file", "start").agg(F.sum(F.octet_length("line") + 1).alias("n")).agg(F.max(F.struct("n", "file"))).first()[0]
    if longest and longest["n"] > most_bytes:
        raise ValueError(f"{longest['file']}: a record of {longest['n']} bytes; a quote is left open")
    gathered = F.array_sort(F.collect_list(F.struct("block", "place", "line")))
    joined = owned.groupBy("file", "start").agg(F.array_join(F.transform(gathered, lambda p: p["line"]), "\n").alias("record"))
    return whole.unionByName(joined.select("file", "start.block", "start.place", "record"))


def cell_names(header: str) -> list[str]:
    """Names of the cells of a header record; missing ones by their number, repeated ones with it."""
    cells = next(csv.reader(io.StringIO(header, newline="")), [])
    return [c if c and cells.count(c) == 1 else f"{c or '_c'}{i}" for i, c in enumerate(cells)]


def read_records(spark: SparkSession, paths: str | list[str], encoding: str = "UTF-8") -> tuple[list[str], DataFrame]:
    """(header names, cells): text cells ``__c0``, ``__c1``, ... of every record with its ``file``, ``block`` and ``place``.

    Every file has a header, its first record; the names are those of the first file.
    """
    records = records_of(lines_of(spark, paths, encoding))
    headers = records.groupBy("file").agg(F.min(F.struct("block", "place", "record")).alias("h"))
    first = headers.orderBy("file").first()
    if first is None:
        return [], spark.createDataFrame([], "file string, block long, place long")
    names = cell_names(first["h"]["record"])
    # A header has no cells to the parser, so that no condition on the cells is ever tried on it.
    places = F.broadcast(headers.select("file", "h.block", "h.place", F.lit(True).alias("header")))
    marked = records.join(places, ["file", "block", "place"], "left")
    kind = ", ".join(f"__c{i} string" for i in range(len(names)))
    text = F.when(F.col("header").isNull(), F.col("record"))
    cells = F.from_csv(text, kind, {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})
    rows = marked.withColumn("c", cells).where("header IS NULL")
    return names, rows.select("file", "block", "place", "c.*")
