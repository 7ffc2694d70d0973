"""Exploratory aggregates: distributions, correlations, cross-tabulations, location profiles."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import share
from ledgerline.model import Columns, StarModel
from ledgerline.operators.measures import sellers_by_orders
from ledgerline.operators.ranking import quantiles
from ledgerline.session import freeze


def histogram(
    df: DataFrame,
    value: str | Column,
    bins: int = 20,
    clip: tuple[float, float] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Equal-width bins from minimum to maximum with the last bin closed; empty bins are listed.

    The input is scanned once, to count its values; range and bins come from the counts.
    """
    number = (F.col(value) if isinstance(value, str) else value).cast("double")
    if clip:
        number = F.when(number.isNotNull(), F.least(F.greatest(number, F.lit(float(clip[0]))), F.lit(float(clip[1]))))
    rows = F.col(weight) if weight else F.lit(1).cast("bigint")
    numbers = df.select(number.alias("value"), rows.alias("n")).where("value is not null")
    numbers = freeze(numbers.groupBy("value").agg(F.sum("n").alias("n")))
    span = numbers.agg(F.min("value").alias("low"), F.max("value").alias("high")).first()
    if span["low"] is None:
        raise ValueError("no values to bin")
    low, high = span["low"], span["high"]
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    slot = F.least(F.floor((F.col("value") - F.lit(low)) * F.lit(bins) / F.lit(high - low)), F.lit(bins - 1))
    counts = numbers.groupBy(slot.cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, over the rows where both are known: one aggregation."""
    numbers = {c: F.col(c).cast("double") for c in columns}
    known = {c: F.when(~F.isnan(n), n) for c, n in numbers.items()}
    pairs = [(x, y) for i, x in enumerate(columns) for y in columns[i + 1 :]]
    row = df.select(*[known[c].alias(c) for c in columns]).agg(
        *[F.corr(x, y).alias(f"{x}|{y}") for x, y in pairs], *[F.count(c).alias(f"n|{c}") for c in columns]
    )
    cells = []
    for x, y in product(columns, columns):
        if x == y:
            value = F.when(F.col(f"n|{x}") > 1, F.lit(1.0))
        else:
            value = F.col(f"{x}|{y}" if (x, y) in pairs else f"{y}|{x}")
        cells.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), value.alias("r")))
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Mean, exact median and sample deviation of a column."""
    moments = df.agg(
        F.avg(F.col(column).cast("double")).alias("mean"), F.stddev_samp(F.col(column).cast("double")).alias("std")
    )
    return moments.withColumn("median", quantiles(df, column, (0.5,)).select("q0").scalar())


def location_profile(model: StarModel, min_sellers: int = 20) -> DataFrame:
    """Order-weighted cost and rating, and sellers, per location with enough sellers.

    Sellers without a cost or without a rating are left out. Orders are counted per seller first, so the
    means are weighted sums over sellers.
    """
    c = model.c
    joined = sellers_by_orders(model.orders.where(c.in_base), model.restaurant, c, c.location, c.cost, c.rating)
    joined = joined.dropna(subset=[c.cost, c.rating])

    def weighted(column: str) -> Column:
        return share(F.sum(F.col(column) * F.col("n")), F.sum("n"))

    grouped = (
        joined.where(F.col(c.location).isNotNull())
        .groupBy(c.location)
        .agg(weighted(c.cost).alias("avg_cost"), weighted(c.rating).alias("avg_rating"), F.count(F.lit(1)).alias("sellers"))
        .where(F.col("sellers") >= min_sellers)
    )
    grouped = freeze(grouped)
    largest = grouped.agg(F.max("sellers").alias("most")).scalar()
    return grouped.withColumn("bubble", share(F.col("sellers"), largest))


def top_locations(profile: DataFrame, c: Columns = Columns(), n: int = 6) -> DataFrame:
    return profile.orderBy(F.desc("sellers"), c.location).limit(n)


def count_distinct_by(df: DataFrame, by: Sequence[str], column: str, name: str, approx: bool = False) -> DataFrame:
    counter = F.approx_count_distinct if approx else F.count_distinct
    return df.groupBy(*by).agg(counter(column).alias(name))


def crosstab_share(df: DataFrame, row: str, column: str, places: int = 2) -> DataFrame:
    """Share of each column value within a row value, in long form."""
    counts = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.groupBy(row).agg(F.sum("n").alias("row_n"))
    return counts.join(whole, row).select(
        row, column, "n", F.bround(share(F.col("n"), F.col("row_n")), places).alias("share")
    )


def presence_matrix(df: DataFrame, row: str, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """One boolean column per value, all that occur unless listed; a report shape, baskets stay arrays.

    The values become columns, so they must be few: a catalog's tags, not its items.
    """
    if values is None:
        values = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).collect()]
    return df.groupBy(row).agg(*[F.max(F.col(column) == F.lit(v)).alias(f"has_{v}") for v in values])


def segment_profile(df: DataFrame, by: str, means: Sequence[str], places: int = 1) -> DataFrame:
    """Group sizes and rounded means."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("customers"),
        *[F.bround(F.avg(F.col(m).cast("double")), places).alias(f"avg_{m}") for m in means],
    )
