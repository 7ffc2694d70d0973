"""Date tables, gap filling, and the festival calendar."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.numeric import week_start
from ledgerline.model import Columns
from ledgerline.session import freeze

# Festival dates by year.
FESTIVALS: dict[str, tuple[str, ...]] = {
    "diwali": ("2017-10-19", "2018-11-07", "2019-10-27", "2020-11-14"),
    "holi": ("2017-03-13", "2018-03-02", "2019-03-21", "2020-03-10"),
}


def date_dimension(df: DataFrame, *dates: str) -> DataFrame:
    """One row per day of every calendar year that the given date columns touch."""
    first = F.least(*[F.min(d) for d in dates]) if len(dates) > 1 else F.min(dates[0])
    last = F.greatest(*[F.max(d) for d in dates]) if len(dates) > 1 else F.max(dates[0])
    span = df.agg(
        F.to_date(F.trunc(F.to_date(first), "year")).alias("first"),
        F.date_sub(F.add_months(F.trunc(F.to_date(last), "year"), 12), 1).alias("last"),
    )
    days = span.where(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last")).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day_of_month"),
        week_start(F.col("date")).alias("week"),
    )


def spine(df: DataFrame, column: str, step_days: int = 1) -> DataFrame:
    """Every date from the first to the last, at a regular step."""
    span = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    step = F.expr(f"interval {step_days} days")
    return span.where(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last", step)).alias(column))


def fill_gaps(df: DataFrame, column: str, step_days: int = 1, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Reindex a series to a regular grid; missing rows are NULL or take a default.

    ``df`` has one row per step. It is frozen, since both its span and its rows are needed.
    """
    df = freeze(df)
    filled = spine(df, column, step_days).join(df, column, "left")
    return filled.fillna(dict(defaults)) if defaults else filled


def orders_per_day(orders: DataFrame, c: Columns = Columns()) -> DataFrame:
    daily = orders.where(F.col(c.time).isNotNull()).groupBy(c.day.alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    return fill_gaps(daily, "day", 1, {"orders": 0})


def weekly_revenue(orders: DataFrame, c: Columns = Columns(), by: Sequence[str | Column] = ()) -> DataFrame:
    """Base revenue per Monday week, for the whole business or per series key."""
    return (
        orders.where(c.in_base)
        .groupBy(*by, week_start(F.col(c.time)).alias("week"))
        .agg(F.sum(c.amount).cast("double").alias("revenue"))
    )


def series_extent(series: DataFrame, column: str = "week") -> DataFrame:
    return series.agg(
        F.count(F.lit(1)).alias("weeks"), F.min(column).alias("first_week"), F.max(column).alias("last_week")
    )


def festival_calendar(
    spark: SparkSession, festivals: Mapping[str, Sequence[str]] | None = None, before: int = 1, after: int = 1
) -> DataFrame:
    """Festival dates with the window of days around each that it is felt."""
    rows = [(name, day) for name, days in (festivals or FESTIVALS).items() for day in days]
    dates = spark.createDataFrame(rows, "festival string, day string").select(
        "festival", F.to_date("day").alias("date")
    )
    return dates.select(
        "festival",
        "date",
        F.date_sub("date", before).alias("window_start"),
        F.date_add("date", after).alias("window_end"),
    )


def festivals_in_range(festivals: DataFrame, series: DataFrame, column: str = "week", horizon_weeks: int = 12) -> DataFrame:
    """Festivals from the first date of a series to its last one plus the forecast horizon."""
    first = series.agg(F.min(column).alias("first")).scalar()
    last = series.agg(F.date_add(F.max(column), 7 * horizon_weeks).alias("last")).scalar()
    return festivals.where((F.col("date") >= first) & (F.col("date") <= last)).select("festival", "date")
