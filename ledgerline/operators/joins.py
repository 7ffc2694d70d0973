"""The joins of the star model, with the reporting rules built in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import week_start
from ledgerline.functions.text import split_tags
from ledgerline.model import Columns, reference_date, with_known


def enrich_orders(orders: DataFrame, restaurant: DataFrame, c: Columns = Columns(), *attributes: str) -> DataFrame:
    """Fact with seller attributes; orders without a seller leave (R3).

    Spark broadcasts the dimension when its size allows; beyond that adaptive execution splits the
    partitions of hot sellers, as missing sellers are filtered out before the shuffle.
    """
    dimension = restaurant.select(c.seller, *attributes) if attributes else restaurant
    return with_known(orders, c.seller).join(dimension, c.seller)


def keep_unmatched_orders(orders: DataFrame, restaurant: DataFrame, c: Columns = Columns(), *attributes: str) -> DataFrame:
    """Fact with seller attributes where there are any: the view behind overall figures.

    Orders without a seller bypass the join, so that they do not meet on one reducer.
    """
    dimension = restaurant.select(c.seller, *attributes) if attributes else restaurant
    matched = with_known(orders, c.seller).join(dimension, c.seller, "left")
    return matched.unionByName(orders.where(F.col(c.seller).isNull()), allowMissingColumns=True)


def explode_tags(df: DataFrame, c: Columns = Columns(), name: str = "tag") -> DataFrame:
    """One row per (row, tag) of a delimited list; rows without a list leave."""
    return df.withColumn(name, F.explode(split_tags(F.col(c.tags))))


def rows_without_parent(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-NULL key is unknown to the parent."""
    known = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def rows_with_parent(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    known = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(known, column, "left_semi")


def attach_features(left: DataFrame, right: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Left join of feature tables with one row per key, with defaults for keys the right lacks."""
    return left.join(right, key, "left").fillna(defaults)


def outer_merge(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "full_outer")


def days_before_reference(orders: DataFrame, c: Columns = Columns(), name: str = "days_ago") -> DataFrame:
    """Age of every order in days, counted from the reference date (R2)."""
    return orders.withColumn(name, F.date_diff(reference_date(orders, c), c.day))


def weeks_touched(calendar: DataFrame, day: str, before: int = 1, after: int = 1) -> DataFrame:
    """The Monday weeks that a window of days around an event overlaps.

    Expanding the few days of the calendar and joining on the week is an equi-join, where a
    condition on both ends of the window would compare every event with every week.
    """
    window = F.sequence(F.date_sub(F.col(day), before), F.date_add(F.col(day), after))
    weeks = F.array_distinct(F.transform(window, week_start))
    return calendar.withColumn("week", F.explode(weeks))
