"""The star model that operators work on: names of columns, reporting rules and filters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Columns:
    """Column names of the fact and of the dimension it is rolled up by."""

    user: str = "user_id"
    seller: str = "restaurant_id"
    time: str = "order_datetime"
    amount: str = "sales_amount"
    currency: str = "currency"
    quantity: str = "quantity"
    seller_name: str = "name"
    location: str = "location"
    tags: str = "cuisine"
    rating: str = "rating"
    ratings: str = "num_ratings"
    cost: str = "cost_for_two"
    item: str = "food_id"
    price: str = "price"
    base_currency: str = "INR"

    @property
    def in_base(self) -> Column:
        """R1: headline money counts the base currency only."""
        return F.col(self.currency) == F.lit(self.base_currency)

    @property
    def base_amount(self) -> Column:
        return F.when(self.in_base, F.col(self.amount))

    @property
    def day(self) -> Column:
        return F.to_date(F.col(self.time))


@dataclass(frozen=True)
class StarModel:
    """One fact, two dimensions, a catalog and a bridge."""

    orders: DataFrame
    restaurant: DataFrame
    users: DataFrame | None = None
    food: DataFrame | None = None
    menu: DataFrame | None = None
    c: Columns = field(default_factory=Columns)

    def register(self, prefix: str = "") -> list[str]:
        """S11: expose every table to ``spark.sql`` under its name."""
        names = []
        for name in ("orders", "restaurant", "users", "food", "menu"):
            table = getattr(self, name)
            if table is not None:
                table.createOrReplaceTempView(prefix + name)
                names.append(prefix + name)
        return names


def reference_date(orders: DataFrame, c: Columns) -> Column:
    """R2: 'today' is the day after the last day in the data, as a scalar subquery."""
    return orders.agg(F.date_add(F.max(c.day), 1).alias("reference_date")).scalar()


def base_currency_only(orders: DataFrame, c: Columns) -> DataFrame:
    """R1 as a filter; it reaches the scan."""
    return orders.where(c.in_base)


def with_known(orders: DataFrame, *keys: str) -> DataFrame:
    """R3: rows with a missing key leave rollups by that key (and never reach its shuffle)."""
    for key in keys:
        orders = orders.where(F.col(key).isNotNull())
    return orders


def apply_slicers(
    model: StarModel,
    location: Sequence[str] | None = None,
    tags: Sequence[str] | None = None,
    date_from: date | str | None = None,
    date_to: date | str | None = None,
) -> StarModel:
    """Restrict a model the way dashboard slicers do.

    Date bounds become predicates on the raw timestamp, so that the scan can prune by them; a
    seller slicer keeps the orders and menu rows of the remaining sellers (rows without a seller
    match none of them).
    """
    c = model.c
    orders, restaurant, menu = model.orders, model.restaurant, model.menu
    if date_from is not None:
        orders = orders.where(F.col(c.time) >= F.lit(str(_day(date_from))).cast("timestamp_ntz"))
    if date_to is not None:
        upper = F.date_add(F.lit(str(_day(date_to))).cast("date"), 1).cast("timestamp_ntz")
        orders = orders.where(F.col(c.time) < upper)
    if location is not None:
        restaurant = restaurant.where(F.col(c.location).isin(list(location)))
    if tags is not None:
        restaurant = restaurant.where(F.col(c.tags).isin(list(tags)))
    if location is not None or tags is not None:
        kept = restaurant.select(c.seller)
        orders = with_known(orders, c.seller).join(kept, c.seller, "left_semi")
        menu = menu.join(kept, c.seller, "left_semi") if menu is not None else None
    return replace(model, orders=orders, restaurant=restaurant, menu=menu)


def _day(value: date | str) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)
