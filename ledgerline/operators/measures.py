"""KPI measures under the reporting rules.

A measure is a column expression, so it means the same thing in any grouping. Rollups by a seller
attribute aggregate the fact per seller first: what is shuffled and joined is then one row per seller
and task, which removes hot sellers and keeps the list explosion off the fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.numeric import month_start, share
from ledgerline.model import Columns, StarModel, with_known
from ledgerline.operators.calendar import date_dimension
from ledgerline.operators.joins import explode_tags
from ledgerline.operators.ranking import quantiles
from ledgerline.session import freeze


def total_revenue(c: Columns = Columns()) -> Column:
    return F.sum(c.base_amount)


def total_orders() -> Column:
    return F.count(F.lit(1))


def base_orders(c: Columns = Columns()) -> Column:
    return F.count_if(c.in_base)


def average_order_value(c: Columns = Columns()) -> Column:
    """Base revenue over base orders, blank without any."""
    return share(total_revenue(c), base_orders(c))


def latest_data_date(c: Columns = Columns()) -> Column:
    return F.date_add(F.max(c.day), 1)


def average_rating(restaurant: DataFrame, c: Columns = Columns()) -> DataFrame:
    """Average over sellers, not weighted by orders."""
    return restaurant.agg(F.avg(F.col(c.rating).cast("double")).alias("avg_rating"))


def headline(orders: DataFrame, c: Columns = Columns()) -> DataFrame:
    """The overview cards in one scan."""
    return orders.agg(
        total_revenue(c).alias("total_revenue"),
        total_orders().alias("total_orders"),
        base_orders(c).alias("base_orders"),
        average_order_value(c).alias("avg_order_value"),
        latest_data_date(c).alias("latest_data_date"),
    )


def currency_split(orders: DataFrame, c: Columns = Columns()) -> DataFrame:
    """Orders and money per currency: what R1 leaves out is still measured."""
    return orders.groupBy(c.currency).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(c.amount).alias("amount")
    ).withColumn("is_base", F.coalesce(c.in_base, F.lit(False)))


def daily_revenue(orders: DataFrame, c: Columns = Columns()) -> DataFrame:
    return orders.groupBy(c.day.alias("day")).agg(
        F.coalesce(total_revenue(c), F.lit(0)).alias("revenue"), total_orders().alias("orders")
    )


def monthly_revenue(orders: DataFrame, c: Columns = Columns()) -> DataFrame:
    return orders.groupBy(month_start(F.col(c.time)).alias("month")).agg(
        total_revenue(c).alias("revenue"), total_orders().alias("orders")
    )


def rolling_revenue(orders: DataFrame, c: Columns = Columns(), days: int = 30) -> DataFrame:
    """Revenue of the last ``days`` calendar days up to each calendar day, that day included.

    The fact is aggregated to days once; the window then runs over a table no longer than the
    calendar, which also has the days without an order.
    """
    daily = freeze(daily_revenue(orders.where(F.col(c.time).isNotNull()), c))
    calendar = date_dimension(daily, "day").select(F.col("date").alias("day"))
    frame = Window.orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    return (
        calendar.join(daily, "day", "left")
        .select("day", F.coalesce("revenue", F.lit(0)).alias("revenue"))
        .withColumn("rolling_revenue", F.sum("revenue").over(frame))
    )


def year_over_year(orders: DataFrame, c: Columns = Columns()) -> DataFrame:
    """Monthly revenue against the same month a year before; NULL, not 0, without a prior month."""
    monthly = freeze(monthly_revenue(orders.where(F.col(c.time).isNotNull()), c).select("month", "revenue"))
    prior = monthly.select(F.add_months("month", 12).alias("month"), F.col("revenue").alias("prior_revenue"))
    return monthly.join(prior, "month", "left").withColumn(
        "growth", share(F.col("revenue") - F.col("prior_revenue"), F.col("prior_revenue"))
    )


def year_over_year_daily(orders: DataFrame, c: Columns = Columns()) -> DataFrame:
    """Daily revenue against the same date a year before; 29 February has no such date."""
    daily = freeze(daily_revenue(orders.where(F.col(c.time).isNotNull()), c).select("day", "revenue"))
    prior = (
        daily.where(~((F.month("day") == 2) & (F.dayofmonth("day") == 29)))
        .select(F.add_months("day", 12).alias("day"), F.col("revenue").alias("prior_revenue"))
    )
    return daily.join(prior, "day", "left").withColumn(
        "growth", share(F.col("revenue") - F.col("prior_revenue"), F.col("prior_revenue"))
    )


def repeat_customers(orders: DataFrame, c: Columns = Columns(), include_null_group: bool = False) -> DataFrame:
    """Customers with more than one order, their rate and the one-time share.

    Counting orders per customer combines on the map side. ``include_null_group`` counts orders
    without a customer as one customer, as a BI tool would.
    """
    base = orders if include_null_group else with_known(orders, c.user)
    per_user = base.groupBy(c.user).agg(F.count(F.lit(1)).alias("orders"))
    repeat_rate = share(F.count_if(F.col("orders") > 1), F.count(F.lit(1)))
    return per_user.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("orders") > 1).alias("repeat_customers"),
        repeat_rate.alias("repeat_rate"),
        (F.lit(1.0) - repeat_rate).alias("one_time_share"),
    )


def seller_totals(orders: DataFrame, c: Columns = Columns()) -> DataFrame:
    """One row per known seller: the common input of every seller rollup."""
    return with_known(orders, c.seller).groupBy(c.seller).agg(
        F.count(F.lit(1)).alias("orders"),
        base_orders(c).alias("base_orders"),
        total_revenue(c).alias("revenue"),
    )


def sellers_by_orders(orders: DataFrame, restaurant: DataFrame, c: Columns = Columns(), *attributes: str) -> DataFrame:
    """Seller attributes with ``n``, the orders of each seller: stands for the joined order rows."""
    counted = with_known(orders, c.seller).groupBy(c.seller).agg(F.count(F.lit(1)).alias("n"))
    return restaurant.select(c.seller, *attributes).join(counted, c.seller)


def seller_rollup(model: StarModel, by: str) -> DataFrame:
    """Revenue, orders and average seller rating by a seller attribute."""
    c = model.c
    sellers = model.restaurant.select(*dict.fromkeys([c.seller, by, c.rating]))
    return (
        sellers.join(seller_totals(model.orders, c), c.seller, "left")
        .groupBy(by)
        .agg(
            F.sum("revenue").alias("revenue"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
            F.avg(F.col(c.rating).cast("double")).alias("avg_rating"),
        )
    )


def revenue_by(model: StarModel, by: str) -> DataFrame:
    """Base revenue by a seller attribute, with its share of the whole rollup."""
    c = model.c
    totals = seller_totals(model.orders, c)
    grouped = (
        model.restaurant.select(c.seller, by).join(totals, c.seller).groupBy(by).agg(F.sum("revenue").alias("revenue"))
    )
    return with_share(grouped, "revenue")


def with_share(grouped: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Each row's part of the column total, which is a scalar and not a one-partition window.

    The grouped table is frozen, so that finding its total does not scan the fact a second time.
    """
    grouped = freeze(grouped)
    whole = grouped.agg(F.sum(value).alias("whole")).scalar()
    return grouped.withColumn(name, share(F.col(value), whole))


def top_by_revenue_with_ties(model: StarModel, by: str) -> DataFrame:
    """The best group by revenue; equal winners are joined into one text."""
    totals = model.restaurant.select(model.c.seller, by).join(seller_totals(model.orders, model.c), model.c.seller)
    grouped = freeze(totals.where(F.col(by).isNotNull()).groupBy(by).agg(F.sum("revenue").alias("revenue")))
    best = grouped.agg(F.max("revenue").alias("best")).scalar()
    winners = grouped.where(F.col("revenue") == best)
    return winners.agg(
        F.array_join(F.sort_array(F.collect_list(by)), ", ").alias("top_group"), F.max("revenue").alias("revenue")
    )


def top_sellers(model: StarModel, n: int = 20) -> DataFrame:
    """Best sellers by revenue, grouped by name as a report shows them."""
    c = model.c
    named = model.restaurant.select(c.seller, c.seller_name).join(seller_totals(model.orders, c), c.seller)
    return (
        named.groupBy(c.seller_name)
        .agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
        .orderBy(F.desc_nulls_last("revenue"), c.seller_name)
        .limit(n)
    )


def order_value_by_tag(model: StarModel, n: int | None = 12) -> DataFrame:
    """Average base order value and orders per tag; an order counts under each of its tags.

    The average is over orders with an amount; orders without one are counted as orders only.
    """
    c = model.c
    base = with_known(model.orders.where(c.in_base), c.seller)
    totals = base.groupBy(c.seller).agg(
        F.count(F.lit(1)).alias("orders"), F.count(c.amount).alias("valued"), F.sum(c.amount).alias("revenue")
    )
    tagged = explode_tags(model.restaurant.select(c.seller, c.tags).join(totals, c.seller), c)
    grouped = tagged.groupBy("tag").agg(
        F.round(share(F.sum("revenue"), F.sum("valued")), 2).alias("aov"), F.sum("orders").alias("orders")
    )
    return grouped.orderBy(F.desc_nulls_first("aov"), "tag").limit(n) if n else grouped


def price_by_group(menu: DataFrame, by: str, c: Columns = Columns()) -> DataFrame:
    """Mean and exact median price per group."""
    means = menu.groupBy(by).agg(
        F.avg(F.col(c.price).cast("double")).alias("avg_price"), F.count(c.price).alias("items")
    )
    medians = quantiles(menu, c.price, (0.5,), by=[by]).withColumnRenamed("q0", "median_price")
    return means.join(medians, by, "left")


def seller_scatter(restaurant: DataFrame, c: Columns = Columns(), cost_limit: float | None = 3000) -> DataFrame:
    """Cost, rating and popularity per seller, without sellers that lack either axis."""
    cost = F.least(F.col(c.cost), F.lit(cost_limit)) if cost_limit is not None else F.col(c.cost)
    return restaurant.dropna(subset=[c.rating, c.cost]).select(
        c.seller, c.seller_name, cost.alias("cost"), c.rating, c.ratings
    )


def segment_sizes(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count(F.lit(1)).alias("customers")).orderBy(F.desc("customers"), "segment")


def revenue_share_by_segment(segments: DataFrame) -> DataFrame:
    """Revenue per customer segment and its share with the segment filter removed."""
    grouped = segments.groupBy("segment").agg(F.sum("monetary").alias("revenue"))
    return with_share(grouped, "revenue")


def top_customers(segments: DataFrame, users: DataFrame, c: Columns = Columns(), n: int = 20) -> DataFrame:
    """Best customers by money, with segment and frequency.

    The top rows are taken first, so that only they are joined to the customers.
    """
    best = segments.orderBy(F.desc("monetary"), c.user).limit(n)
    named = users.select(c.user, "name").join(F.broadcast(best), c.user)
    return named.select(c.user, "name", "segment", "monetary", "frequency").orderBy(F.desc("monetary"), c.user)


def last_known(df: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """The latest non-NULL value of each column, for 'last week' cards."""
    return df.agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"last_{c}") for c in columns]
    )
