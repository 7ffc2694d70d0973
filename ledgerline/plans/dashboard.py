"""The datasets of each dashboard page, all under the same slicers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.model import StarModel, apply_slicers
from ledgerline.operators import basket, measures


def overview_page(model: StarModel, **slicers) -> dict[str, DataFrame]:
    view = apply_slicers(model, **slicers)
    return {
        "cards": measures.headline(view.orders, view.c),
        "rating": measures.average_rating(view.restaurant, view.c),
        "map": measures.seller_rollup(view, view.c.location),
        "monthly": measures.monthly_revenue(view.orders, view.c),
        "rolling": measures.rolling_revenue(view.orders, view.c),
        "repeat": measures.repeat_customers(view.orders, view.c),
    }


def seller_page(model: StarModel, **slicers) -> dict[str, DataFrame]:
    view = apply_slicers(model, **slicers)
    return {
        "top_sellers": measures.top_sellers(view),
        "scatter": measures.seller_scatter(view.restaurant, view.c),
        "by_tags": measures.revenue_by(view, view.c.tags),
        "by_location": measures.seller_rollup(view, view.c.location),
        "top_tags": measures.top_by_revenue_with_ties(view, view.c.tags),
    }


def customer_page(segments: DataFrame, model: StarModel) -> dict[str, DataFrame]:
    return {
        "sizes": measures.segment_sizes(segments),
        "shares": measures.revenue_share_by_segment(segments),
        "top_customers": measures.top_customers(segments, model.users, model.c),
        "repeat": measures.repeat_customers(model.orders, model.c),
    }


def basket_page(rules: DataFrame, model: StarModel, n: int = 15) -> dict[str, DataFrame]:
    return {
        "lift": basket.rule_labels(rules.orderBy(F.desc("lift"), "rule").limit(n)),
        "prices": measures.price_by_group(model.menu, model.c.tags, model.c),
        "rules": rules,
    }


def forecast_page(table: DataFrame, festivals: DataFrame) -> dict[str, DataFrame]:
    return {
        "line": table,
        "festivals": festivals,
        "cards": measures.last_known(table, "week", ["actual_revenue", "forecast"]),
    }
