"""The flat tables behind a dashboard: segments with clusters, rules, forecast, festivals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.model import StarModel
from ledgerline.operators import basket, calendar, clustering, forecast, rfm
from ledgerline.session import freeze
from ledgerline.sources.sinks import export_csv, export_run_metadata


@dataclass(frozen=True)
class Exports:
    segments: DataFrame
    sweep: DataFrame
    rules: DataFrame
    forecast: DataFrame
    errors: DataFrame
    festivals: DataFrame


def clustered_segments(
    model: StarModel, ks: Sequence[int] = clustering.K_RANGE, n_init: int = clustering.RESTARTS
) -> tuple[DataFrame, DataFrame]:
    """(scored customers with rule segment and cluster, silhouette per k)."""
    c = model.c
    scored = rfm.rfm_segments(model.orders, c)
    scaled = freeze(rfm.scale_features(scored))
    columns = [f"{f}_z" for f in rfm.FEATURES]
    sweep = clustering.sweep_k(scaled, c.user, columns, ks, n_init)
    labelled = clustering.assign_clusters(scaled, columns, sweep.models[sweep.best_k], "monetary")
    return labelled.drop(*columns), sweep.table(scaled)


def build_exports(
    model: StarModel,
    ks: Sequence[int] = clustering.K_RANGE,
    n_init: int = clustering.RESTARTS,
    min_support: float = basket.MIN_SUPPORT,
    rules: int = 50,
    by: str | None = None,
    method: str = "seasonal",
    holdout_weeks: int = forecast.HOLDOUT_WEEKS,
    drop_partial_last_week: bool = False,
    basket_key: str | None = None,
) -> Exports:
    """All tables of the export; ``basket_key`` names another basket than all orders of a customer."""
    segments, sweep = clustered_segments(model, ks, n_init)
    baskets = basket.build_baskets(basket.tag_pairs(model, basket_key))
    itemsets = basket.frequent_itemsets(baskets, min_support)
    series = freeze(
        forecast.weekly_series(model.orders, model.c, by, drop_partial_last_week=drop_partial_last_week)
    )
    kept_back = forecast.holdout(series, holdout_weeks)
    train, test = forecast.split_holdout(series, kept_back)
    predicted = freeze(forecast.forecast_series(train, kept_back, method))
    festivals = calendar.festival_calendar(series.sparkSession)
    return Exports(
        segments=segments,
        sweep=sweep,
        rules=basket.top_rules(basket.association_rules(itemsets), rules),
        forecast=forecast.forecast_table(series, predicted, kept_back),
        errors=forecast.holdout_errors(test, predicted),
        festivals=calendar.festivals_in_range(festivals, series, horizon_weeks=holdout_weeks),
    )


def write_exports(
    exports: Exports, path: str, method: str = "seasonal", holdout_weeks: int = forecast.HOLDOUT_WEEKS
) -> None:
    """Store all tables as CSV (report-sized ones as single files) and the run's facts as JSON."""
    path = path.rstrip("/")
    export_csv(exports.segments.withColumn("monetary", F.bround("monetary", 2)), f"{path}/rfm_segments")
    export_csv(exports.rules, f"{path}/basket_rules", single_file=True)
    export_csv(exports.forecast, f"{path}/forecast_weekly", order_by=["series", "week"])
    export_csv(exports.festivals, f"{path}/festivals", order_by=["festival", "date"], single_file=True)
    overall = exports.errors.agg(F.avg("mae").alias("mae"), F.avg("mape").alias("mape")).first()
    export_run_metadata(
        exports.errors.sparkSession,
        f"{path}/forecast_meta",
        engine=method,
        holdout_weeks=holdout_weeks,
        mae=float(overall["mae"] or 0.0),
        mape_pct=float(overall["mape"] or 0.0),
    )
