"""Recency, frequency and money per customer: scores, segments and scaled features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import signed_log1p
from ledgerline.model import Columns, with_known
from ledgerline.operators.ranking import quartile_scores
from ledgerline.session import freeze

# Least total score of each segment, best first.
SEGMENT_BOUNDS = ((11, "Champions"), (9, "Loyal"), (7, "Potential Loyalist"), (5, "At Risk"))
WEAKEST_SEGMENT = "Lost"
FEATURES = ("recency_days", "frequency", "monetary")


def rfm_base(orders: DataFrame, c: Columns = Columns()) -> DataFrame:
    """Recency in days, number of orders (any currency) and base-currency money per customer.

    The reference date counts all orders, so orders without a customer are aggregated as one more
    group, combined on the map side. Freezing that table gives the date without a second scan.
    """
    per_user = freeze(
        orders.groupBy(c.user).agg(
            F.max(c.day).alias("last_day"),
            F.count(F.lit(1)).alias("frequency"),
            F.coalesce(F.sum(c.base_amount), F.lit(0)).alias("monetary"),
        )
    )
    reference = F.lit(per_user.agg(F.date_add(F.max("last_day"), 1)).first()[0]).cast("date")
    return with_known(per_user, c.user).select(
        c.user, F.date_diff(reference, F.col("last_day")).alias("recency_days"), "frequency", "monetary"
    )


def segment_label(total: Column) -> Column:
    bands = [F.when(total >= bound, F.lit(name)) for bound, name in SEGMENT_BOUNDS]
    return F.coalesce(*bands, F.lit(WEAKEST_SEGMENT))


def rfm_segments(orders: DataFrame, c: Columns = Columns()) -> DataFrame:
    """Quartile scores (a recent customer scores high) and the segment of their total."""
    return score_segments(rfm_base(orders, c), c)


def score_segments(base: DataFrame, c: Columns = Columns()) -> DataFrame:
    """Score an RFM table that is cheap to read again, such as the one of ``rfm_base``."""
    scored = quartile_scores(
        base,
        c.user,
        {"r_score": ("recency_days", False), "f_score": ("frequency", True), "m_score": ("monetary", True)},
    )
    return scored.withColumn("segment", segment_label(F.col("r_score") + F.col("f_score") + F.col("m_score")))


def scale_features(df: DataFrame, columns: Sequence[str] = FEATURES, suffix: str = "_z") -> DataFrame:
    """Signed ``log1p``, then zero mean and unit population deviation.

    The moments are two numbers per column, so they travel as constants.
    """
    logs = {c: signed_log1p(F.col(c)) for c in columns}
    moments = df.agg(
        *[F.avg(logs[c]).alias(f"{c}|mean") for c in columns], *[F.stddev_pop(logs[c]).alias(f"{c}|std") for c in columns]
    ).first()
    out = df
    for c in columns:
        spread = moments[f"{c}|std"] or 1.0
        out = out.withColumn(c + suffix, (logs[c] - F.lit(moments[f"{c}|mean"])) / F.lit(spread))
    return out
