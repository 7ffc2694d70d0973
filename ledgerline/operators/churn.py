"""Churn: behaviour features, a label drawn from the data, and a boosted classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import hash_order, share, whole_days
from ledgerline.model import Columns, StarModel, with_known
from ledgerline.operators.basket import tag_pairs
from ledgerline.operators.ranking import previous_in_group, quantiles, running_totals
from ledgerline.session import ensure_checkpoint_dir, freeze

# Threshold limits, split, and classifier settings. Recency defines the label and is
# therefore not a feature.
THRESHOLD_LIMITS = (30, 180)
TEST_SHARE = 0.25
SEED = 42
FEATURES = ("frequency", "aov", "tenure_days", "avg_gap_days", "monetary", "tag_diversity")
TREES, DEPTH, RATE = 250, 4, 0.08
USEFUL_AUC = 0.70
MICROS_PER_DAY = 86_400_000_000


def churn_features(model: StarModel, all_currencies: bool = False) -> DataFrame:
    """Per customer: recency, frequency, order value, tenure, mean gap, money and tag diversity.

    The mean gap between orders telescopes to (last - first) / (n - 1), so no order has to be sorted
    and a customer with very many orders is aggregated like any other. Customers with one order have
    gap 0. ``all_currencies`` averages order values over every currency.
    """
    c = model.c
    known = with_known(model.orders, c.user)
    valued = F.col(c.amount) if all_currencies else c.base_amount
    per_user = known.groupBy(c.user).agg(
        F.max(c.time).alias("last"),
        F.min(c.time).alias("first"),
        F.count(F.lit(1)).alias("frequency"),
        share(F.sum(valued), F.count(valued)).alias("aov"),
        F.coalesce(F.sum(c.base_amount), F.lit(0)).alias("monetary"),
    )
    gap = F.when(
        F.col("frequency") > 1,
        F.expr(f"micros div ((frequency - 1) * {MICROS_PER_DAY})"),
    )
    per_user = freeze(per_user)
    latest = per_user.agg((F.max("last") + F.expr("interval 1 day")).alias("now")).scalar()
    micros = F.timestamp_diff("MICROSECOND", F.col("first"), F.col("last"))
    features = per_user.withColumn("micros", micros).select(
        c.user,
        whole_days(latest, F.col("last")).alias("recency_days"),
        "frequency",
        "aov",
        whole_days(F.col("last"), F.col("first")).alias("tenure_days"),
        F.coalesce(gap, F.lit(0)).cast("int").alias("avg_gap_days"),
        "monetary",
    )
    diversity = tag_pairs(model).groupBy(F.col("basket").alias(c.user)).agg(F.count(F.lit(1)).alias("tag_diversity"))
    return features.join(diversity, c.user, "left").fillna({"tag_diversity": 0})


def purchase_gaps(orders: DataFrame, c: Columns = Columns()) -> DataFrame:
    """Per customer and order time: orders at that time, the previous time, and whole days between.

    Orders at one time collapse first (their gaps are 0); a customer with a third of all orders
    spreads over many tasks.
    """
    times = with_known(orders, c.user).groupBy(c.user, c.time).agg(F.count(F.lit(1)).alias("orders"))
    return previous_in_group(times, c.user, c.time, "previous_time").withColumn(
        "gap_days", whole_days(F.col(c.time), F.col("previous_time"))
    )


def gap_counts(gaps: DataFrame) -> DataFrame:
    """How often each gap occurs, orders at the same time counting as gaps of 0."""
    pieces = F.array(
        F.struct(F.col("gap_days").alias("gap_days"), F.lit(1).cast("bigint").alias("n")),
        F.struct(F.lit(0).alias("gap_days"), (F.col("orders") - 1).alias("n")),
    )
    return (
        gaps.select(F.explode(pieces).alias("p"))
        .select("p.*")
        .where("gap_days is not null and n > 0")
        .groupBy("gap_days")
        .agg(F.sum("n").alias("n"))
    )


def churn_threshold(counts: DataFrame, low: int = THRESHOLD_LIMITS[0], high: int = THRESHOLD_LIMITS[1]) -> DataFrame:
    """Days without an order after which a customer counts as lost: median gap plus one deviation, limited."""
    x, n = F.col("gap_days").cast("double"), F.col("n").cast("double")
    moments = counts.agg(F.sum(n).alias("w"), F.sum(n * x).alias("s"), F.sum(n * x * x).alias("q")).select(
        F.col("w").cast("bigint").alias("gaps"),
        F.sqrt(F.try_divide(F.col("q") - F.col("s") * F.col("s") / F.col("w"), F.col("w") - 1)).alias("std_gap"),
    )
    median = quantiles(counts, "gap_days", (0.5,), weight="n").select("q0").scalar()
    return moments.withColumn("median_gap", median).select(
        "gaps",
        "median_gap",
        "std_gap",
        F.least(F.greatest(F.ceil(F.col("median_gap") + F.col("std_gap")), F.lit(low)), F.lit(high))
        .cast("int")
        .alias("threshold_days"),
    )


def label_churn(features: DataFrame, threshold_days: int | Column) -> DataFrame:
    limit = F.lit(threshold_days) if isinstance(threshold_days, int) else threshold_days
    return features.withColumn("churned", (F.col("recency_days") > limit).cast("int"))


def base_rate(labelled: DataFrame) -> DataFrame:
    rate = F.avg(F.col("churned").cast("double"))
    return labelled.agg(
        F.count(F.lit(1)).alias("customers"),
        rate.alias("churn_rate"),
        F.greatest(rate, F.lit(1.0) - rate).alias("majority_share"),
    )


def stratified_split(
    df: DataFrame, key: str, label: str = "churned", test_share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Add ``is_test``: within each class exactly the rounded share of rows, first in hash order.

    The split depends on the keys alone, not on partitions or row order. Only labels, hashes and keys
    are sorted, to find the last test row of each class; the split itself is a projection. ``df`` is
    read three times, so it should be frozen.
    """
    tagged = df.withColumn("__hash", hash_order(F.col(key), seed))
    narrow = tagged.select(label, "__hash", F.col(key), F.lit(1).cast("bigint").alias("__one"))
    placed = running_totals(narrow, ["__hash", key], {"__place": "__one"}, within=[label])
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    wanted = {r[label]: int(r["n"] * test_share + 0.5) for r in sizes}
    if not wanted:
        return tagged.withColumn("is_test", F.lit(False)).drop("__hash")
    last = F.coalesce(*[F.when(F.col(label) == k, F.col("__place") == n) for k, n in wanted.items()])
    kind = df.schema[key].dataType
    is_test = F.lit(False)
    for row in placed.where(last).collect():
        border = F.struct(F.lit(row["__hash"]), F.lit(row[key]).cast(kind))
        is_test = is_test | ((F.col(label) == row[label]) & (F.struct("__hash", key) <= border))
    return tagged.withColumn("is_test", is_test).drop("__hash")


def fit_classifier(
    train: DataFrame,
    label: str = "churned",
    features: Sequence[str] = FEATURES,
    trees: int = TREES,
    depth: int = DEPTH,
    rate: float = RATE,
    seed: int = SEED,
) -> PipelineModel:
    """Gradient-boosted trees on imputed features; lineage is cut in the shared checkpoint folder."""
    if "recency_days" in features:
        raise ValueError("recency defines the label and cannot be a feature")
    ensure_checkpoint_dir(train.sparkSession)
    filled = [f"{f}_filled" for f in features]
    stages = [
        Imputer(inputCols=list(features), outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=filled, outputCol="features"),
        GBTClassifier(
            labelCol=label, featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed,
            checkpointInterval=10,
        ),
    ]
    return Pipeline(stages=stages).fit(_as_numbers(train, label, features))


def score(model: PipelineModel, df: DataFrame, label: str = "churned", features: Sequence[str] = FEATURES) -> DataFrame:
    scored = model.transform(_as_numbers(df, label, features))
    return scored.withColumn("score", vector_to_array("probability")[1]).withColumn(
        "prediction", F.col("prediction").cast("int")
    ).drop("features", "rawPrediction", "probability", *[f"{f}_filled" for f in features])


def _as_numbers(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    return df.withColumns({f: F.col(f).cast("double") for f in features}).withColumn(label, F.col(label).cast("int"))


def feature_importance(model: PipelineModel, df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(features, weights)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def verdict(rates: DataFrame, auc_table: DataFrame) -> DataFrame:
    """Majority share next to the AUC, and whether the model beats guessing clearly."""
    auc = auc_table.select("auc").scalar()
    return rates.withColumn("auc", auc).select(
        "majority_share",
        "auc",
        F.when(F.col("auc") > USEFUL_AUC, "real signal").otherwise("weak signal").alias("verdict"),
    )

