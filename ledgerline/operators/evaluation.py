"""Classifier quality from a label and a score, without collecting scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import share
from ledgerline.operators.ranking import running_totals


def _by_score(scored: DataFrame, label: str, score: str) -> DataFrame:
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives")
    )


def auc(scored: DataFrame, label: str = "churned", score: str = "score") -> DataFrame:
    """Area under the ROC curve as a rank sum: ties count half."""
    ranked = running_totals(_by_score(scored, label, score), ["score"], {"negatives_upto": "negatives"})
    won = F.col("positives") * (F.col("negatives_upto") - F.col("negatives") / 2)
    return ranked.agg(
        share(F.sum(won), F.sum("positives") * F.sum("negatives")).alias("auc"),
        F.sum("positives").alias("positives"),
        F.sum("negatives").alias("negatives"),
    )


def roc_points(scored: DataFrame, label: str = "churned", score: str = "score") -> DataFrame:
    """One point per distinct score, from the strictest threshold to the loosest, after the origin."""
    grouped = _by_score(scored, label, score)
    ranked = running_totals(grouped, [F.desc("score")], {"tp": "positives", "fp": "negatives"})
    whole = grouped.agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n")).first()
    points = ranked.select(
        F.col("score").alias("threshold"),
        "tp",
        "fp",
        share(F.col("tp"), F.lit(whole["p"])).alias("tpr"),
        share(F.col("fp"), F.lit(whole["n"])).alias("fpr"),
    )
    origin = scored.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"),
        F.lit(0).cast("bigint").alias("tp"),
        F.lit(0).cast("bigint").alias("fp"),
        F.lit(0.0).alias("tpr"),
        F.lit(0.0).alias("fpr"),
    )
    return origin.unionByName(points)


def confusion_matrix(scored: DataFrame, label: str = "churned", prediction: str = "prediction") -> DataFrame:
    """All four cells, also empty ones."""
    counts = scored.groupBy(F.col(label).alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    cells = scored.sparkSession.createDataFrame([(a, b) for a in (0, 1) for b in (0, 1)], "label int, prediction int")
    return cells.join(counts, ["label", "prediction"], "left").fillna({"n": 0})


def classification_report(scored: DataFrame, label: str = "churned", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted means."""
    cell = {
        (a, b): F.count_if((F.col(label) == a) & (F.col(prediction) == b)) for a in (0, 1) for b in (0, 1)
    }
    row = scored.agg(*[cell[a, b].alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)])
    zero = F.lit(0.0)
    for k in (0, 1):
        hit, claimed, actual = F.col(f"n{k}{k}"), F.col(f"n0{k}") + F.col(f"n1{k}"), F.col(f"n{k}0") + F.col(f"n{k}1")
        row = row.withColumns(
            {f"p{k}": F.coalesce(share(hit, claimed), zero), f"r{k}": F.coalesce(share(hit, actual), zero), f"s{k}": actual}
        )
        p, r = F.col(f"p{k}"), F.col(f"r{k}")
        row = row.withColumn(f"f{k}", F.coalesce(share(2 * p * r, p + r), zero))
    total = F.col("s0") + F.col("s1")

    def line(name, p, r, f, s):
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), s.alias("support")
        )

    def mean(m):
        return (F.col(f"{m}0") + F.col(f"{m}1")) / 2

    def weighted(m):
        return share(F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1"), total)

    accuracy = share(F.col("n00") + F.col("n11"), total)
    lines = [line(str(k), *[F.col(f"{m}{k}") for m in "prfs"]) for k in (0, 1)]
    lines += [
        line("accuracy", accuracy, accuracy, accuracy, total),
        line("macro avg", mean("p"), mean("r"), mean("f"), total),
        line("weighted avg", weighted("p"), weighted("r"), weighted("f"), total),
    ]
    return row.select(F.explode(F.array(*lines)).alias("x")).select("x.*")
