"""Segments, rules, clusters, churn and forecasts: published arithmetic and invariants."""

from __future__ import annotations

from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.model import StarModel
from ledgerline.operators import basket, calendar, churn, clustering, evaluation, explore, forecast, measures, rfm
from ledgerline.operators.joins import weeks_touched
from ledgerline.plans import dashboard, exports
from ledgerline.session import freeze
from ledgerline.workloads.binding import Binding

# Twelve published holdout pairs (actual, forecast), compared by position.
PUBLISHED = [
    (4844958.0, 4916430.23), (6147252.0, 5500148.38), (6598724.0, 5897796.64), (5467955.0, 5733879.18),
    (7138351.0, 5214689.61), (5508893.0, 4845637.11), (5236798.0, 4909653.14), (5332731.0, 5257592.34),
    (4200310.0, 5564879.38), (6231295.0, 5695165.19), (3916076.0, 5760824.06), (364295.0, 5888961.19),
]
# Published festival dates within the data and its horizon.
IN_RANGE = [
    ("diwali", date(2017, 10, 19)), ("diwali", date(2018, 11, 7)), ("diwali", date(2019, 10, 27)),
    ("holi", date(2018, 3, 2)), ("holi", date(2019, 3, 21)), ("holi", date(2020, 3, 10)),
]


def test_published_holdout_errors(spark):
    weeks = [("all", date.fromordinal(date(2020, 4, 6).toordinal() + 7 * i), a, f) for i, (a, f) in enumerate(PUBLISHED)]
    df = spark.createDataFrame(weeks, "series string, week date, revenue double, forecast double")
    row = forecast.holdout_errors(df.drop("forecast"), df.drop("revenue")).first()
    assert row["weeks"] == 12
    assert round(row["mae"]) == 1162062
    assert round(row["mape"], 1) == 139.9


def test_published_festivals(spark):
    weeks = spark.createDataFrame([(date(2017, 10, 2),), (date(2020, 6, 22),)], "week date")
    got = calendar.festivals_in_range(calendar.festival_calendar(spark), weeks).orderBy("festival", "date").collect()
    assert [tuple(r) for r in got] == IN_RANGE


def test_festival_weeks_overlap(spark):
    days = spark.createDataFrame([("a", date(2019, 10, 27)), ("b", date(2019, 10, 23))], "festival string, date date")
    got = {(r["festival"], r["week"]) for r in weeks_touched(days, "date").collect()}
    assert got == {("a", date(2019, 10, 21)), ("a", date(2019, 10, 28)), ("b", date(2019, 10, 21))}


def test_segment_bounds(spark):
    got = spark.range(3, 13).select("id", rfm.segment_label(F.col("id")).alias("s")).collect()
    expected = {12: "Champions", 11: "Champions", 10: "Loyal", 9: "Loyal", 8: "Potential Loyalist",
                7: "Potential Loyalist", 6: "At Risk", 5: "At Risk", 4: "Lost", 3: "Lost"}
    assert {r["id"]: r["s"] for r in got} == expected


def test_rules_have_consequents_of_any_length(spark):
    items = [["Ice Cream", "North Indian", "Desserts"]] * 3 + [["Desserts"], ["North Indian", "Tea"], ["Tea"]]
    baskets = spark.createDataFrame([(i, sorted(b)) for i, b in enumerate(items)], "basket int, items array<string>")
    sets = basket.frequent_itemsets(baskets, 0.1)
    rules = basket.association_rules(sets).toPandas()
    brute = [set(b) for b in items]

    def support(s):
        return sum(set(s) <= b for b in brute) / len(brute)

    assert any(len(c) > 1 for c in rules["consequents"])
    for _, r in rules.iterrows():
        both = support([*r["antecedents"], *r["consequents"]])
        assert r["support"] == pytest.approx(both)
        assert r["confidence"] == pytest.approx(both / support(r["antecedents"]))
        assert r["lift"] == pytest.approx(both / support(r["antecedents"]) / support(r["consequents"]))
    rendered = {r["rule"] for r in basket.top_rules(basket.association_rules(sets), 100).collect()}
    assert "Ice Cream + North Indian  ->  Desserts" in rendered
    # Both directions of a split have the same lift.
    lifts = {(tuple(r["antecedents"]), tuple(r["consequents"])): r["lift"] for _, r in rules.iterrows()}
    for (a, c), value in lifts.items():
        assert lifts[c, a] == pytest.approx(value)


def blobs(spark, n=300):
    rng = np.random.default_rng(5)
    centres = np.array([[0, 0], [6, 6], [0, 7]])
    points = np.vstack([rng.normal(c, 0.6, (n // 3, 2)) for c in centres])
    return freeze(spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "id long, a double, b double"))


def brute_silhouette(x, labels, power=1):
    gaps = np.linalg.norm(x[:, None] - x[None], axis=2) ** power
    out = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        inner = gaps[i, own].sum() / (own.sum() - 1)
        outer = min(gaps[i, labels == k].mean() for k in set(labels) - {labels[i]})
        out.append((outer - inner) / max(inner, outer))
    return float(np.mean(out))


def test_silhouette_and_choice_of_k(spark):
    df = blobs(spark)
    sweep = clustering.sweep_k(df, "id", ["a", "b"], ks=(2, 3, 4), n_init=3)
    assert sweep.best_k == 3
    labelled = clustering.assign_clusters(df, ["a", "b"], sweep.models[3], "a").toPandas()
    points, clusters = labelled[["a", "b"]].to_numpy(), labelled["cluster"].to_numpy()
    assert sweep.silhouettes[3] == pytest.approx(brute_silhouette(points, clusters, 2), abs=1e-9)
    sampled = clustering.sweep_k(df, "id", ["a", "b"], ks=(3,), n_init=3, sample=10_000)
    assert sampled.silhouettes[3] == pytest.approx(brute_silhouette(points, clusters), abs=1e-9)
    with pytest.raises(ValueError):
        clustering.silhouettes(clustering.with_vector(df, ["a", "b"]).withColumn("l", F.lit(0)), {1: "l"}, most=10)
    assert all(-1 <= s <= 1 for s in sweep.silhouettes.values())
    assert sweep.table(df).where("chosen").first()["k"] == 3
    means = labelled.groupby("cluster")["a"].mean()
    assert means.is_monotonic_decreasing


def test_restarts_never_cost_more_than_one_seed(spark):
    vectors = clustering.with_vector(blobs(spark), ["a", "b"])
    one = clustering.fit_kmeans(vectors, [4], n_init=1)[4].summary.trainingCost
    assert clustering.fit_kmeans(vectors, [4], n_init=4)[4].summary.trainingCost <= one + 1e-9


def test_auc_roc_and_report(spark):
    rng = np.random.default_rng(3)
    score = rng.integers(0, 20, 400) / 10
    label = (rng.random(400) < 0.3 + 0.2 * score / 2).astype(int)
    rows = [(int(a), float(s), int(s >= 1)) for a, s in zip(label, score)]
    df = spark.createDataFrame(rows, "churned int, score double, prediction int")
    wins = sum((p > n) + 0.5 * (p == n) for p in score[label == 1] for n in score[label == 0])
    assert evaluation.auc(df).first()["auc"] == pytest.approx(wins / (label.sum() * (1 - label).sum()))
    points = evaluation.roc_points(df).toPandas().sort_values("threshold", ascending=False)
    assert points["tpr"].is_monotonic_increasing and points["fpr"].is_monotonic_increasing
    assert points.iloc[0][["tpr", "fpr"]].tolist() == [0, 0] and points.iloc[-1][["tpr", "fpr"]].tolist() == [1, 1]
    matrix = {(r["label"], r["prediction"]): r["n"] for r in evaluation.confusion_matrix(df).collect()}
    assert sum(matrix.values()) == 400 and len(matrix) == 4
    report = {r["class"]: r for r in evaluation.classification_report(df).collect()}
    assert report["1"]["precision"] == pytest.approx(matrix[1, 1] / (matrix[1, 1] + matrix[0, 1]))
    assert report["accuracy"]["f1"] == pytest.approx((matrix[0, 0] + matrix[1, 1]) / 400)


def test_split_is_stratified_and_independent_of_partitions(spark):
    df = spark.range(1000).select(F.col("id").alias("user_id"), (F.col("id") % 10 == 0).cast("int").alias("churned"))
    a = churn.stratified_split(df, "user_id").toPandas().sort_values("user_id")
    b = churn.stratified_split(df.repartition(7), "user_id").toPandas().sort_values("user_id")
    assert a["is_test"].tolist() == b["is_test"].tolist()
    assert a.groupby("churned")["is_test"].sum().to_dict() == {0: 225, 1: 25}


def test_mean_gap_telescopes(spark, folder):
    b = Binding(spark, folder)
    got = churn.churn_features(b.model()).toPandas().set_index("user_id")
    orders = b.orders("user_id", "order_datetime").where("user_id is not null").toPandas()
    ordered = orders.sort_values(["user_id", "order_datetime"])
    gaps = ordered.groupby("user_id")["order_datetime"].diff().groupby(ordered["user_id"]).mean().dt.days.fillna(0)
    assert got["avg_gap_days"].sort_index().tolist() == gaps.astype(int).sort_index().tolist()


def test_recency_is_no_feature(spark):
    with pytest.raises(ValueError, match="recency"):
        churn.fit_classifier(spark.range(1), features=["recency_days"])


@pytest.fixture(scope="module")
def series(spark):
    weeks = pd.date_range("2015-01-05", periods=210, freq="W-MON")
    wave = 100 + 0.5 * np.arange(210) + 30 * np.sin(2 * np.pi * np.arange(210) / 52.18)
    rows = [(k, w.date(), float(v * s)) for k, s in (("x", 1), ("y", 10)) for w, v in zip(weeks, wave)]
    return freeze(spark.createDataFrame(rows, "series string, week date, revenue double"))


@pytest.mark.parametrize("method", ["seasonal", "holt_winters"])
def test_forecasts_follow_trend_and_season(series, method):
    kept_back = forecast.holdout(series)
    train, test = forecast.split_holdout(series, kept_back)
    predicted = freeze(forecast.forecast_series(train, kept_back, method, {}))
    assert kept_back.weeks == 12
    table = forecast.forecast_table(series, predicted, kept_back).toPandas()
    assert all(w.weekday() == 0 for w in table["week"])
    holdout = table[table["is_holdout_forecast"]]
    assert len(holdout) == 24 and holdout[["actual_revenue", "forecast"]].notna().all().all()
    assert (table["lower"] <= table["forecast"] + 1e-6).all() and (table["forecast"] <= table["upper"] + 1e-6).all()
    errors = forecast.holdout_errors(test, predicted).toPandas()
    assert (errors["mape"] < 8).all()


@pytest.mark.parametrize("method", ["seasonal", "holt_winters"])
def test_short_empty_and_young_series_are_kept(spark, method):
    weeks = [w.date() for w in pd.date_range("2019-01-07", periods=40, freq="W-MON")]
    rows = [("short", w, float(i)) for i, w in enumerate(weeks)] + [("blank", w, None) for w in weeks]
    rows += [("young", w, 5.0) for w in weeks[-3:]]
    series = freeze(spark.createDataFrame(rows, "series string, week date, revenue double"))
    kept_back = forecast.holdout(series)
    train, test = forecast.split_holdout(series, kept_back)
    predicted = freeze(forecast.forecast_series(train, kept_back, method, {}))
    forms = {r["series"]: r["form"] for r in predicted.select("series", "form").distinct().collect()}
    assert forms == {"short": "straight trend" if method == "seasonal" else "no season", "blank": "no value"}
    bent = forecast.forecast_series(train.where("series = 'short'"), kept_back, method, {}, bends_from=10, season_from=10)
    assert {r["form"] for r in bent.collect()} == {"bending trend" if method == "seasonal" else "no season"}
    assert predicted.where("series = 'blank' AND forecast IS NOT NULL").count() == 0
    weeks_judged = {r["series"]: r["weeks"] for r in forecast.holdout_errors(test, predicted).collect()}
    assert weeks_judged == {"short": 12, "blank": 0, "young": 0}
    table = forecast.forecast_table(series, predicted, kept_back)
    assert table.where("series = 'young'").count() == 3


def test_functions_run_where_executors_lack_the_package(tmp_path):
    """A forecast from an empty folder: only the driver knows where the package is."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from ledgerline.session import build_session
spark = build_session("elsewhere", "local[2]", **{{"spark.sql.shuffle.partitions": "2"}})
print("ROWS", entry.queries()["seasonal_forecast"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in run.stdout, run.stderr[-2000:]


def test_orders_without_an_amount_do_not_lower_the_average(spark):
    orders = spark.createDataFrame([(1, 100, "INR"), (1, None, "INR"), (2, None, "INR")], "restaurant_id long, sales_amount int, currency string")
    sellers = spark.createDataFrame([(1, "a"), (2, "b")], "restaurant_id long, cuisine string")
    rows = measures.order_value_by_tag(StarModel(orders, sellers)).collect()
    assert [(r["tag"], r["aov"], r["orders"]) for r in rows] == [("b", None, 1), ("a", 100.0, 2)]


def test_unrated_sellers_leave_the_location_profile(spark):
    orders = spark.createDataFrame([(1, "INR"), (2, "INR")], "restaurant_id long, currency string")
    sellers = spark.createDataFrame([(1, "x", 100, 4.0), (2, "x", 900, None)], "restaurant_id long, location string, cost_for_two int, rating double")
    row = explore.location_profile(StarModel(orders, sellers), min_sellers=1).first()
    assert (row["avg_cost"], row["sellers"]) == (100.0, 1)


def test_split_of_an_empty_table_is_empty(spark):
    assert churn.stratified_split(spark.createDataFrame([], "user_id long, churned int"), "user_id").count() == 0


def test_partial_last_week_can_be_dropped(spark):
    orders = spark.createDataFrame(
        [("2020-01-06", 10), ("2020-01-12", 5), ("2020-01-14", 7)], "d string, a int"
    ).select(
        F.to_timestamp_ntz("d").alias("order_datetime"),
        F.col("a").cast("decimal(12,2)").alias("sales_amount"),
        F.lit("INR").alias("currency"),
    )
    assert forecast.weekly_series(orders).count() == 2
    kept = forecast.weekly_series(orders, drop_partial_last_week=True).collect()
    assert [(str(r["week"]), r["revenue"]) for r in kept] == [("2020-01-06", 15.0)]


def test_exports_and_dashboard(spark, tmp_path, folder):
    model = Binding(spark, folder).model()
    out = exports.build_exports(model, ks=(2, 3), n_init=2, min_support=0.6, rules=50)
    exports.write_exports(out, str(tmp_path))
    segments = spark.read.csv(str(tmp_path / "rfm_segments"), header=True, inferSchema=True)
    assert {"user_id", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score", "segment", "cluster"} == set(
        segments.columns
    )
    assert segments.count() == segments.select("user_id").distinct().count() == out.segments.count()
    assert spark.read.json(str(tmp_path / "forecast_meta")).first()["holdout_weeks"] == 12
    pages = {
        **dashboard.overview_page(model, location=("Brand#3", "Brand#5"), date_from="1996-01-01"),
        **dashboard.seller_page(model),
        **dashboard.customer_page(out.segments, model),
        **dashboard.basket_page(out.rules, model),
        **dashboard.forecast_page(out.forecast, out.festivals),
    }
    for name, frame in pages.items():
        assert frame.limit(1).count() >= (0 if name in ("festivals", "lift", "rules") else 1), name


def test_splits_of_a_large_set_are_dealt_out(spark):
    names = [f"i{n:02d}" for n in range(9)]
    sets = [names[i : i + k] for k in range(1, 10) for i in range(10 - k)]
    from itertools import combinations

    every = [list(c) for k in range(1, 10) for c in combinations(names, k)]
    df = spark.createDataFrame([(s, 10 - len(s), (10.0 - len(s)) / 10) for s in every], "items array<string>, freq long, support double")
    whole = {(tuple(r["antecedents"]), tuple(r["consequents"]), round(r["lift"], 9)) for r in basket.association_rules(df, 0.0).collect()}
    dealt = {(tuple(r["antecedents"]), tuple(r["consequents"]), round(r["lift"], 9)) for r in basket.association_rules(df, 0.0, low_bits=3).collect()}
    assert dealt == whole and len(whole) == sum(2 ** len(s) - 2 for s in every) and len(sets) == 45


def test_masks_of_a_set_of_25_items(spark):
    df = spark.createDataFrame([([f"i{n}" for n in range(25)], 0.5)], "items array<string>, support double")
    row = basket._splits(df, basket.LOW_BITS).agg(F.count("*"), F.min("mask"), F.max("mask"), F.sum("mask")).first()
    assert tuple(row) == (2**25 - 2, 1, 2**25 - 2, (2**25 - 1) * 2**24 - (2**25 - 1))


def test_sparse_weights_meet_their_conditions():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(120, 12))
    y = x @ np.array([3.0, -2.0, *np.zeros(10)]) + draw.normal(size=120)
    ridge, lasso = np.full(12, 0.3), np.array([0.0, 0.0, *np.full(10, 40.0)])
    gram, target = x.T @ x, x.T @ y
    weights = forecast.sparse_ridge(gram, target, ridge, lasso)
    pull = target - gram @ weights - ridge * weights
    held = weights == 0
    assert held[2:].any() and not held[:2].any()
    assert np.allclose(pull[~held], np.sign(weights[~held]) * lasso[~held], atol=1e-6)
    assert (np.abs(pull[held]) <= lasso[held] + 1e-6).all()
    plain = forecast.sparse_ridge(gram, target, ridge, np.zeros(12))
    assert np.allclose(plain, np.linalg.solve(gram + np.diag(ridge), target))


def test_intervals_widen_and_cover_a_wandering_trend():
    draw = np.random.default_rng(7)
    grid = pd.date_range("2015-01-05", periods=260, freq="W-MON")
    inside, widths = [], []
    for _ in range(25):
        slope = np.cumsum(np.where(draw.random(260) < 0.08, draw.laplace(0, 0.1, 260), 0))
        y = 300 + np.cumsum(slope) + 20 * np.sin(np.arange(260) * 2 * np.pi / 52) + draw.normal(0, 6, 260)
        known = np.where(np.arange(260) < 248, y, np.nan)
        middle, low, high, form = forecast._seasonal(grid, known, 248, {}, 51)
        assert form == "bending trend" and (low <= middle).all() and (middle <= high).all()
        width = (high - low)[248:]
        assert (np.diff(width) >= -1e-9).all() and width[-1] >= width[0]
        inside += list((low[248:] <= y[248:]) & (y[248:] <= high[248:]))
        widths.append(width[-1] / width[0])
    assert np.mean(widths) > 1.3 and 0.65 <= np.mean(inside) <= 0.95
