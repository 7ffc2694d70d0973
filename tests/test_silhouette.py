"""The plain silhouette over a tree of cells, and the steps of all k-means fits together."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import clustering, silhouette
from ledgerline.session import freeze
from tests.test_analytics import brute_silhouette


def cloud(spark, n=600, seed=1, copies=0):
    draw = np.random.default_rng(seed)
    centre = draw.normal(size=(4, 3)) * 3
    label = draw.integers(0, 4, n)
    x = centre[label] + draw.normal(size=(n, 3))
    x[:copies], label[:copies] = x[0], label[0]
    rows = [(int(a), *map(float, v)) for a, v in zip(label, x)]
    return freeze(spark.createDataFrame(rows, "label int, a double, b double, c double")), x, label


@pytest.mark.parametrize("copies", [0, 200])
@pytest.mark.parametrize("cells", [20_000, 300, 40, 4])
def test_the_true_silhouette_lies_within_the_bound(spark, cells, copies):
    df, x, label = cloud(spark, copies=copies)
    true = brute_silhouette(x, label)
    for tolerance in (0.0, 0.02, 0.3):
        found = silhouette.plain_silhouette(df, ["a", "b", "c"], "label", tolerance, cells)
        assert found.cells <= cells and found.rows == len(x)
        assert abs(found.silhouette - true) <= found.bound + 1e-9
    exact = silhouette.plain_silhouette(df, ["a", "b", "c"], "label", 0.0, 20_000)
    assert exact.bound < 1e-4 and exact.silhouette == pytest.approx(true, abs=1e-6)


def test_a_wider_margin_opens_fewer_cells_and_widens_the_bound(spark):
    df, _, _ = cloud(spark, n=900, seed=3)
    bounds = [silhouette.plain_silhouette(df, ["a", "b", "c"], "label", t).bound for t in (0.0, 0.01, 0.2)]
    assert bounds[0] <= bounds[1] <= bounds[2] and bounds[1] < 0.02


def test_sums_of_distances_are_bounded_by_every_cut_of_the_tree():
    draw = np.random.default_rng(5)
    x = np.round(draw.normal(size=(200, 2)), 1)
    label = draw.integers(0, 3, 200)
    bins = np.floor((x - x.min(axis=0)) * 4).astype(np.int64)
    keys, cell = np.unique(np.column_stack([label, bins]), axis=0, return_inverse=True)
    cell = cell.ravel()
    moments = np.array([[(cell == i).sum(), *[v for c in x[cell == i].T for v in (c.sum(), (c * c).sum(), c.min(), c.max())]] for i in range(len(keys))])
    tree = silhouette.build_tree(keys[:, 0], keys[:, 1:], moments)
    assert tree.count[tree.roots].sum() == 200 and (tree.size[tree.roots] > 0).all()
    gaps = np.linalg.norm(x[:, None] - x[None], axis=2)
    true = np.column_stack([gaps[:, label == k].sum(axis=1) for k in range(3)])
    for tolerance in (0, 0.05, 0.5, 10):
        low, high = silhouette.distance_sums(x, tree, tolerance)
        assert (low <= true + 1e-9).all() and (true <= high + 1e-9).all()


@pytest.mark.parametrize("tolerance", [0, 1e-9])
def test_many_cells_are_opened_in_bounded_steps(monkeypatch, tolerance):
    monkeypatch.setattr(silhouette, "PAIRS", 2_000)
    draw = np.random.default_rng(6)
    x, label = draw.normal(size=(2_000, 3)), np.arange(2_000) % 4
    bins = np.floor((x + 8) * 64).astype(np.int64)
    order = np.lexsort([*bins.T, label])
    x, label, bins = x[order], label[order], bins[order]
    assert len(np.unique(np.column_stack([label, bins]), axis=0)) == len(x)
    moments = np.column_stack([np.ones(len(x)), *[v for c in x.T for v in (c, c * c, c, c)]])
    tree = silhouette.build_tree(label, bins, moments)
    tracemalloc.start()
    low, high = silhouette.distance_sums(x[:300], tree, tolerance)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # All pairs at once are 600,000 rows of several arrays.
    assert peak < 5_000_000
    gaps = np.linalg.norm(x[:300, None] - x[None], axis=2)
    true = np.column_stack([gaps[:, label == k].sum(axis=1) for k in range(4)])
    assert (low <= true + 1e-6).all() and (true <= high + 1e-6).all() and np.abs(high - low).max() < 1e-3


def test_few_rows_and_few_labels(spark):
    one = spark.createDataFrame([(1, 0.0), (1, 2.0)], "label int, a double")
    assert silhouette.plain_silhouette(one, ["a"], "label").silhouette == 0
    assert silhouette.plain_silhouette(one.limit(0), ["a"], "label") == silhouette.BoundedScore(0.0, 0.0, 0, 0)
    two = spark.createDataFrame([(1, 0.0), (1, 0.0), (2, 5.0)], "label int, a double")
    assert silhouette.plain_silhouette(two, ["a"], "label").silhouette == pytest.approx(2 / 3)
    with pytest.raises(ValueError, match="labels"):
        silhouette.plain_silhouette(two, ["a"], "label", most_cells=1)


def test_all_fits_together_equal_fits_alone(spark):
    df, x, _ = cloud(spark, n=400, seed=8)
    vectors = freeze(clustering.with_vector(df, ["a", "b", "c"]))
    together = clustering.fit_kmeans(vectors, [2, 4, 5], n_init=3)
    for k, fit in together.items():
        alone = clustering.fit_kmeans(vectors, [k], n_init=3)[k]
        assert np.allclose(alone.centres, fit.centres)
        gaps = ((x[:, None] - fit.centres[None]) ** 2).sum(axis=2)
        assert fit.summary.trainingCost == pytest.approx(gaps.min(axis=1).sum())
        assert list(fit.summary.clusterSizes) == np.bincount(gaps.argmin(axis=1), minlength=k).tolist()
        # Each centre is the mean of its rows.
        means = np.array([x[gaps.argmin(axis=1) == j].mean(axis=0) for j in range(k)])
        assert np.allclose(means, fit.centres, atol=2e-3)
        labels = fit.transform(vectors).select("prediction").toPandas()["prediction"].to_numpy()
        assert sorted(np.bincount(labels)) == sorted(fit.summary.clusterSizes)
    scores = clustering.squared_silhouettes(vectors, together)
    for k, fit in together.items():
        assert scores[k] == pytest.approx(clustering.silhouette(fit.transform(vectors), "prediction"), abs=1e-9)


def test_restarts_keep_the_least_cost_and_reach_that_of_another_library(spark):
    from pyspark.ml.clustering import KMeans

    df, _, _ = cloud(spark, n=500, seed=4)
    vectors = freeze(clustering.with_vector(df, ["a", "b", "c"]))
    costs = [clustering.fit_kmeans(vectors, [4], n_init=1, seed=42)[4].summary.trainingCost]
    costs.append(clustering.fit_kmeans(vectors, [4], n_init=6, seed=42)[4].summary.trainingCost)
    other = min(KMeans(k=4, seed=s, featuresCol="features").fit(vectors).summary.trainingCost for s in range(3))
    assert costs[1] <= costs[0] + 1e-9 and costs[1] <= other * 1.0001


def test_equal_rows_and_more_clusters_than_rows(spark):
    same = freeze(clustering.with_vector(spark.createDataFrame([(1.0, 2.0)] * 5 + [(3.0, 4.0)], "a double, b double"), ["a", "b"]))
    fit = clustering.fit_kmeans(same, [2, 4], n_init=2)
    assert fit[2].summary.trainingCost == 0 and sorted(fit[2].summary.clusterSizes) == [1, 5]
    assert sum(fit[4].summary.clusterSizes) == 6
    assert clustering.squared_silhouettes(same, {2: fit[2]})[2] == pytest.approx(5 / 6)
    with pytest.raises(ValueError, match="no rows"):
        clustering.fit_kmeans(same.limit(0), [2])


def test_a_step_of_all_fits_holds_few_distances_and_gives_ties_to_the_first_centre():
    draw = np.random.default_rng(9)
    x = np.round(draw.normal(size=(3_000, 3)), 1)
    fits = [x[draw.integers(0, len(x), k)] for k in (2, 5, 8) for _ in range(20)]
    fits[3][1] = fits[3][0]
    centres, first = np.concatenate(fits), np.cumsum([0, *map(len, fits)])
    tracemalloc.start()
    found = clustering._steps(x, centres, first)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The distances of all rows to all centres are 7 MB.
    assert peak < 3_000_000
    for fit, i in zip(fits, first):
        gaps = ((x[:, None] - fit[None]) ** 2).sum(axis=2)
        own, least = gaps.argmin(axis=1), gaps.min(axis=1)
        tied = (gaps <= least[:, None] + 1e-9).sum(axis=1) > 1
        n = np.bincount(own, minlength=len(fit))
        here = found[i : i + len(fit)]
        assert here[:, 0].sum() == len(x) and np.abs(here[:, 0] - n).sum() <= 2 * tied.sum()
        assert here[:, 1:4].sum(axis=0) == pytest.approx(x.sum(axis=0)) and here[:, -1].sum() == pytest.approx(least.sum())
    assert found[first[3] + 1, 0] == 0
