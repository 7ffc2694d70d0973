"""k-means with restarts, the silhouette and the choice of k."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ranking import hashed_sample

# Sweep range, restarts and seed.
K_RANGE = tuple(range(2, 9))
RESTARTS = 10
SEED = 42
# Rows that the first centres are drawn from, steps at most, and the move of a centre below which a fit ends.
START_ROWS = 5_000
STEPS = 100
TOLERANCE = 1e-4
# Rows that a step measures at a time, so that their distances to the centres of all fits stay in the cache.
STEP_ROWS = 128


@dataclass(frozen=True)
class Summary:
    """Cost and cluster sizes over all rows."""

    trainingCost: float
    clusterSizes: Sequence[int]


@dataclass(frozen=True)
class KMeansFit:
    """Centres of one fit; of equally near centres the first has the row."""

    centres: np.ndarray
    summary: Summary
    prediction: str = "prediction"

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def setPredictionCol(self, name: str) -> KMeansFit:
        return KMeansFit(self.centres, self.summary, name)

    def gaps(self, coordinates: Sequence[Column]) -> Column:
        """Squared distances to all centres."""
        return F.array(*[sum((F.pow(c - F.lit(float(m)), F.lit(2)) for c, m in zip(coordinates, centre)), F.lit(0.0)) for centre in self.centres])

    def transform(self, points: DataFrame) -> DataFrame:
        """Add the number of the nearest centre of the vector ``features``."""
        parts = vector_to_array("features")
        gaps = self.gaps([parts[i] for i in range(self.centres.shape[1])])
        nearest = F.transform(F.array(gaps), lambda g: F.array_position(g, F.array_min(g)))[0] - 1
        return points.withColumn(self.prediction, nearest.cast("int"))


@dataclass(frozen=True)
class Sweep:
    """All fitted sizes: the best model of each k and its silhouette."""

    models: Mapping[int, KMeansFit]
    silhouettes: Mapping[int, float]

    @property
    def best_k(self) -> int:
        return max(self.silhouettes, key=lambda k: (self.silhouettes[k], -k))

    def table(self, df: DataFrame) -> DataFrame:
        rows = [(k, float(s), k == self.best_k) for k, s in sorted(self.silhouettes.items())]
        return df.sparkSession.createDataFrame(rows, "k int, silhouette double, chosen boolean")


def with_vector(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def _coordinates(batch: pa.RecordBatch) -> np.ndarray:
    """Rows of the array column ``x`` of a batch as a matrix."""
    column = batch.column(batch.schema.get_field_index("x"))
    return column.flatten().to_numpy().reshape(len(column), -1)


def _nearest(x: np.ndarray, centres: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(fit, nearest centre of each row, its squared distance) of every fit; ``first`` says where its centres begin."""
    gaps = (x**2).sum(axis=1)[:, None] - 2 * (x @ centres.T) + (centres**2).sum(axis=1)
    for fit, (i, j) in enumerate(zip(first[:-1], first[1:])):
        own = gaps[:, i:j]
        at = own.argmin(axis=1)
        yield fit, at + i, np.maximum(own[np.arange(len(x)), at], 0.0)


def _steps(x: np.ndarray, centres: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per centre of all fits: rows, sums of coordinates, sum of squares; a fit's cost stands at its first centre."""
    width = centres.shape[1]
    total = np.zeros((len(centres), width + 3))
    sizes, lengths = np.diff(first), (centres**2).sum(axis=1)[:, None]
    for at in range(0, len(x), STEP_ROWS):
        part = x[at : at + STEP_ROWS]
        squares = (part**2).sum(axis=1)
        gaps = lengths - 2 * (centres @ part.T)
        least = np.minimum.reduceat(gaps, first[:-1], axis=0)
        nearest = gaps <= np.repeat(least, sizes, axis=0)
        if np.count_nonzero(nearest) > len(sizes) * len(part):
            # Of equally near centres the first has the row.
            for i in np.flatnonzero((np.add.reduceat(nearest, first[:-1], axis=0, dtype=np.int64) > 1).any(axis=1)):
                own = nearest[first[i] : first[i + 1]]
                own[:] = np.arange(len(own))[:, None] == own.argmax(axis=0)
        total[:, :-1] += nearest.astype(float) @ np.column_stack([np.ones(len(part)), part, squares])
        total[first[:-1], -1] += np.maximum(least + squares, 0.0).sum(axis=1)
    return total


def _sums(rows: DataFrame, fits: Sequence[np.ndarray]) -> np.ndarray:
    """``_steps`` over all rows, in one scan."""
    centres, first = np.concatenate(fits), np.cumsum([0, *map(len, fits)])
    width = centres.shape[1]
    names = ["centre", "n", *[f"s{i}" for i in range(width)], "squares", "cost"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), width + 3))
        for batch in batches:
            total += _steps(_coordinates(batch), centres, first)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(centres))), *[pa.array(c) for c in total.T]], names=names)

    kinds = ", ".join(["centre long", *[f"{n} double" for n in names[1:]]])
    found = rows.mapInArrow(add, kinds).groupBy("centre").agg(*[F.sum(n).alias(n) for n in names[1:]])
    out = np.zeros((len(centres), width + 3))
    for row in found.collect():
        out[row["centre"]] = row[1:]
    return out


def first_centres(sample: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """k rows of a sample, each drawn by its squared distance to those before: the best of a few draws."""
    tries = 2 + int(np.log(k))
    chosen = [sample[draw.integers(len(sample))]]
    gaps = ((sample - chosen[0]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        weights = gaps / gaps.sum() if gaps.sum() > 0 else np.full(len(sample), 1 / len(sample))
        drawn = sample[draw.choice(len(sample), size=tries, p=weights)]
        left = np.minimum(gaps, ((sample[None] - drawn[:, None]) ** 2).sum(axis=2))
        best = int(left.sum(axis=1).argmin())
        chosen.append(drawn[best])
        gaps = left[best]
    return np.array(chosen)


def fit_kmeans(
    vectors: DataFrame, ks: Sequence[int], n_init: int = RESTARTS, seed: int = SEED,
    steps: int = STEPS, tolerance: float = TOLERANCE, start_rows: int = START_ROWS,
) -> dict[int, KMeansFit]:
    """Per k the model of least cost over ``n_init`` seeds.

    All fits take their steps together: one scan and one aggregate move the centres of every fit that still
    moves, and what comes back is one row for each centre. First centres are drawn from a sample of at most
    ``start_rows`` rows; steps, sizes and costs are over all rows.
    """
    ks = sorted(ks)
    rows = vectors.select(vector_to_array("features").alias("x")).persist()
    try:
        sample = np.array([r["x"] for r in rows.orderBy(F.rand(seed)).limit(start_rows).collect()], dtype=float)
        if not len(sample):
            raise ValueError("no rows to fit")
        fits = [first_centres(sample, k, np.random.default_rng([seed, k, i])) for k in ks for i in range(n_init)]
        moving = list(range(len(fits)))
        for _ in range(steps):
            if not moving:
                break
            found, at = _sums(rows, [fits[i] for i in moving]), 0
            still = []
            for i in moving:
                own = found[at : at + len(fits[i])]
                at += len(fits[i])
                filled = own[:, 0] > 0
                moved = fits[i].copy()
                moved[filled] = own[filled, 1:-2] / own[filled, :1]
                if ((moved - fits[i]) ** 2).sum(axis=1).max() > tolerance**2:
                    still.append(i)
                fits[i] = moved
            moving = still
        found = np.split(_sums(rows, fits), np.cumsum([len(f) for f in fits])[:-1])
    finally:
        rows.unpersist()
    best: dict[int, KMeansFit] = {}
    for centres, sums in zip(fits, found):
        cost = float(sums[:, -1].sum())
        k = len(centres)
        if k not in best or cost < best[k].summary.trainingCost:
            best[k] = KMeansFit(centres, Summary(cost, [int(n) for n in sums[:, 0]]))
    return best


def squared_silhouettes(vectors: DataFrame, models: Mapping[int, KMeansFit]) -> dict[int, float]:
    """Mean silhouette of all rows with squared distances for every model: two scans for all of them."""
    ks = sorted(models)
    rows = vectors.select(vector_to_array("features").alias("x"))
    fits = [models[k].centres for k in ks]
    sums = _sums(rows, fits)
    centres, first = np.concatenate(fits), np.cumsum([0, *map(len, fits)])
    count = sums[:, 0]
    mean, square = sums[:, 1:-2] / np.maximum(count, 1)[:, None], sums[:, -2] / np.maximum(count, 1)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(fits)), 0
        for batch in batches:
            whole = _coordinates(batch)
            n += len(whole)
            for at in range(0, len(whole), 4096):
                x = whole[at : at + 4096]
                # Mean squared distance of a row to all rows of a cluster.
                gaps = np.maximum((x**2).sum(axis=1)[:, None] - 2 * (x @ mean.T) + square, 0.0)
                gaps[:, count == 0] = np.inf
                for fit, own, _ in _nearest(x, centres, first):
                    here = np.arange(len(x))
                    inner = gaps[here, own] * count[own] / np.maximum(count[own] - 1, 1)
                    others = gaps[:, first[fit] : first[fit + 1]].copy()
                    others[here, own - first[fit]] = np.inf
                    outer = others.min(axis=1)
                    width = np.maximum(inner, outer)
                    able = (count[own] > 1) & np.isfinite(outer) & (width > 0)
                    total[fit] += ((outer - inner)[able] / width[able]).sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(fits))), pa.array(total), pa.array(np.full(len(fits), n))], names=["fit", "total", "n"]
        )

    found = rows.mapInArrow(measure, "fit long, total double, n long").groupBy("fit").agg(F.sum("total"), F.sum("n")).collect()
    return {ks[r[0]]: float(r[1] / r[2]) if r[2] else 0.0 for r in found}


def sweep_k(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    ks: Sequence[int] = K_RANGE,
    n_init: int = RESTARTS,
    seed: int = SEED,
    sample: int | None = None,
) -> Sweep:
    """Fit every k on cached vectors and score all of them by the silhouette of all rows.

    The silhouette uses squared distances, which takes linear time. ``sample`` instead scores that many
    rows, the same for every k, by plain distances between all pairs of them. ``df`` should be frozen; the
    cache then only saves time, losing it changes nothing.
    """
    vectors = with_vector(df.select(key, *columns), columns).select(key, "features").persist()
    try:
        models = fit_kmeans(vectors, ks, n_init, seed)
        if sample is None:
            scores = squared_silhouettes(vectors, models)
        else:
            points = hashed_sample(vectors, key, sample, seed)
            for k, model in models.items():
                points = model.setPredictionCol(f"__label{k}").transform(points)
            scores = silhouettes(points, {k: f"__label{k}" for k in ks})
    finally:
        vectors.unpersist()
    return Sweep(models, scores)


def silhouette(points: DataFrame, label: str) -> float:
    """Mean silhouette of all rows with squared distances, from one vector of sums per cluster."""
    labelled = points.select("features", F.col(label).cast("double").alias("prediction"))
    if labelled.select("prediction").distinct().limit(2).count() < 2:
        return 0.0
    return float(ClusteringEvaluator(featuresCol="features", predictionCol="prediction").evaluate(labelled))


def silhouettes(points: DataFrame, labels: Mapping[int, str], most: int = 20_000) -> dict[int, float]:
    """Mean Euclidean silhouette of a bounded sample under several labellings; more than ``most`` rows are refused.

    The sample is sent to every task once, and each task measures the distances of its own share of
    the points; one distance matrix block serves all labellings.
    """
    names = list(labels)
    table = points.select(
        vector_to_array("features").alias("x"), F.array(*[F.col(labels[n]) for n in names]).alias("y")
    )
    local = table.limit(most + 1).toPandas()
    if len(local) > most:
        raise ValueError(f"plain distances are for samples of at most {most} rows; use silhouette for all rows")
    coordinates = np.array(local["x"].tolist(), dtype=float)
    assigned = np.array(local["y"].tolist(), dtype=int)
    shared = points.sparkSession.sparkContext.broadcast((coordinates, assigned))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        others, other_labels = shared.value
        rows = np.arange(len(others))
        for batch in batches:
            for start in range(0, len(batch), 256):
                mine = batch["position"].to_numpy()[start : start + 256]
                gaps = np.linalg.norm(others[mine][:, None, :] - others[None, :, :], axis=2)
                sums, sizes = [], []
                for j in range(other_labels.shape[1]):
                    groups, inverse = np.unique(other_labels[:, j], return_inverse=True)
                    member = np.zeros((len(rows), len(groups)))
                    member[rows, inverse] = 1.0
                    count = member.sum(axis=0)
                    total = gaps @ member
                    own = inverse[mine]
                    at = np.arange(len(mine))
                    inner = total[at, own] / np.maximum(count[own] - 1, 1)
                    outer = total / count
                    outer[at, own] = np.inf
                    nearest = outer.min(axis=1)
                    width = np.maximum(inner, nearest)
                    score = np.where((count[own] > 1) & (width > 0), (nearest - inner) / np.where(width > 0, width, 1), 0.0)
                    if len(groups) < 2:
                        score = np.zeros(len(mine))
                    sums.append(float(score.sum()))
                    sizes.append(len(mine))
                yield pd.DataFrame({"labelling": range(len(sums)), "total": sums, "n": sizes})

    positions = points.sparkSession.range(len(local)).select(F.col("id").alias("position"))
    parts = positions.mapInPandas(measure, "labelling long, total double, n long")
    found = parts.groupBy("labelling").agg((F.sum("total") / F.sum("n")).alias("score")).collect()
    shared.unpersist()
    return {names[r["labelling"]]: float(r["score"]) for r in found}


def assign_clusters(
    df: DataFrame, columns: Sequence[str], model: KMeansFit, rank_by: str, name: str = "cluster"
) -> DataFrame:
    """Label rows, numbering clusters from 0 by falling mean of ``rank_by`` so that names are stable."""
    labelled = model.transform(with_vector(df, columns)).withColumnRenamed("prediction", "__raw").drop("features")
    means = labelled.groupBy("__raw").agg(F.avg(F.col(rank_by).cast("double")).alias("m")).collect()
    order = {row["__raw"]: i for i, row in enumerate(sorted(means, key=lambda r: (-r["m"], r["__raw"])))}
    mapping = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    return labelled.withColumn(name, F.element_at(mapping, F.col("__raw"))).drop("__raw")
