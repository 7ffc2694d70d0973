"""The plain Euclidean silhouette of all rows, with a proven bound on its error.

Rows are summed up in cells of a grid, as fine as a bounded number of cells allows, and the cells of a label in a
tree of coarser ones. For a row, the distances to all rows of a cell add up to at least n times the distance D to
their mean, since a distance is convex; and to at most m / (2 (D - r)) more, m being the squared spread of the
cell and r its radius, or sqrt(n m) more where the row is too near for that. A cell whose margin is small enough
counts as a whole, the others are opened. Bounds of the sums are bounds of every row's silhouette and so of the
mean; where cells hold single points, nothing is left open.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cells that the driver holds and every task gets; bits of a coordinate at most; pairs of rows and cells at a time.
MOST_CELLS = 20_000
MOST_BITS = 24
PAIRS = 400_000


@dataclass(frozen=True)
class BoundedScore:
    """The true mean silhouette lies within ``bound`` of ``silhouette``."""

    silhouette: float
    bound: float
    rows: int
    cells: int


@dataclass(frozen=True)
class Tree:
    """Cells of all levels: rows, mean, squared spread, radius, label, and the range of cells it is made of."""

    count: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    radius: np.ndarray
    label: np.ndarray
    first: np.ndarray
    size: np.ndarray
    roots: np.ndarray


def _bins(columns: Sequence[str], low: Sequence[float], high: Sequence[float], bits: int) -> list[Column]:
    """Number of the cell of a row in each dimension."""
    return [
        F.least(F.floor((F.col(c).cast("double") - F.lit(a)) * F.lit((1 << bits) / (b - a if b > a else 1.0))), F.lit((1 << bits) - 1)).cast("long")
        for c, a, b in zip(columns, low, high)
    ]


def _cells(points: DataFrame, columns: Sequence[str], label: str, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels, bins, moments) of the finest grid with at most ``most`` cells."""
    ends = points.agg(*[F.min(F.col(c).cast("double")) for c in columns], *[F.max(F.col(c).cast("double")) for c in columns]).first()
    width = len(columns)
    low, high = list(ends[:width]), list(ends[width:])
    if low[0] is None:
        return np.zeros(0, dtype=np.int64), np.zeros((0, width), dtype=np.int64), np.zeros((0, 1 + 4 * width))
    sketches = [F.hll_sketch_agg(F.xxhash64(label, *_bins(columns, low, high, b)), 12) for b in range(1, MOST_BITS + 1)]
    estimates = points.agg(*[F.hll_sketch_estimate(s) for s in sketches]).first()
    bits = max([b for b, n in enumerate(estimates, 1) if n <= most], default=0)
    moments = [f(F.col(c).cast("double")) for c in columns for f in (F.sum, lambda x: F.sum(x * x), F.min, F.max)]
    while True:
        binned = points.select(F.col(label).alias("__label"), *columns, *[b.alias(f"__b{i}") for i, b in enumerate(_bins(columns, low, high, bits))])
        grid = binned.groupBy("__label", *[f"__b{i}" for i in range(width)]).agg(F.count(F.lit(1)), *moments)
        found = grid.limit(most + 1).collect()
        if len(found) <= most or not bits:
            break
        bits -= 1
    if len(found) > most:
        raise ValueError(f"more than {most} labels")
    table = np.array([tuple(r) for r in found], dtype=float)
    return table[:, 0].astype(np.int64), table[:, 1 : 1 + width].astype(np.int64), table[:, 1 + width :]


def build_tree(labels: np.ndarray, bins: np.ndarray, moments: np.ndarray) -> Tree:
    """Cells of halved resolution over the given ones, up to one cell for each label."""
    width = bins.shape[1]
    _, label = np.unique(labels, return_inverse=True)
    levels, offset = [], 0
    first, size = np.zeros(len(label), dtype=np.int64), np.zeros(len(label), dtype=np.int64)
    while True:
        if len(label) == len(np.unique(label)):
            levels.append((label, moments, first, size))
            break
        # Cells of one coarser cell stand side by side.
        coarse = bins >> 1
        key = np.column_stack([label, coarse])
        parents, parent = np.unique(key, axis=0, return_inverse=True)
        parent = parent.ravel()
        order = np.argsort(parent, kind="stable")
        label, bins, moments, first, size, parent = label[order], bins[order], moments[order], first[order], size[order], parent[order]
        levels.append((label, moments, first, size))
        begin = np.searchsorted(parent, np.arange(len(parents)))
        sums = np.empty((len(parents), moments.shape[1]))
        sums[:, 0] = np.add.reduceat(moments[:, 0], begin)
        for i in range(width):
            at = 1 + 4 * i
            for column, of in ((at, np.add), (at + 1, np.add), (at + 2, np.minimum), (at + 3, np.maximum)):
                sums[:, column] = of.reduceat(moments[:, column], begin)
        first, size = offset + begin, np.diff(np.append(begin, len(parent)))
        offset += len(label)
        label, bins, moments = parents[:, 0], parents[:, 1:], sums
    label, moments, first, size = (np.concatenate(c) for c in zip(*levels))
    count = moments[:, 0]
    sums, squares, least, most = (moments[:, 1 + i :: 4] for i in range(4))
    mean = np.clip(sums / count[:, None], least, most)
    inside = (count > 1) & (most > least).any(axis=1)
    spread = np.where(inside, np.maximum((squares - count[:, None] * mean**2).sum(axis=1), 0.0), 0.0)
    radius = np.where(inside, np.sqrt((np.maximum(most - mean, mean - least) ** 2).sum(axis=1)), 0.0)
    # Rounding of the squares must not make a spread too small.
    spread = np.where(inside, np.minimum(spread + 1e-12 * squares.sum(axis=1), count * radius**2), 0.0)
    roots = np.arange(len(count) - len(np.unique(label)), len(count))
    return Tree(count, mean, spread, radius, label, first, size, roots)


def distance_sums(x: np.ndarray, tree: Tree, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the sums of distances of each row to the rows of each label.

    About ``PAIRS`` pairs of rows and cells are measured at a time; cells wait closed until their turn.
    """
    if tolerance <= 0:
        return _finest_sums(x, tree)
    labels = len(tree.roots)
    low, high = np.zeros((len(x), labels)), np.zeros((len(x), labels))
    row, cell = np.repeat(np.arange(len(x)), labels), np.tile(tree.roots, len(x))
    ready = [(row[at : at + PAIRS], cell[at : at + PAIRS]) for at in range(0, len(row), PAIRS)]
    closed = []
    while ready or closed:
        if ready:
            row, cell = ready.pop()
        else:
            row, cell = closed.pop()
            size = tree.size[cell]
            begin = np.cumsum(size) - size
            row, cell = np.repeat(row, size), np.repeat(tree.first[cell] - begin, size) + np.arange(int(size.sum()))
        gap = np.sqrt(((x[row] - tree.mean[cell]) ** 2).sum(axis=1))
        n = tree.count[cell]
        margin = _margin(gap, n, tree.spread[cell], tree.radius[cell])
        done = (tree.size[cell] == 0) | (margin <= tolerance * n * gap)
        at = row[done] * labels + tree.label[cell[done]]
        low += np.bincount(at, (n * gap)[done], low.size).reshape(low.shape)
        high += np.bincount(at, (n * gap + margin)[done], low.size).reshape(low.shape)
        row, cell = row[~done], cell[~done]
        if len(row):
            # Cells whose parts fill one step are opened together, the last ones first.
            parts = np.flatnonzero(np.diff(np.cumsum(tree.size[cell]) // PAIRS)) + 1
            closed += zip(np.split(row, parts), np.split(cell, parts))
    return low, high


def _margin(gap: np.ndarray, n: np.ndarray, spread: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """How much more the distances to the rows of a cell can add up to than n times the one to their mean."""
    clear = gap - radius
    margin = np.broadcast_to(np.sqrt(n * spread), gap.shape)
    return np.where(clear > 0, np.minimum(margin, spread / (2 * np.where(clear > 0, clear, 1.0))), margin)


def _finest_sums(x: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """The same where every cell is opened: rows against the finest cells, some rows at a time."""
    finest = np.flatnonzero(tree.size == 0)
    finest = finest[np.argsort(tree.label[finest], kind="stable")]
    mean, n, spread, radius = tree.mean[finest], tree.count[finest], tree.spread[finest], tree.radius[finest]
    begin = np.searchsorted(tree.label[finest], np.arange(len(tree.roots)))
    wide = np.flatnonzero(spread > 0)
    low, high = (np.zeros((len(x), len(tree.roots))) for _ in range(2))
    step = max(1, PAIRS // len(finest))
    for at in range(0, len(x), step):
        gap = np.sqrt(sum((x[at : at + step, i, None] - mean[:, i]) ** 2 for i in range(x.shape[1])))
        sums = gap * n
        low[at : at + step] = np.add.reduceat(sums, begin, axis=1)
        sums[:, wide] += _margin(gap[:, wide], n[wide], spread[wide], radius[wide])
        high[at : at + step] = np.add.reduceat(sums, begin, axis=1)
    return low, high


def silhouette_bounds(low: np.ndarray, high: np.ndarray, own: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the silhouette of each row, from bounds of its sums of distances to each label."""
    here = np.arange(len(own))
    others = np.maximum(count[own] - 1, 1)

    def score(inner: np.ndarray, sums: np.ndarray) -> np.ndarray:
        means = sums / count
        means[here, own] = np.inf
        outer = means.min(axis=1)
        width = np.maximum(inner, outer)
        able = (count[own] > 1) & np.isfinite(outer) & (width > 0)
        return np.where(able, (outer - inner) / np.where(able, width, 1.0), 0.0)

    return score(high[here, own] / others, low), score(low[here, own] / others, high)


def plain_silhouette(
    points: DataFrame, columns: Sequence[str], label: str, tolerance: float = 0.01, most_cells: int = MOST_CELLS
) -> BoundedScore:
    """Mean plain silhouette of all rows (no NULL in ``columns`` and ``label``; an integer label).

    ``tolerance`` is the margin of a cell, relative to its sum of distances, from which on it is opened; 0 opens
    every cell. ``points`` is read four times and should be frozen. Without rows, or with one label, it is 0.
    """
    labels, bins, moments = _cells(points, columns, label, most_cells)
    if len(np.unique(labels)) < 2:
        return BoundedScore(0.0, 0.0, int(moments[:, 0].sum()), len(labels))
    tree, names = build_tree(labels, bins, moments), np.unique(labels)
    count = np.bincount(np.searchsorted(names, labels), moments[:, 0])
    shared = points.sparkSession.sparkContext.broadcast((tuple(vars(tree).values()), names, count))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, known, sizes = shared.value
        own_tree, total = Tree(*arrays), np.zeros(3)
        step = max(1, PAIRS // (len(known) * 64))
        for batch in batches:
            own = np.searchsorted(known, batch.column(0).to_numpy())
            x = np.column_stack([c.to_numpy() for c in batch.columns[1:]])
            for at in range(0, len(own), step):
                low, high = distance_sums(x[at : at + step], own_tree, tolerance)
                least, most = silhouette_bounds(low, high, own[at : at + step], sizes)
                total += least.sum(), most.sum(), len(least)
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], names=["low", "high", "n"])

    read = points.select(F.col(label).cast("long"), *[F.col(c).cast("double") for c in columns])
    found = read.mapInArrow(measure, "low double, high double, n double").agg(F.sum("low"), F.sum("high"), F.sum("n")).first()
    shared.unpersist()
    low, high = found[0] / found[2], found[1] / found[2]
    return BoundedScore((low + high) / 2, (high - low) / 2, int(found[2]), len(labels))
