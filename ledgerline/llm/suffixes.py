"""Suffix order of one shard by the difference-cover method, and exact comparison of adjacent prefixes.

The caller bounds the size of a shard; everything here works on one numpy array.
"""

from __future__ import annotations

import numpy as np


def _ranks_of(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks from 1, and how many differ."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    steps = np.concatenate([[1], (ordered[1:] != ordered[:-1]).astype(np.int64)])
    ranks = np.empty(len(keys), dtype=np.int64)
    ranks[order] = np.cumsum(steps)
    return ranks, int(steps.sum())


def _packed(parts: list[np.ndarray], tops: list[int]) -> np.ndarray:
    """One sort key of several numbers, most significant first; ranked on the way where 63 bits are too few."""
    key, top = parts[0], tops[0]
    for part, high in zip(parts[1:], tops[1:]):
        if (top + 1) * (high + 1) >= 1 << 62:
            key, top = _ranks_of(key)
        key = key * (high + 1) + part
        top = (top + 1) * (high + 1)
    return key


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order. Symbols are integers from 1; the end counts as 0.

    Suffixes at positions not divisible by three are the sample: their triples are sorted and named, and
    the string of names is ordered by recursion until names are unique. The other suffixes follow from one
    symbol and the rank of their successor, and both lists are merged by counting what precedes what.
    """
    n = len(symbols)
    if n < 3:
        padded = [*symbols.tolist(), 0, 0, 0]
        return np.array(sorted(range(n), key=lambda i: padded[i : i + 3]), dtype=np.int64)
    top = int(symbols.max())
    text = np.concatenate([symbols.astype(np.int64), np.zeros(3, dtype=np.int64)])
    # One position past the end keeps the two sampled lists apart when n leaves remainder 1.
    ones = np.arange(1, n + (n % 3 == 1), 3)
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    names, distinct = _ranks_of(_packed([text[sample], text[sample + 1], text[sample + 2]], [top, top, top]))
    if distinct < len(sample):
        order = suffix_order(names)
        names = np.empty(len(sample), dtype=np.int64)
        names[order] = np.arange(1, len(sample) + 1)
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[sample] = names
    many = len(sample) + 1
    sampled = np.empty(len(sample), dtype=np.int64)
    sampled[names - 1] = sample
    sampled = sampled[sampled < n]

    zeros = np.arange(0, n, 3)
    by_one = text[zeros] * (many + 1) + rank[zeros + 1]
    zeros = zeros[np.argsort(by_one, kind="stable")]
    of_one, of_two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    # Against remainder 1: one symbol and the rank after it. Against remainder 2: two symbols, then the rank.
    before = np.searchsorted(text[of_one] * (many + 1) + rank[of_one + 1], text[zeros] * (many + 1) + rank[zeros + 1])
    both = np.concatenate([of_two, zeros])
    key = _packed([text[both], text[both + 1], rank[both + 2]], [top, top, many])
    before = before + np.searchsorted(key[: len(of_two)], key[len(of_two) :])
    order = np.empty(n, dtype=np.int64)
    place = before + np.arange(len(zeros))
    taken = np.zeros(n, dtype=bool)
    taken[place] = True
    order[place] = zeros
    order[~taken] = sampled
    return order


def same_prefix_as_next(symbols: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """For places in suffix order: does each share ``depth`` symbols (below 65,536) with the next one? Exact.

    Four symbols are compared at a time, among the pairs that agree so far.
    """
    padded = np.concatenate([symbols, np.zeros(depth + 4, dtype=symbols.dtype)]).astype(np.uint64)
    four = padded[:-3] << np.uint64(48) | padded[1:-2] << np.uint64(32) | padded[2:-1] << np.uint64(16) | padded[3:]
    alive = np.arange(max(0, len(places) - 1))
    for at in [*range(0, max(1, depth - 3), 4), max(0, depth - 4)]:
        left, right = four[places[alive] + at], four[places[alive + 1] + at]
        if depth < 4:
            left, right = left >> np.uint64(16 * (4 - depth)), right >> np.uint64(16 * (4 - depth))
        alive = alive[left == right]
    same = np.zeros(max(0, len(places) - 1), dtype=bool)
    same[alive] = True
    return same
