"""Substring deduplication over words with a compressed FM-index for each shard.

A word goes if it is covered by a window of ``width`` words whose words also start in a document with a
smaller id. Content-defined anchors (module ``anchors``) route regions of documents to the shards that can
hold their matches. Each shard indexes its distinct regions: suffix order, Burrows-Wheeler transform, and
a wavelet tree whose bits are packed with sampled counts. The documents' windows are then streamed against
the index by backward search; a window whose interval shrinks to itself is given up at once, and the others
report the smallest document in their interval. Runs of such windows are the intervals above threshold.

Regions travel as their words. In a shard words are named by their bytes and windows by their place in the suffix
order; hashes of words only choose anchors, and equal regions are known by a 128-bit digest.

Defined results: null texts have no words; null ids count as larger than all others; repeated rows with one
id do not remove each other, since neither id is smaller; repeats inside one document stay; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import anchors
from ledgerline.llm.anchors import Windows
from ledgerline.llm.common import stash, texts_function
from ledgerline.llm.repeated_bytes import covered_runs, runs_of_true, single_windows
from ledgerline.llm.suffixes import suffix_order

WIDTH = 50
GRAM = 20
SHARD_WORDS = 250_000
FAR = np.iinfo(np.int64).max


class WaveletTree:
    """Ranks of symbols in a sequence, by levels of packed bits with a count before every 64 bits."""

    def __init__(self, sequence: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.levels = []
        for level in range(self.bits - 1, -1, -1):
            ones = ((sequence >> level) & 1).astype(bool)
            padded = np.zeros((len(ones) // 64 + 1) * 64, dtype=np.uint8)
            padded[: len(ones)] = ones
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
            self.levels.append((words, counts, int(len(ones) - ones.sum())))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])
        symbols = np.arange(top + 1)
        self.start = np.zeros(top + 1, dtype=np.int64)
        self.start = self._down(symbols, np.zeros(top + 1, dtype=np.int64))

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for depth, (words, counts, zeros) in enumerate(self.levels):
            block, inside = places >> 6, (places & 63).astype(np.uint64)
            below = (np.uint64(1) << inside) - np.uint64(1)
            ones = counts[block] + np.bitwise_count(words[block] & below)
            bit = (symbols >> (self.bits - 1 - depth)) & 1
            places = np.where(bit == 1, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._down(symbols, places) - self.start[symbols]


class LeastOfRange:
    """Minima of ranges from minima of stretches whose lengths are powers of two."""

    def __init__(self, values: np.ndarray):
        self.values = values
        tables, span = [values], 1
        while 2 * span <= len(values):
            last = tables[-1]
            joined = np.full(len(values), FAR, dtype=np.int64)
            joined[: len(values) - 2 * span + 1] = np.minimum(last[: len(values) - 2 * span + 1], last[span : len(values) - span + 1])
            tables.append(joined)
            span *= 2
        self.tables = np.stack(tables)

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of values[low:high] for each range, none of them empty."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        return np.minimum(self.tables[level, low], self.tables[level, high - (1 << level.astype(np.int64))])


class FMIndex:
    """Backward search over a sequence of integers; its last symbol must be its only least one."""

    def __init__(self, symbols: np.ndarray):
        self.order = suffix_order(symbols)
        top = int(symbols.max())
        self.tree = WaveletTree(symbols[self.order - 1], top)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol in front."""
        base = self.smaller[symbols]
        return base + self.tree.rank(symbols, low), base + self.tree.rank(symbols, high)


def window_classes(symbols: np.ndarray, order: np.ndarray, width: int) -> np.ndarray:
    """A number for each place, equal for places whose ``width`` symbols are equal: neighbours in suffix order, compared symbol by symbol."""
    padded = np.concatenate([symbols, np.zeros(width, dtype=symbols.dtype)])
    alive = np.arange(len(order) - 1)
    for step in range(width):
        alive = alive[padded[order[alive] + step] == padded[order[alive + 1] + step]]
    new = np.ones(len(order), dtype=np.int64)
    new[alive + 1] = 0
    classes = np.empty(len(order), dtype=np.int64)
    classes[order] = np.cumsum(new)
    return classes


def _smallest_in_shard(width: int):
    def smallest(group: pd.DataFrame) -> pd.DataFrame:
        """Runs of windows of each region, with the smallest rank that has them, if that can matter."""
        contents = [c.split(b" ") for c in group["content"]]
        sizes = np.array([len(c) for c in contents])
        starts = np.cumsum(sizes + 1) - sizes - 1
        # 1 ends the text, 2 a region, words count from 3. Words are told apart by their bytes, never by a hash.
        names = {w: i for i, w in enumerate(sorted(set().union(*contents)))}
        words = np.fromiter((names[w] for c in contents for w in c), dtype=np.int64, count=int(sizes.sum()))
        owner = np.repeat(np.arange(len(contents)), sizes + 1)
        offset = np.arange(len(owner)) - starts[owner]
        symbols = np.full(len(owner) + 1, 2, dtype=np.int64)
        symbols[:-1][offset < sizes[owner]] = words + 3
        symbols[-1] = 1
        index = FMIndex(symbols)
        least, most = group["least"].to_numpy(), group["most"].to_numpy()
        ranks = LeastOfRange(np.append(least[owner], FAR)[index.order])

        # Equal windows of several regions are one pattern, which matters up to its largest rank.
        window = np.flatnonzero(offset <= sizes[owner] - width)
        _, place, pattern = np.unique(window_classes(symbols, index.order, width)[window], return_index=True, return_inverse=True)
        reach = np.full(len(place), -FAR, dtype=np.int64)
        np.maximum.at(reach, pattern, most[owner[window]])

        alive, low, high = np.arange(len(place)), np.zeros(len(place), dtype=np.int64), np.full(len(place), len(symbols))
        for step in range(width - 1, -1, -1):
            low, high = index.extend(symbols[window[place[alive]] + step], low, high)
            # A longer match lies in a part of the interval, so nothing below the reach can turn up any more.
            single = high - low == 1
            keep = ~single | (ranks.values[low] < reach[alive])
            if step % 4 == 0:
                keep &= ranks.least(low, high) < reach[alive]
            alive, low, high = alive[keep], low[keep], high[keep]
        smallest_of = np.full(len(place), FAR, dtype=np.int64)
        smallest_of[alive] = ranks.least(low, high)
        found = smallest_of[pattern]
        matters = found < most[owner[window]]
        window, found = window[matters], found[matters]
        # Neighbouring windows of one region with one smallest rank make one run.
        new = np.ones(len(window), dtype=bool)
        new[1:] = (window[1:] != window[:-1] + 1) | (found[1:] != found[:-1]) | (owner[window[1:]] != owner[window[:-1]])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(window)) - 1
        region = owner[window[first]] if len(first) else np.zeros(0, dtype=np.int64)
        return pd.DataFrame(
            {
                "anchor": group["anchor"].to_numpy()[region],
                "region": group["region"].to_numpy()[region],
                "a": window[first] - starts[region] if len(first) else region,
                "b": window[last] - starts[region] if len(first) else region,
                "smallest": found[first],
            }
        )

    return smallest


def matching_intervals(rows: DataFrame, width: int = WIDTH, gram: int = GRAM, shard: int = SHARD_WORDS) -> DataFrame:
    """(uid, first, last, smallest): runs of windows that also start under a smaller rank."""
    spec = Windows("word", width, gram, shard)
    regions = anchors.candidate_regions(rows, spec, across=True)
    usual, crowded = anchors.split_hot(regions, spec)
    distinct = usual.groupBy("anchor", "region").agg(
        F.min("rank").alias("least"), F.max("rank").alias("most"), F.first("content").alias("content")
    )
    symbols = usual.agg(F.sum(F.col("windows") + width)).first()[0] or 0
    sharded = anchors.sharded(distinct, symbols, spec)
    found = sharded.groupBy("shard").applyInPandas(
        _smallest_in_shard(width), "anchor long, region binary, a long, b long, smallest long"
    )
    owners = usual.select("anchor", "region", "uid", "rank", "first")
    usual_runs = owners.join(found, ["anchor", "region"]).where("smallest < rank")
    usual_runs = usual_runs.select(
        "uid", (F.col("first") + F.col("a")).alias("first"), (F.col("first") + F.col("b")).alias("last"), "smallest"
    )
    single = crowded.select("uid", "first", "content", "rank").mapInArrow(
        single_windows(spec), "uid long, place long, window binary, rank long"
    )
    lowest = single.groupBy("window").agg(F.min("rank").alias("smallest"), F.max("rank").alias("most"))
    lowest = lowest.where("smallest < most").select("window", "smallest")
    crowded_runs = single.join(lowest, "window").where("smallest < rank")
    place = F.col("place")
    return usual_runs.unionByName(crowded_runs.select("uid", place.alias("first"), place.alias("last"), "smallest"))


def _kept(width: int):
    spans = "array<struct<first:long,last:long>>"

    def kept(batches):
        kind = pa.struct(
            [
                ("n_words", pa.int64()),
                ("removed", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                ("kept_sha256", pa.string()),
            ]
        )
        for texts, spans in batches:
            rows = []
            for text, own in zip(texts, spans):
                words, parts, at = (text.as_py() or "").encode("utf-8").split(), [], 0
                runs = covered_runs(own.as_py(), width)
                for first, last in runs:
                    parts += words[at:first]
                    at = last
                digest = sha256(b" ".join([*parts, *words[at:]])).hexdigest()
                removed = [{"first": a, "last": b} for a, b in runs]
                rows.append({"n_words": len(words), "removed": removed, "kept_sha256": digest})
            yield pa.array(rows, type=kind)

    return texts_function(kept, f"struct<n_words:long,removed:{spans},kept_sha256:string>")


def remove_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM, shard: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, removed, kept_sha256): ``removed`` holds the maximal removed runs of words."""
    rows = anchors.numbered(docs, doc_id, text)
    runs = matching_intervals(rows, width, gram, shard)
    spans = stash(runs.groupBy("uid").agg(F.collect_set(F.struct("first", "last")).alias("spans")), "spans")
    judged = rows.join(spans, "uid", "left").select("doc_id", _kept(width)(F.col("text"), F.col("spans")).alias("k"))
    return judged.select("doc_id", "k.n_words", "k.removed", "k.kept_sha256")
