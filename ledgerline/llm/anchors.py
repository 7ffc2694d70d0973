"""Shards of regions that may hold repeated windows, found by content-defined anchors.

A window is ``width`` consecutive symbols (bytes or words) of one text. Its anchor is the gram of
``gram`` symbols inside it with the least hash, the leftmost of several. Equal windows have equal anchors
at equal distance, so windows can only repeat where an anchor repeats. Consecutive windows with one anchor
form a run; the region of a run is all symbols its windows cover.

Texts are read once for the anchors and once for the regions of repeated anchors. Equal regions are kept
once, with map-side combining, so groups of copies cost one region. Regions with one anchor go to one
shard, whose size does not grow with the data. An anchor whose distinct regions alone are more than a shard
should hold, say a common line in changing surroundings, is hot: its windows travel singly instead and are
grouped by their own content, which is exact and has no hot key beyond map-side combining.

In a periodic stretch every window, or every few, has an anchor of its own, all with one hash. Neighbouring
runs of one hash and one length are joined, so that the regions of a stretch are not ``width`` times its size.

Row numbers are given once and written with their rows; all later passes read that copy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stash

PIECE = 1 << 22
REGION_BYTES = 1 << 24
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACES = (9, 10, 11, 12, 13, 32)


@dataclass(frozen=True)
class Windows:
    """What a symbol is, how long a window is and how long the anchor gram, and the symbols of one shard."""

    unit: str
    width: int
    gram: int
    shard: int

    def region_of(self, text: str | None) -> Callable[[int, int], bytes]:
        """Content of a stretch of symbols: bytes as they are, or words joined by one space."""
        raw = (text or "").encode("utf-8")
        if self.unit == "byte":
            return lambda first, last: raw[first:last]
        words = raw.split()
        return lambda first, last: b" ".join(words[first:last])

    def windows_of(self, content: bytes) -> list[bytes]:
        """Content of every window of a region."""
        symbols = content if self.unit == "byte" else content.split(b" ")
        parts = (symbols[i : i + self.width] for i in range(len(symbols) - self.width + 1))
        return list(parts) if self.unit == "byte" else [b" ".join(p) for p in parts]


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: One scrambled number for each byte.
BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    up, down = np.full(n, BASE), np.full(n, UNBASE)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def span_hash(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of values[first:last], wherever the span lies."""
    up, down = _powers(len(values) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * up[:-1], dtype=np.uint64)])
    return mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of each word between ASCII white space."""
    inside = np.ones(len(raw) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~np.isin(raw, _SPACES)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def symbols_of(text: bytes, unit: str) -> np.ndarray:
    """Bytes of a text as they are, or one 64-bit number for each word."""
    raw = np.frombuffer(text, dtype=np.uint8)
    if unit == "byte":
        return raw
    first, last = word_bounds(raw)
    if not len(first):
        return np.zeros(0, dtype=np.uint64)
    return span_hash(BYTES[raw], first, last)


def _least_in_windows(keys: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` consecutive keys, in two sweeps over blocks."""
    n = len(keys)
    blocks = -(-n // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = keys
    table = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - span + 1], ahead[span - 1 : n])


def runs_of(symbols: np.ndarray, spec: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window, last window, anchor hash."""
    found = []
    scale = BYTES[symbols] if spec.unit == "byte" else symbols
    span = spec.width - spec.gram + 1
    for at in range(0, max(0, len(symbols) - spec.width + 1), PIECE):
        part = scale[at : at + PIECE + spec.width - 1]
        starts = np.arange(len(part) - spec.gram + 1)
        hashes = span_hash(part, starts, starts + spec.gram)
        place = np.uint64(PIECE * 2 - 1)
        # The place breaks ties, so the leftmost of equal grams is the least.
        least = _least_in_windows((hashes & ~place) | starts.astype(np.uint64), span)
        anchor = (least & place).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.append(new[1:], len(anchor)) - 1
        found.append((at + new, at + last, hashes[anchor[new]].view(np.int64)))
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    return tuple(np.concatenate(c) for c in zip(*found))


def joined_runs(first: np.ndarray, last: np.ndarray, anchor: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Neighbouring runs of one anchor hash and one length, joined: first, last, anchor hash, number of runs.

    The sizes of the parts of a stretch are powers of two, so long stretches of any length share few regions.
    A part has at most four times ``width`` windows, if it is not a single run.
    """
    if not len(first):
        return first, last, anchor, np.zeros(0, dtype=np.int64)
    size = last - first + 1
    chain = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (size[1:] != size[:-1])]))
    runs = np.diff(np.append(chain, len(first)))
    # The largest power of two of runs that stays below the limit.
    most = np.int64(1) << (np.frexp(np.maximum(1, 4 * width // size[chain]).astype(np.float64))[1] - 1).astype(np.int64)
    whole, rest = np.repeat(runs - runs % most, runs), np.repeat(runs % most, runs)
    place = np.arange(len(first)) - np.repeat(chain, runs)
    # What is left over is cut where the bits of its number say.
    over = place - whole
    cut = (over == 0) | (((over & ~rest) == 0) & ((rest ^ over) < (over & -over)))
    start = np.flatnonzero(np.where(over < 0, place % np.repeat(most, runs) == 0, cut))
    end = np.append(start[1:], len(first)) - 1
    return first[start], last[end], anchor[start], end - start + 1


def _sketch(spec: Windows):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, ranks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at in range(0, len(uids), 512):
                columns = [[] for _ in range(6)]
                for uid, rank, text in zip(uids[at : at + 512], ranks[at : at + 512], batch.column(2).slice(at, 512)):
                    own = runs_of(symbols_of((text.as_py() or "").encode("utf-8"), spec.unit), spec)
                    own = joined_runs(*own, spec.width)
                    for column, values in zip(columns, (np.full(len(own[0]), uid), np.full(len(own[0]), rank), *own)):
                        column.append(values)
                arrays = [pa.array(np.concatenate(c), type=pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=["uid", "rank", "first", "last", "anchor", "runs"])

    return sketch


def content_key(content: bytes) -> bytes:
    return blake2b(content, digest_size=16).digest()


def _regions(spec: Windows, most: int = REGION_BYTES):
    names = ["uid", "rank", "first", "anchor", "windows", "region", "content"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 5 + [pa.binary()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for uid, rank, text, runs in zip(*(batch.column(i) for i in range(4))):
                region, uid, rank = spec.region_of(text.as_py()), uid.as_py(), rank.as_py()
                for first, last, anchor in zip(*(c.to_numpy() for c in runs.values.flatten())):
                    content = region(first, last + spec.width)
                    rows.append((uid, rank, first, anchor, last - first + 1, content_key(content), content))
                    held += len(content) + 100
                    # A batch is bounded by its bytes, within one document too.
                    if held > most:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return regions


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(uid, doc_id, rank, text): uid tells repeated rows apart, rank orders ids with null ids last.

    Written once, since another job may cut the same files into other partitions and number other rows so.
    """
    rank = F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1))
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(doc_id).alias("doc_id"), rank.alias("rank"), F.col(text).alias("text")
    )
    return stash(rows, "numbered")


def candidate_regions(rows: DataFrame, spec: Windows, across: bool) -> DataFrame:
    """Regions of repeated anchors: (uid, rank, first, anchor, windows, region, content), on shared disk.

    ``across``: an anchor only counts as repeated if it occurs under two ranks.
    """
    kind = "uid long, rank long, first long, last long, anchor long, runs long"
    found = stash(rows.select("uid", "rank", "text").mapInArrow(_sketch(spec), kind), "anchors")
    if across:
        repeated = found.groupBy("anchor").agg(F.min("rank").alias("a"), F.max("rank").alias("b")).where("a <> b")
    else:
        repeated = found.groupBy("anchor").agg(F.sum("runs").alias("n")).where("n > 1")
    narrow = found.select("uid", F.col("first").cast("int"), F.col("last").cast("int"), "anchor")
    runs = (
        narrow.join(repeated.select("anchor"), "anchor", "left_semi")
        .groupBy("uid")
        .agg(F.collect_list(F.struct("first", "last", "anchor")).alias("runs"))
    )
    wanted = rows.select("uid", "rank", "text").join(runs, "uid").select("uid", "rank", "text", "runs")
    kind = "uid long, rank long, first long, anchor long, windows long, region binary, content binary"
    return stash(wanted.mapInArrow(_regions(spec), kind), "regions")


def split_hot(regions: DataFrame, spec: Windows) -> tuple[DataFrame, DataFrame]:
    """Regions of ordinary anchors, and those of anchors with more than a shard of distinct regions."""
    kinds = regions.select("anchor", "region", "windows").distinct()
    held = kinds.groupBy("anchor").agg(F.sum(F.col("windows") + spec.width).alias("symbols"))
    crowded = stash(held.where(F.col("symbols") > spec.shard).select("anchor"), "hot-anchors")
    # Hot anchors are few among many; the join leaves the choice of a broadcast to their real size.
    return regions.join(crowded, "anchor", "left_anti"), regions.join(crowded, "anchor", "left_semi")


def sharded(distinct: DataFrame, symbols: int, spec: Windows) -> DataFrame:
    """Give regions of one anchor one shard, with as many shards as ``symbols`` ask for."""
    count = max(1, -(-int(symbols) // spec.shard))
    return distinct.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(count)))
