"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within distance r share a variant within r/2 of both. Every distinct fingerprint emits
the variants within half the radius; equal variants meet and link their owners. The shuffle key is the
leading bits of a variant: a fingerprint travels once for each choice of flips among those bits, and the
variants of the other bits are made where they meet. The number of leading bits follows the number of
fingerprints, so a bucket stays small at any size; an uneven bucket is worked off in halves.

Owners of one variant are linked to the smallest of them, never pair by pair. Components come from
alternating large-star and small-star steps over distinct fingerprints; documents join at the end.

Defined results: null, empty and white-space texts have fingerprint zero and are linked like any other;
equal texts have equal fingerprints; repeated rows give repeated rows; a null id is never the smallest
unless a component has no other id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stash, text_function

BITS = 64
SEED = 42
PIECE = 1 << 16


def _hashes(words: list[bytes], width: int) -> Iterator[np.ndarray]:
    """XXH64 of the shingles, some ten thousand at a time."""
    whole = b" ".join(words)
    if len(words) <= width:
        yield np.array([xxhash.xxh64_intdigest(whole, SEED)], dtype=np.uint64)
        return
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(words) - width + 1, PIECE):
        stop = min(at + PIECE, len(words) - width + 1)
        yield np.array(
            [digest(whole[a : b - 1], SEED) for a, b in zip(ends[at:stop], ends[at + width : stop + width])],
            dtype=np.uint64,
        )


def simhash_of(text: str | None, width: int) -> int:
    """Signed 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    total, ones = 0, np.zeros(BITS, dtype=np.int64)
    for part in _hashes(words, width):
        total += len(part)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.int64)[0])


def simhash(text: Column, width: int = 4) -> Column:
    """Fingerprint column: a bit is set if it is set in over half of the shingle hashes."""

    def fingerprint(batches):
        for texts in batches:
            yield pa.array([simhash_of(t.as_py(), width) for t in texts], type=pa.int64())

    return text_function(fingerprint, "long")(text)


def _masks(bits: int, flips: int) -> np.ndarray:
    """All words of ``bits`` bits with at most ``flips`` bits set."""
    return np.array(
        [sum(1 << i for i in chosen) for n in range(flips + 1) for chosen in combinations(range(bits), n)],
        dtype=np.uint64,
    )


def _meet(lead: int, half: int, limit: int = 4_000_000) -> Callable:
    """Owners of equal variants in a bucket, linked to the smallest owner."""

    def links_of(owner: np.ndarray, rest: np.ndarray, left: np.ndarray, bits: int) -> list[np.ndarray]:
        masks = {n: _masks(bits, n) for n in range(half + 1)}
        if bits and sum(int((left == n).sum()) * len(masks[n]) for n in masks) > limit:
            # Settle the next bit: one half keeps it, the other reaches it with a flip.
            top = np.uint64(1 << (bits - 1))
            found = []
            for value in (np.uint64(0), top):
                spent = left - ((rest & top) != value)
                keep = spent >= 0
                found += links_of(owner[keep], rest[keep] & ~top, spent[keep], bits - 1)
            return found
        keys, owners = [], []
        for n, mask in masks.items():
            own = left == n
            keys.append((rest[own][:, None] ^ mask[None, :]).ravel())
            owners.append(np.repeat(owner[own], len(mask)))
        key, who = np.concatenate(keys), np.concatenate(owners)
        ordered = np.sort(key)
        shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(shared):
            return []
        at = np.minimum(np.searchsorted(shared, key), len(shared) - 1)
        hit = shared[at] == key
        at, who = at[hit], who[hit]
        order = np.lexsort((who, at))
        at, who = at[order], who[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        smallest = np.repeat(who[first], np.diff(np.append(first, len(who))))
        return [np.unique(np.stack([who, smallest], axis=1)[who != smallest], axis=0)]

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        owner = group["fp"].to_numpy(dtype=np.int64)
        bits = BITS - lead
        rest = owner.view(np.uint64) & np.uint64((1 << bits) - 1)
        found = links_of(owner, rest, group["left"].to_numpy(dtype=np.int64), bits)
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), dtype=np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return meet


def link_fingerprints(fps: DataFrame, count: int, radius: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints of column ``fp`` that join all those within ``radius``."""
    if radius % 2:
        raise ValueError("the radius must be even: each side flips half of it")
    half = radius // 2
    variants = sum(math.comb(BITS, n) for n in range(half + 1))
    lead = min(40, max(4, math.ceil(math.log2(max(1, count) * variants / 1_000_000))))
    low = BITS - lead
    masks = [int(m) for m in _masks(lead, half)]
    signed = [(m << low) - ((1 << BITS) if m >> (lead - 1) else 0) for m in masks]
    choices = F.array(
        *[F.struct(F.lit(s).cast("long").alias("mask"), F.lit(half - m.bit_count()).alias("left")) for m, s in zip(masks, signed)]
    )
    emitted = fps.select("fp", F.explode(choices).alias("c")).select(
        F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("c.mask")), low).alias("bucket"), "fp", "c.left"
    )
    pairs = emitted.groupBy("bucket").applyInPandas(_meet(lead, half), "a long, b long")
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is the smallest node that can be reached.

    Alternates large-star and small-star until the links stop changing; each step groups by node with
    map-side minima, so a node with very many links costs no more than its rows.
    """
    edges = stash(links.select("a", "b").where("a <> b").distinct(), label)
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(lowest, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges = stash(small, label)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == tuple(state):
            break
        before = tuple(state)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4
) -> DataFrame:
    """(doc_id, fp, component_id) for every row: component_id is the smallest id that links can reach."""
    marked = stash(docs.select(F.col(doc_id).alias("doc_id"), simhash(F.col(text), width).alias("fp")), "simhash")
    fps = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    fps = stash(fps, "fingerprints")
    roots = components(link_fingerprints(fps.select("fp"), fps.count(), radius), "balls")
    named = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(least, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp", "left").select("doc_id", "fp", "component_id")
