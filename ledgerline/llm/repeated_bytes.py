"""Substring deduplication over bytes with difference-cover suffix arrays.

A byte goes if it is covered by a string of ``width`` bytes that also starts anywhere else, in another
document or the same one. Content-defined anchors (module ``anchors``) send all regions that can hold two
equal strings to one shard; each shard sorts its suffixes by the difference-cover method (module
``suffixes``) and compares adjacent prefixes. Both keep every window, so the result is exact up to a
128-bit digest of whole regions.

Strings are judged on the input, matches never cross documents, and every occurrence goes, the first too.

Defined results: null and empty texts have no bytes; repeated rows are documents of their own, so all their
long enough texts go; null ids are kept as they are; an empty table gives an empty result; other columns
are not read. The bytes that stay may cut a character in two: they are returned as bytes or as a digest.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import anchors
from ledgerline.llm.anchors import Windows, content_key
from ledgerline.llm.common import stash, texts_function
from ledgerline.llm.suffixes import same_prefix_as_next, suffix_order

WIDTH = 400
GRAM = 128
SHARD_BYTES = 1_000_000
WINDOWS_IN_BATCH = 1 << 17
SPANS = "array<struct<first:long,last:long>>"


def runs_of_true(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _repeated_in_shard(width: int):
    def repeated(group: pd.DataFrame) -> pd.DataFrame:
        """Runs of windows (from, to) of each region that occur twice in the shard."""
        contents = [np.frombuffer(c, dtype=np.uint8) for c in group["content"]]
        sizes = np.array([len(c) for c in contents])
        starts = np.cumsum(sizes + 1) - sizes - 1
        # Bytes count from 2; 1 ends a region.
        symbols = np.ones(int((sizes + 1).sum()), dtype=np.int64)
        for at, content in zip(starts, contents):
            symbols[at : at + len(content)] = content.astype(np.int64) + 2
        owner = np.repeat(np.arange(len(contents)), sizes + 1)
        offset = np.arange(len(symbols)) - starts[owner]
        order = suffix_order(symbols)
        order = order[offset[order] <= sizes[owner[order]] - width]
        same = same_prefix_as_next(symbols, order, width)
        twice = np.zeros(len(symbols), dtype=bool)
        twice[order[:-1][same]] = True
        twice[order[1:][same]] = True
        many = group["owners"].to_numpy() > 1
        twice |= many[owner] & (offset <= sizes[owner] - width)
        first, last = runs_of_true(twice)
        region = owner[first]
        keys = group["region"].to_numpy()
        return pd.DataFrame(
            {
                "anchor": group["anchor"].to_numpy()[region],
                "region": keys[region],
                "a": first - starts[region],
                "b": last - 1 - starts[region],
            }
        )

    return repeated


def single_windows(spec: Windows, most: int = WINDOWS_IN_BATCH):
    """Every window of a region with the digest of its own content."""
    names = ["uid", "place", "window", "rank"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def windows(batches):
        rows = []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for uid, first, content, rank in zip(*(part.column(i).to_pylist() for i in range(4))):
                    for place, window in enumerate(spec.windows_of(content), first):
                        rows.append((uid, place, content_key(window), rank))
                    if len(rows) > most:
                        yield batch_of(rows)
                        rows = []
        if rows:
            yield batch_of(rows)

    return windows


def repeated_spans(rows: DataFrame, width: int = WIDTH, gram: int = GRAM, shard: int = SHARD_BYTES) -> DataFrame:
    """(uid, spans): runs of repeated windows of each row of ``numbered`` documents, unmerged."""
    spec = Windows("byte", width, gram, shard)
    regions = anchors.candidate_regions(rows, spec, across=False)
    usual, crowded = anchors.split_hot(regions, spec)
    distinct = usual.groupBy("anchor", "region").agg(F.count("*").alias("owners"), F.first("content").alias("content"))
    symbols = usual.agg(F.sum(F.col("windows") + width)).first()[0] or 0
    sharded = anchors.sharded(distinct, symbols, spec)
    found = sharded.groupBy("shard").applyInPandas(
        _repeated_in_shard(width), "anchor long, region binary, a long, b long"
    )
    owners = usual.select("anchor", "region", "uid", "first")
    usual_spans = owners.join(found, ["anchor", "region"]).select(
        "uid", (F.col("first") + F.col("a")).alias("first"), (F.col("first") + F.col("b")).alias("last")
    )
    single = crowded.select("uid", "first", "content", "rank").mapInArrow(
        single_windows(spec), "uid long, place long, window binary, rank long"
    )
    twice = single.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    crowded_spans = single.join(twice, "window").select("uid", F.col("place").alias("first"), F.col("place").alias("last"))
    spans = usual_spans.unionByName(crowded_spans)
    return spans.groupBy("uid").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def covered_runs(spans: list[dict] | None, width: int) -> list[tuple[int, int]]:
    """Maximal runs of symbols covered by windows that start in the spans."""
    merged: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"] + width) for s in spans or []):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    return [(a, b) for a, b in merged]


def _kept(width: int):
    def kept(batches):
        kind = pa.struct(
            [
                ("n_bytes", pa.int64()),
                ("removed", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                ("kept_sha256", pa.string()),
            ]
        )
        for texts, spans in batches:
            rows = []
            for text, own in zip(texts, spans):
                raw = (text.as_py() or "").encode("utf-8")
                runs, digest, at = covered_runs(own.as_py(), width), sha256(), 0
                for first, last in runs:
                    digest.update(raw[at:first])
                    at = last
                digest.update(raw[at:])
                removed = [{"first": a, "last": b} for a, b in runs]
                rows.append({"n_bytes": len(raw), "removed": removed, "kept_sha256": digest.hexdigest()})
            yield pa.array(rows, type=kind)

    return texts_function(kept, f"struct<n_bytes:long,removed:{SPANS},kept_sha256:string>")


def remove_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM, shard: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, removed, kept_sha256): ``removed`` holds the maximal removed runs, past-the-end last."""
    rows = anchors.numbered(docs, doc_id, text)
    spans = stash(repeated_spans(rows, width, gram, shard), "spans")
    judged = rows.join(spans, "uid", "left").select("doc_id", _kept(width)(F.col("text"), F.col("spans")).alias("k"))
    return judged.select("doc_id", "k.n_bytes", "k.removed", "k.kept_sha256")


def kept_text(text: Column, removed: Column) -> Column:
    """What stays of a text as binary, given its ``removed`` runs."""

    def kept(batches):
        for texts, runs in batches:
            out = []
            for value, own in zip(texts, runs):
                raw, parts, at = (value.as_py() or "").encode("utf-8"), [], 0
                for r in own.as_py() or []:
                    parts.append(raw[at : r["first"]])
                    at = r["last"]
                out.append(b"".join([*parts, raw[at:]]))
            yield pa.array(out, type=pa.binary())

    return texts_function(kept, "binary")(text, removed)
