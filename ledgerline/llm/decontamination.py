"""Benchmark decontamination with suffix arrays over the training text.

Every Arrow batch of documents is one shard. Its words become ids of the benchmark's vocabulary (0: any
other word, which no benchmark passage can contain), the suffixes that start a long enough run of such
words are sorted to the depth of a window, and every test suffix is binary-searched in that array.
Runs of consecutive hits on one diagonal give the longest verbatim match of each item with its place.

The documents are read once and nothing is shuffled. The benchmark travels to the executors in blocks
of at most ``block_words`` words, which is checked; a larger benchmark takes several passes in one plan.

Defined results: a null text or a text without words has no words and no hits; an item without words
never occurs; an item shorter than the window is one window; repeated items with one id count once;
empty tables give empty results; other columns are passed through untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import texts_function

WINDOW = 13
BLOCK_WORDS = 1_000_000

_KEPT = set(b"0123456789abcdefghijklmnopqrstuvwxyz")
# Lower-cases A-Z and turns every separator into a space; bytes of other letters stay.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b in _KEPT or b >= 128 else 32 for b in range(256)
)
RESULT = "struct<n_words:long,hits:array<struct<first:int,last:int>>,matches:array<struct<item_id:string,doc_start:int,item_start:int,length:int>>>"


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(WORD_BYTES).split()


def _index(items: list[tuple[str, list[bytes]]], window: int):
    """Vocabulary, distinct test windows in key order, and who owns each of them."""
    vocabulary: dict[bytes, int] = {}
    rows, widths, owners, starts = [], [], [], []
    for number, (_, words) in enumerate(items):
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
        width = min(window, len(ids))
        for q in range(len(ids) - width + 1):
            rows.append(ids[q : q + width] + [0] * (window - width))
            widths.append(width)
            owners.append(number)
            starts.append(q)
    keys = np.array(rows, dtype=">u4").reshape(-1, window).view(f"S{4 * window}").ravel()
    unique, which = np.unique(keys, return_inverse=True)
    order = np.argsort(which, kind="stable")
    first = np.searchsorted(which[order], np.arange(len(unique) + 1))
    width = np.zeros(len(unique), dtype=np.int64)
    width[which] = widths
    return vocabulary, unique, width, first, np.array(owners)[order], np.array(starts)[order]


def _shard_suffixes(ids: np.ndarray, window: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the runs of known words, ordered to ``window`` words: places and their keys."""
    ends = np.append(np.flatnonzero(ids == 0), len(ids))
    places = np.flatnonzero(ids)
    run = ends[np.searchsorted(ends, places)] - places
    places, run = places[run >= least], run[run >= least]
    padded = np.append(ids, np.zeros(window, dtype=ids.dtype))
    block = padded[places[:, None] + np.arange(window)]
    block[np.arange(window) >= run[:, None]] = 0
    keys = np.ascontiguousarray(block.astype(">u4")).view(f"S{4 * window}").ravel()
    order = np.argsort(keys, kind="stable")
    return places[order], keys[order]


def _search(keys: np.ndarray, tests: np.ndarray, width: np.ndarray, window: int):
    """Interval of the suffix array that starts with each test window."""
    low = np.searchsorted(keys, tests, "left")
    high = np.searchsorted(keys, tests, "right")
    for i in np.flatnonzero(width < window):
        top = bytes(tests[i]).ljust(4 * window, b"\0")[: 4 * width[i]].ljust(4 * window, b"\xff")
        high[i] = np.searchsorted(keys, np.array([top], dtype=keys.dtype), "right")[0]
    return low, high


def _expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every integer of the ranges, and the range it belongs to."""
    size = last - first
    owner = np.repeat(np.arange(len(size)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size), owner


def _scanner(items: list[tuple[str, list[bytes]]], window: int) -> Callable:
    vocabulary, tests, width, first, owners, starts = _index(items, window)
    names = [name for name, _ in items]
    least = int(width.min())

    def shard(texts: list[str | None], before: list[list[dict]]) -> tuple[list, list, list]:
        words = [split_words(t) for t in texts]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        starts_at = np.cumsum(sizes + 1) - sizes - 1
        ids = np.zeros(int((sizes + 1).sum()), dtype=np.int64)
        known = vocabulary.get
        for at, own in zip(starts_at, words):
            ids[at : at + len(own)] = [known(w, 0) for w in own]
        places, keys = _shard_suffixes(ids, window, least)
        low, high = _search(keys, tests, width, window)
        at, test = _expand(low, high)
        at = places[at]

        covered = np.zeros(len(ids) + 1, dtype=np.int64)
        np.add.at(covered, at, 1)
        np.add.at(covered, at + width[test], -1)
        for begin, runs in zip(starts_at, before):
            for r in runs:
                covered[begin + r["first"]] += 1
                covered[begin + r["last"]] -= 1
        edges = np.diff(np.concatenate([[0], (np.cumsum(covered) > 0).astype(np.int8)]))
        opened, closed = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        hits: list[list[dict]] = [[] for _ in texts]
        for doc, a, b in zip(np.searchsorted(starts_at, opened, "right") - 1, opened, closed):
            hits[doc].append({"first": int(a - starts_at[doc]), "last": int(b - starts_at[doc])})

        entry, hit = _expand(first[test], first[test + 1])
        item, item_start = owners[entry], starts[entry]
        doc = np.searchsorted(starts_at, at[hit], "right") - 1
        place, wide = at[hit], width[test][hit]
        order = np.lexsort((place, place - item_start, item, doc))
        doc, item, place, item_start, wide = (x[order] for x in (doc, item, place, item_start, wide))
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (place[1:] != place[:-1] + 1)
        new[1:] |= (place - item_start)[1:] != (place - item_start)[:-1]
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, len(doc))) - 1 + wide[begin]
        matches: list[list[dict]] = [[] for _ in texts]
        best: dict[tuple[int, str], tuple[int, int, int]] = {}
        for i, size in zip(begin, length):
            key = (int(doc[i]), names[item[i]])
            value = (int(size), -int(place[i] - starts_at[doc[i]]), -int(item_start[i]))
            if key not in best or value > best[key]:
                best[key] = value
        for (d, name), (size, p, q) in best.items():
            matches[d].append({"item_id": name, "doc_start": -p, "item_start": -q, "length": size})
        return sizes.tolist(), hits, matches

    return shard


def _pass(items: list[tuple[str, list[bytes]]], window: int) -> Callable:
    """Column function of one block of the benchmark: text and earlier findings in, all findings out."""

    def scan(batches):
        shard = _scanner(items, window) if items else None
        for texts, hits, matches in batches:
            rows = []
            for at in range(0, len(texts), 1024):
                part = texts.slice(at, 1024).to_pylist()
                before, found = hits.slice(at, 1024).to_pylist(), matches.slice(at, 1024).to_pylist()
                if shard is None:
                    counts, runs, more = [len(split_words(t)) for t in part], before, [[] for _ in part]
                else:
                    counts, runs, more = shard(part, before)
                rows += [
                    {"n_words": n, "hits": r, "matches": old + new}
                    for n, r, old, new in zip(counts, runs, found, more)
                ]
            kind = pa.struct(
                [
                    ("n_words", pa.int64()),
                    ("hits", hits.type),
                    ("matches", matches.type),
                ]
            )
            yield pa.array(rows, type=kind)

    return texts_function(scan, RESULT)


def benchmark_blocks(
    benchmark: DataFrame, item_id: str, text: str, block_words: int = BLOCK_WORDS
) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks whose size is checked before a block is brought to the driver."""
    size = F.coalesce(F.octet_length(text), F.lit(0))
    total = benchmark.agg(F.sum(size)).first()[0] or 0
    blocks = int(total // (4 * block_words)) + 1
    named = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t"))
    for block in range(blocks):
        part = named if blocks == 1 else named.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == block)
        items = [(r["i"], split_words(r["t"])) for r in part.toLocalIterator()]
        yield sorted((i for i in items if i[1]), key=lambda i: (i[0], i[1]))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    into: str = "contamination",
) -> DataFrame:
    """Add a struct column: ``n_words``, maximal runs of words ``hits`` and the longest match of each item."""
    found: Column = F.struct(
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<first:int,last:int>>").alias("hits"),
        F.array().cast("array<struct<item_id:string,doc_start:int,item_start:int,length:int>>").alias("matches"),
    )
    docs = docs.withColumn(into, found)
    for items in benchmark_blocks(benchmark, item_id, item_text, block_words):
        docs = docs.withColumn(into, _pass(items, window)(F.col(text), F.col(into)["hits"], F.col(into)["matches"]))
    return docs


def verdict(found: Column, share: int = 20) -> dict[str, Column]:
    """Counts of a finding; contaminated when at least one word in ``share`` lies in a benchmark passage."""
    hit = F.aggregate(found["hits"], F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"])
    items = F.array_sort(F.array_distinct(F.transform(found["matches"], lambda m: m["item_id"])))
    return {
        "n_words": found["n_words"],
        "n_hit": hit,
        "n_items": F.size(items).cast("long"),
        "items_sha256": F.sha2(F.array_join(items, ",").cast("binary"), 256),
        "contaminated": (hit > 0) & (F.lit(share) * hit >= found["n_words"]),
        "longest_match": F.coalesce(F.array_max(F.transform(found["matches"], lambda m: m["length"])), F.lit(0)),
    }
