"""N-gram Jaccard join with adaptive multi-match prefixes, and the groups that its links form.

A document is the set of its word shingles, in the order of their hashes. Two sets alike enough share at least l
of the first n - t + l shingles of either, for every l, where t is the least overlap a set of n can have with a
set like it. Each document picks its own l by the estimated cost of its candidates: shingles that very many
prefixes hold are left out, for which the prefix is lengthened, and a longer prefix asks for correspondingly more
shared shingles before two documents are compared at all. Two documents have to meet the lesser demand of the
two, for the prefix that ends first lies in both, and more by as much as their sizes ask for more than t. A
document whose longest prefix is all made of frequent shingles keeps them, and then has to share as many as its l.

Documents of one set are one node. Nodes under a shingle first meet only the next one, in orders that put like
nodes side by side, and the one that shares most with all others; where all of them turn out to be linked, directly
or through others, the shingle has nothing more to tell, so that large groups of near copies cost little more than
their size, and not its square. The pairs that remain are those between different groups so far: they are counted,
checked by length, position and number of shared shingles, and by sketches, and all that pass are verified on the texts.

A sketch tells of each of ``SKETCH`` residues of the hashes whether a set has an odd number of them. Each shingle of
one set only turns one bit, so two sets differ by at least as many shingles as their sketches by bits, and no pair
alike enough is passed over. Under shingles that many nodes hold, sketches are compared where the nodes meet, so that
nodes of large groups that are not alike make no rows.

Defined results: null texts, and texts without words, have empty sets and are linked with nothing, not even each
other; a text of fewer words than a shingle has one shingle; repeated rows are rows of one node; a null id is the
component only if there is no other; very long texts are whole; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import stash, texts_function
from ledgerline.llm.simhash import components
from ledgerline.session import broadcast_if_small

WIDTH = 4
PERCENT = 85
# Share of a set, in percent, by which its prefix may be lengthened.
LONGER = 10
# Prefixes that hold a shingle above which it is left out of prefixes that can be lengthened instead.
FREQUENT = 50
# Cost of verifying a candidate, in postings read.
VERIFY = 50
# Rounds in which nodes meet the next node of a shingle only, and pairs per posting at which the rest is worked off.
ROUNDS = 8
FEW_PAIRS = 8
# Rare shingles that two documents must share at most before they are compared.
MATCHES = 10
# Hashes that order nodes for a round.
SIGNS = 4
# Postings per link found below which another such round would not pay.
FEW_FOUND = 100
# Bits of a sketch; a multiple of 64.
SKETCH = 512
# Nodes of a shingle above which their sketches are compared where they meet.
CROWD = 8
# Rows of a table that may be broadcast.
SMALL = 50_000


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case; of bytes only A-Z change, and only ASCII white space separates."""
    return (text or "").encode("utf-8").lower().split()


def shingles(words: list[bytes], width: int) -> set[bytes]:
    """Runs of ``width`` words joined by a space; fewer words are one run, no words none."""
    if len(words) <= width:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares at least with any set like it."""
    return -(-percent * n // 100)


def longest_prefix(n: int, percent: int, longer: int) -> int:
    """Shingles in the longest prefix that a set of ``n``, or a set like it, may choose."""
    return min(n, n - least_overlap(n, percent) + 1 + math.ceil(longer * n / percent))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The parity of the number of hashes of each residue, as bits of 64-bit numbers."""
    odd = np.bincount(hashes & (SKETCH - 1), minlength=SKETCH).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def sets(docs: DataFrame, doc_id: str, text: str, width: int, percent: int, longer: int) -> DataFrame:
    """(doc_id, row, key, n, digest, prefix, sketch): size, digest and sketch of each set, and its smallest hashes in order."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, of = TaskContext.get().partitionId() << 33, xxhash.xxh3_64_intdigest
        for batch in batches:
            sizes, digests, prefixes, sketches = [], [], [], []
            for own in batch.column(1):
                held = shingles(words_of(own.as_py()), width)
                hashes = np.sort(np.fromiter((of(s) for s in held), dtype=np.uint64, count=len(held)).view(np.int64))
                sizes.append(len(held))
                digests.append(blake2b(hashes.tobytes(), digest_size=16).digest())
                prefixes.append(hashes[: longest_prefix(len(held), percent, longer)])
                sketches.append(sketch(hashes))
            ends = np.cumsum([0, *map(len, prefixes)])
            values, bits = (np.concatenate([*c, np.empty(0, dtype=np.int64)]) for c in (prefixes, sketches))
            marks = np.arange(len(batch) + 1) * (SKETCH // 64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.arange(row, row + len(batch))), batch.column(2), pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64())),
                    pa.ListArray.from_arrays(pa.array(marks, pa.int32()), pa.array(bits, pa.int64())),
                ],
                names=["doc_id", "row", "key", "n", "digest", "prefix", "sketch"],
            )
            row += len(batch)

    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), text_key(F.col(text)).alias("key"))
    schema = T.StructType([read.schema.fields[0], *T.StructType.fromDDL("row long, key string, n long, digest binary, prefix array<long>, sketch array<long>").fields])
    return read.mapInArrow(make, schema)


def text_key(text: Column) -> Column:
    return F.md5(text.cast("string").cast("binary"))


def _choose(percent: int, longer: int, frequent: int, verify: int):
    """Column function of (n, places, holders, shingles): how many must be shared, and the rank of each posting.

    Ranks go from the shingle with the fewest holders on; postings outside the chosen prefix have rank -1.
    """

    def pick(n: int, place: np.ndarray, held: np.ndarray) -> tuple[int, np.ndarray]:
        t = least_overlap(n, percent)
        l = np.arange(1, min(t, 1 + math.ceil(longer * n / 100)) + 1)
        hot = held > frequent
        need = l - np.searchsorted(place[hot], n - t + l)
        cold, cost = place[~hot], np.concatenate([[0], np.cumsum(held[~hot] - 1)])
        able = need >= 1
        if able.any():
            read = cost[np.searchsorted(cold, n - t + l)]
            best = int(np.argmin(np.where(able, read * (1 + verify / np.maximum(need, 1)), np.inf)))
            return int(need[best]), ~hot & (place < n - t + l[best])
        most = min(t, 1 + math.ceil(longer * n / percent))
        return most, place < n - t + most

    def run(batches):
        for sizes, places, holders, names in batches:
            ends = places.offsets.to_numpy()
            place, held, name = (c.values.to_numpy() for c in (places, holders, names))
            needs, ranks = [], np.full(len(place), -1, dtype=np.int64)
            for n, i, j in zip(sizes.to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                need, kept = pick(n, place[i:j], held[i:j])
                needs.append(need)
                at = i + np.flatnonzero(kept)
                ranks[at[np.lexsort((name[at], held[at]))]] = np.arange(len(at))
            listed = pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), pa.array(ranks[ends[0] : ends[-1]]))
            yield pa.StructArray.from_arrays([pa.array(needs, pa.int64()), listed], names=["need", "rank"])

    return texts_function(run, "struct<need:long,rank:array<long>>")


def postings(nodes: DataFrame, percent: int, longer: int, frequent: int, verify: int) -> DataFrame:
    """(shingle, node, n, place, need, rank, kept) of the prefixes that nodes (node, n, prefix) choose.

    Shingles of one holder only are left out, ``kept`` is the number of those that stay.
    """
    rows = nodes.select("node", "n", F.posexplode("prefix").alias("place", "shingle"))
    held = F.count(F.lit(1)).over(Window.partitionBy("shingle"))
    shared = rows.withColumn("held", held).where("held > 1")
    # Of one node at most a prefix.
    own = shared.groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("place", "shingle", "held"))).alias("p"))
    own = own.select("node", "n", F.col("p.place").cast("array<long>").alias("place"), F.col("p.shingle").alias("shingle"), F.col("p.held").alias("held"))
    chosen = own.withColumn("c", _choose(percent, longer, frequent, verify)("n", "place", "held", "shingle"))
    ranks = F.col("c.rank")
    kept = F.size(F.filter(ranks, lambda r: r >= 0)).cast("long").alias("kept")
    zipped = F.arrays_zip("shingle", "place", ranks.alias("rank")).alias("p")
    # What each posting needs of its node is ready before the lists unfold, so that no list is carried along.
    ready = chosen.select("node", "n", F.col("c.need").alias("need"), kept, zipped)
    return ready.select("node", "n", "need", "kept", F.explode("p").alias("p")).where("p.rank >= 0").select(
        "p.shingle", "node", "n", "p.place", "need", "p.rank", "kept"
    )


def _may_link(one: str, two: str, percent: int) -> Column:
    """Whether two sets that share a shingle at these places can be alike, by their sizes and what lies around it."""
    n, m, i, j = F.col(f"{one}.n"), F.col(f"{two}.n"), F.col(f"{one}.place"), F.col(f"{two}.place")
    most = F.least(i, j) + F.least(n - i, m - j)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * most >= percent * (n + m))


def _close(one: str, two: str, percent: int) -> Column:
    """Whether two sets can be alike by their sizes and sketches; nodes without a sketch can."""
    sketches = F.col(f"{one}.sketch"), F.col(f"{two}.sketch")
    apart = sum((F.bit_count(sketches[0][i].bitwiseXOR(sketches[1][i])) for i in range(SKETCH // 64)), F.lit(0))
    return F.coalesce((100 + percent) * apart <= (100 - percent) * (F.col(f"{one}.n") + F.col(f"{two}.n")), F.lit(True))


def _grouped(chosen: DataFrame, links: DataFrame | None) -> DataFrame:
    """Postings with the group of their node and the number of their shingle's, of shingles whose nodes are not all in one group."""
    if links is None:
        grouped = chosen.withColumn("root", F.col("node"))
    else:
        roots = components(links, "groups").select("node", "root")
        grouped = chosen.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    around = Window.partitionBy("shingle")
    ends = grouped.withColumns({"least": F.min("root").over(around), "most": F.max("root").over(around), "held": F.count(F.lit(1)).over(around)})
    return stash(ends.where("least < most").drop("least", "most"), "postings")


def _asked(percent: int) -> Column:
    """Shingles of their prefixes that two sets must share, by their sizes and what each of them asks for.

    Of an overlap of at least ``both``, no more than what follows the prefix that ends first can lie outside both
    prefixes, and of the rest no more can be left out than that document leaves out of its prefix.
    """
    both = F.ceil(F.lit(percent) * (F.col("one.n") + F.col("two.n")) / (100 + percent))
    least = F.ceil(F.lit(percent) * F.greatest("one.n", "two.n") / 100)
    return F.greatest(both - least + F.least("one.need", "two.need"), F.lit(1))


def _met(met: DataFrame, need: Column) -> DataFrame:
    """(a, b, need): the nodes of rows (one, two), and how many shingles they have to meet under."""
    return met.select(F.least("one.node", "two.node").alias("a"), F.greatest("one.node", "two.node").alias("b"), need.alias("need"))


def _counted(met: DataFrame) -> DataFrame:
    """(a, b): pairs of nodes that meet under as many shingles as they need."""
    counted = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.max("need").alias("need"))
    return counted.where("shared >= need").select("a", "b")


def _neighbours(live: DataFrame, turn: int, percent: int) -> DataFrame:
    """(a, b): nodes that follow each other under enough shingles, in an order that puts like nodes side by side, and
    nodes with the one under their shingles that shares most with others.

    The order is that of the least hashes of a node's shingles, other hashes in each turn. What this passes over is
    not lost, for the shingles of nodes that are not linked are worked off again.
    """
    least = [F.min(F.xxhash64("shingle", F.lit(turn * SIGNS + i))).alias(f"sign{i}") for i in range(SIGNS)]
    signed = live.join(live.groupBy("node").agg(*least, F.sum("held").alias("weight")), "node")
    around = Window.partitionBy("shingle")
    order = around.orderBy(*[f"sign{i}" for i in range(SIGNS)], "node")
    fields = F.struct("node", "n", "place", "need", "root")
    hub = F.max_by(fields, F.struct("weight", -F.col("node"))).over(around)
    beside = signed.select(fields.alias("one"), F.lead(fields).over(order).alias("next"), hub.alias("hub"))
    other = F.when(~F.col("hub.node").eqNullSafe(F.col("next.node")), F.col("hub"))
    met = beside.select("one", F.explode(F.array("next", other)).alias("two")).where("two IS NOT NULL")
    met = met.where((F.col("one.root") != F.col("two.root")) & _may_link("one", "two", percent))
    return _counted(_met(met, _asked(percent)))


def _all_pairs(live: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(a, b): all nodes of different groups that share enough shingles and, where many nodes meet, have like sketches.

    Who shares ``asked`` shingles of two lists, both in the order of their holders, shares ``few`` of those that
    come first, when as many follow as are left of what is asked. So the rarest shingles decide who meets.
    """
    asked = _asked(percent)
    few = F.least(asked, F.lit(MATCHES))
    rare = [F.col(f"{side}.rank") < F.col(f"{side}.kept") - asked + few for side in ("one", "two")]
    apart = (F.col("one.node") < F.col("two.node")) & (F.col("one.root") != F.col("two.root"))
    same = F.col("one.shingle") == F.col("two.shingle")
    able = same & apart & _may_link("one", "two", percent) & rare[0] & rare[1]
    usual = live.where(F.col("held") <= CROWD)
    crowded = live.where(F.col("held") > CROWD).join(sketches.select("node", "sketch"), "node")
    met = _met(usual.alias("one").join(usual.alias("two"), able), few)
    return _counted(met.unionByName(_met(crowded.alias("one").join(crowded.alias("two"), able & _close("one", "two", percent)), few)))


def _sifted(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes (node, n, sketch) that can be alike by their sketches."""
    told = F.struct("n", "sketch")
    one, two = (sketches.select(F.col("node").alias(own), told.alias(side)) for own, side in (("a", "one"), ("b", "two")))
    return pairs.join(one, "a").join(two, "b").where(_close("one", "two", percent)).select("a", "b")


def _alike(width: int, percent: int):
    """Column function of two texts: whether their sets are alike, by the shingles themselves."""

    def run(batches):
        known: dict[str, set[bytes]] = {}

        def held(text: str) -> set[bytes]:
            if text not in known:
                if len(known) > 64:
                    known.clear()
                known[text] = shingles(words_of(text), width)
            return known[text]

        for ones, twos in batches:
            found = []
            for one, two in zip(ones, twos):
                a, b = held(one.as_py()), held(two.as_py())
                shared = len(a & b)
                found.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield pa.array(found, pa.bool_())

    return texts_function(run, "boolean")


def _verified(pairs: DataFrame, names: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are alike; ``names`` is (node, key), ``texts`` (key, text)."""
    pairs = stash(pairs, "pairs")
    involved = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(names, "node")
    involved = stash(involved, "involved")
    keys = broadcast_if_small(involved.select("key").distinct(), SMALL)
    own = texts.join(keys, "key", "left_semi").groupBy("key").agg(F.any_value("text").alias("text"))
    named = stash(involved.join(own, "key").select("node", "text"), "texts")
    one = named.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    two = named.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(one, "a").join(two, "b")
    alike = both.select("a", "b", _alike(width, percent)(F.col("a_text"), F.col("b_text")).alias("alike"))
    return stash(alike.where("alike").select("a", "b"), "links")


def join(
    nodes: DataFrame, texts: DataFrame, width: int = WIDTH, percent: int = PERCENT,
    longer: int = LONGER, frequent: int = FREQUENT, verify: int = VERIFY, rounds: int = ROUNDS,
) -> DataFrame:
    """(a, b): links between distinct sets (node, key, n, prefix) that join all those alike, directly or through others.

    A column ``sketch`` of the nodes spares most pairs that are not alike their verification. Every pair of nodes that is alike is either returned or lies inside one group of the returned links.
    """
    chosen = stash(postings(nodes, percent, longer, frequent, verify), "chosen")
    names = nodes.select("node", "key")
    sketches = nodes.select("node", "n", F.col("sketch") if "sketch" in nodes.columns else F.lit(None).cast("array<long>").alias("sketch"))
    links, turn, last = None, 0, False
    while True:
        live = _grouped(chosen, links)
        size = live.groupBy("shingle").count().agg(F.sum("count"), F.sum(F.col("count") * F.col("count"))).first()
        if not size[0]:
            return links if links is not None else chosen.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
        last = last or turn >= rounds or size[1] <= FEW_PAIRS * size[0]
        pairs = _all_pairs(live, sketches, percent) if last else _neighbours(live, turn, percent)
        found = _verified(_sifted(pairs, sketches, percent), names, texts, width, percent)
        links = found if links is None else links.unionByName(found)
        if last:
            return links
        last, turn = found.count() * FEW_FOUND < size[0], turn + 1


def groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT, **options: int
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: the smallest id that links can reach."""
    marked = stash(sets(docs, doc_id, text, width, percent, options.get("longer", LONGER)), "sets")
    named = stash(marked.where("n > 0").groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id")), "nodes")
    copies = marked.where("n > 0").select("row", "digest").join(named, "digest").where("row <> node").select("row")
    nodes = marked.where("n > 0").join(broadcast_if_small(stash(copies, "copies"), SMALL), "row", "left_anti")
    nodes = nodes.select(F.col("row").alias("node"), "key", "n", "prefix", "sketch")
    texts = docs.select(text_key(F.col(text)).alias("key"), F.col(text).cast("string").alias("text"))
    roots = components(join(nodes, texts, width, percent, **options), "groups")
    rooted = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_set = rooted.join(least, "root").select("digest", "component_id")
    alone = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return marked.join(by_set, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))
