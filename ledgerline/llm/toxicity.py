"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are the words of a text and their beginnings of three to six letters, as 64-bit hashes. A bounded
sample of labelled texts, at most ``per_label`` of each label, is the set of examples. Every text, read
whole, is a TF-IDF vector over all of its terms, with weights from how many of all documents have a term.

Terms that many examples share lie in a dense block, multiplied with several texts at once; all others keep
postings. Every example is compared, so the nearest are exact. They vote with the square of their cosine;
each label's votes are weighted back to its share among all labelled rows. Terms that no example has count
in the length of a text only; ``score_corpus`` joins their document frequencies.

Defined results: a text without any term of the examples has no neighbour and scores the share of toxic
rows; null texts count as empty; ties between equally near examples (to six digits) go to the smaller
example number; without labelled rows of both labels every score is that share (0 without any); repeated
rows count as often as they occur; an empty table gives an empty result; labels, languages and ids are never
inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.anchors import mixed
from ledgerline.llm.common import stash, text_function
from ledgerline.llm.language import bounded_sample

PER_LABEL = 1_500
BEGINNINGS = (3, 4, 5, 6)
NEAREST = 15
BLOCK = 64
MOST_DENSE = 4_096
TEXTS = 256
DOUBT = 0.05
PIECE = 1 << 20
#: Characters of short texts that are read together.
TOGETHER = 1 << 17
#: Odd numbers by place in a word, 64 of them; longer words use them again.
POWERS = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def _hashes(lowered: str, letters: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places of words, and hashes of their beginnings of each size and of the whole words."""
    read = np.frombuffer(lowered.encode("utf-32-le"), dtype=np.int32)
    inside = np.zeros(len(read) + 2, dtype=bool)
    inside[1:-1] = letters.take(read, mode="clip")
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edges[::2], edges[1::2]
    if not len(first):
        return []
    found, size = [], last - first
    codes = np.zeros(len(read) + max(BEGINNINGS), dtype=np.uint64)
    codes[: len(read)] = read
    rolling = np.zeros(len(first), dtype=np.uint64)
    for k in range(max(BEGINNINGS)):
        rolling = mixed(rolling + codes[first + k] + np.uint64(1))
        if k + 1 in BEGINNINGS:
            found.append((first[size > k], rolling[size > k]))
    # The whole word: a polynomial of its letters by place.
    starts = np.cumsum(size) - size
    place = np.arange(starts[-1] + size[-1]) - np.repeat(starts, size)
    place &= 63
    inner = codes[: len(read)][inside[1:-1]]
    inner *= POWERS.take(place)
    found.append((first, mixed(np.add.reduceat(inner, starts) + size.astype(np.uint64))))
    return found


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype=np.uint64), *parts]).view(np.int64)


def term_hashes(text: str | None, letters: np.ndarray) -> np.ndarray:
    """Hashes of all terms of a text, repeats included."""
    whole, found = (text or "").lower(), []
    at = 0
    while at < len(whole):
        stop = at + PIECE
        # A piece ends at white space where there is some, so that no word is cut.
        if stop < len(whole):
            blank = max(whole.rfind(" ", at, stop), whole.rfind("\n", at, stop))
            stop = blank + 1 if blank > at else stop
        found += [hashes for _, hashes in _hashes(whole[at:stop], letters)]
        at = stop
    return _joined(found)


def all_term_hashes(texts: Iterable[str | None], letters: np.ndarray) -> Iterator[np.ndarray]:
    """``term_hashes`` of each text; short texts are read together, one to a line."""

    def told() -> Iterator[np.ndarray]:
        ends = np.cumsum([len(t) + 1 for t in held])
        found = _hashes("\n".join(held), letters)
        cuts = [[0, *np.searchsorted(places, ends).tolist()] for places, _ in found]
        for i in range(len(held)):
            yield _joined([hashes[cut[i] : cut[i + 1]] for (_, hashes), cut in zip(found, cuts)])

    held, size = [], 0
    for text in texts:
        lowered = (text or "").lower()
        if held and size + len(lowered) > TOGETHER:
            yield from told()
            held, size = [], 0
        if len(lowered) > TOGETHER:
            yield term_hashes(text, letters)
        else:
            held.append(lowered)
            size += len(lowered) + 1
    if held:
        yield from told()


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, n): in how many documents each term occurs, on shared disk."""

    def counted(batches):
        letters, found, held = _letters(), [], 0

        def batch_of():
            terms, n = np.unique(np.concatenate(found), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(n, pa.int64())], names=["term", "n"])

        for batch in batches:
            for hashes in all_term_hashes((t.as_py() for t in batch.column(0)), letters):
                # With counts, numpy sorts; without, it takes twice as long over a table of its own.
                found.append(np.unique(hashes, return_counts=True)[0])
                held += len(found[-1])
                if held > PIECE:
                    yield batch_of()
                    found, held = [], 0
        if found:
            yield batch_of()

    return stash(docs.select(text).mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")), "frequencies")


class BlockIndex:
    """Examples by term: a dense block of the terms that at least ``block`` of them have, postings of the others."""

    def __init__(self, weights, block: int = BLOCK):
        """``weights``: examples by terms, rows of unit length; dense, or (examples, terms, example, term, weight)."""
        if isinstance(weights, np.ndarray):
            example, term = np.nonzero(weights)
            weights = (*weights.shape, example, term, weights[example, term])
        self.examples, terms, example, term, weight = weights
        order = np.argsort(term, kind="stable")
        example, term, weight = example[order], term[order], weight[order].astype(np.float32)
        often = np.bincount(term, minlength=terms)
        dense = np.argsort(-often, kind="stable")[:MOST_DENSE]
        dense = dense[often[dense] >= block]
        self.column = np.full(terms, -1, dtype=np.int32)
        self.column[dense] = np.arange(len(dense))
        inside = self.column[term] >= 0
        self.dense = np.zeros((len(dense), self.examples), dtype=np.float32)
        self.dense[self.column[term[inside]], example[inside]] = weight[inside]
        # As wide as ``bincount`` wants them.
        self.posted, self.weight = example[~inside].astype(np.intp), weight[~inside]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(term[~inside], minlength=terms))])

    def cosines(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Cosines of some unit vectors (terms, weights) and all examples."""
        table = np.zeros((len(queries), len(self.dense)), dtype=np.float32)
        for row, (terms, query) in zip(table, queries):
            column = self.column[terms]
            row[column[column >= 0]] = query[column >= 0]
        found = table @ self.dense
        for row, (terms, query) in zip(found, queries):
            many = self.start[terms + 1] - self.start[terms]
            place = np.arange(many.sum()) + np.repeat(self.start[terms] - (np.cumsum(many) - many), many)
            row += np.bincount(self.posted[place], self.weight[place] * np.repeat(query, many), self.examples).astype(np.float32)
        return found

    def nearest(self, terms: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the ``k`` nearest examples of positive cosine, exactly."""
        return nearest_of(self.cosines([(terms, query)])[0], k)


def nearest_of(cosine: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of the ``k`` largest positive cosines, the smaller number first of equal ones."""
    # Rounding keeps the order, so the nearest lie within one step of six digits below the k-th as it stands.
    least = np.partition(cosine, -k)[-k] - 3e-6 if len(cosine) > k else 0.0
    at = np.flatnonzero(cosine >= max(least, 0.0))
    # Sums are rounded in different orders; six digits are the same in any.
    rounded = np.round(cosine[at].astype(np.float64), 6)
    at, rounded = at[rounded > 0], rounded[rounded > 0]
    order = np.lexsort((at, -rounded))[:k]
    return at[order], rounded[order]


def fit(labelled: DataFrame, corpus: DataFrame, text: str = "text", toxic: str = "toxic", doc_id: str = "doc_id", per_label: int = PER_LABEL, seen: DataFrame | None = None) -> dict:
    """Examples, their weights and the share of each label; ``corpus`` gives the term statistics.

    ``seen``: its ``document_frequencies``, if they are known.
    """
    rows = labelled.where(F.col(toxic).isin(0, 1)).select(
        F.col(toxic).cast("int").alias("toxic"), F.col(text).alias("text"), F.col(doc_id).cast("string").alias("key")
    )
    sized = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    total = sum(sized.values())
    documents = corpus.count()
    model = {"share": sized.get(1, 0) / total if total else 0.0, "documents": documents, "examples": None}
    if len(sized) < 2:
        return model
    sample = stash(bounded_sample(rows, "toxic", F.coalesce("key", F.lit("")), per_label), "toxic-sample")
    letters = _letters()
    # The sample is bounded by ``per_label``, and only the terms' numbers of a row are kept.
    kept = sample.orderBy("toxic", F.xxhash64("key"), "key", F.xxhash64("text")).select("toxic", "key", "text").toLocalIterator()
    found, labels, keys = [], [], []
    for row in kept:
        found.append(np.unique(term_hashes(row["text"], letters), return_counts=True))
        labels.append(row["toxic"])
        keys.append(row["key"])
    hashes, term = np.unique(np.concatenate([h for h, _ in found]), return_inverse=True)
    if not len(hashes):
        return model
    spark = corpus.sparkSession
    wanted = spark.createDataFrame(pa.table({"term": pa.array(hashes, pa.int64())}))
    seen = document_frequencies(corpus, text) if seen is None else seen
    own = seen.join(F.broadcast(wanted), "term").toArrow()
    counts = np.zeros(len(hashes), dtype=np.int64)
    counts[np.searchsorted(hashes, own["term"].to_numpy())] = own["n"].to_numpy()
    idf = np.log((1.0 + documents) / (1.0 + counts)) + 1.0
    sizes = [len(h) for h, _ in found]
    example = np.repeat(np.arange(len(found)), sizes)
    weight = (1.0 + np.log(np.concatenate([n for _, n in found]))) * idf[term]
    weight /= np.sqrt(np.bincount(example, weight**2, len(found)))[example]
    y = np.array(labels)
    # A vote stands for all rows of its label that the sample left out.
    worth = np.where(y == 1, sized[1] / max(1, (y == 1).sum()), sized[0] / max(1, (y == 0).sum()))
    weights = (len(y), len(hashes), example.astype(np.int32), term.astype(np.int32), weight.astype(np.float32))
    return model | {"hashes": hashes, "idf": idf, "weights": weights, "labels": y, "worth": worth, "keys": keys, "examples": len(y)}


VOTES = "struct<toxic:double,all:double,inside:double,outside:array<struct<term:long,n:long>>,evidence:array<string>>"


def votes(text: Column, model, nearest: int = NEAREST, evidence: int = 3) -> Column:
    """Struct column: votes times ``inside``, the squared length over terms of examples, and all other terms."""

    def voted(batches):
        m = model.value
        letters, index = _letters(), BlockIndex(m["weights"]) if m["examples"] else None
        kind = pa.struct([
            ("toxic", pa.float64()), ("all", pa.float64()), ("inside", pa.float64()),
            ("outside", pa.list_(pa.struct([("term", pa.int64()), ("n", pa.int64())]))), ("evidence", pa.list_(pa.string())),
        ])
        none = {"toxic": 0.0, "all": 0.0, "inside": 0.0, "outside": [], "evidence": []}
        for texts in batches:
            if index is None:
                yield pa.array([none] * len(texts), type=kind)
                continue
            rows, sums, ends, terms_out, times_out = [], [], [0], [], []
            for at in range(0, len(texts), TEXTS):
                queries, inner = [], []
                for own in all_term_hashes((t.as_py() for t in texts.slice(at, TEXTS)), letters):
                    hashes, times = np.unique(own, return_counts=True)
                    terms = np.minimum(np.searchsorted(m["hashes"], hashes), len(m["hashes"]) - 1)
                    known = m["hashes"][terms] == hashes
                    terms_out.append(hashes[~known])
                    times_out.append(times[~known])
                    ends.append(ends[-1] + len(terms_out[-1]))
                    terms = terms[known]
                    weights = (1.0 + np.log(times[known])) * m["idf"][terms]
                    inner.append(float(weights @ weights))
                    queries.append((terms, (weights / np.sqrt(inner[-1])).astype(np.float32) if len(terms) else weights))
                for inside, cosine in zip(inner, index.cosines(queries)):
                    best, near = nearest_of(cosine, nearest)
                    vote = near**2 * m["worth"][best] * inside
                    sums.append((float(vote[m["labels"][best] == 1].sum()), float(vote.sum()), inside))
                    rows.append([m["keys"][i] for i in best[:evidence]])
            outside = pa.StructArray.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, np.int64), *c]).astype(np.int64)) for c in (terms_out, times_out)], names=["term", "n"]
            )
            columns = [pa.array([x[i] for x in sums], pa.float64()) for i in range(3)]
            columns += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), outside), pa.array(rows, pa.list_(pa.string()))]
            yield pa.StructArray.from_arrays(columns, names=[f.name for f in kind]).cast(kind)

    return text_function(voted, VOTES)(text)


def _from_votes(voted: Column, outside: Column, share: float) -> Column:
    """Score of votes, given the squared length over terms of no example."""
    # One vote of the base share stands for what no neighbour tells.
    doubt = F.lit(DOUBT) * (voted["inside"] + outside)
    chance = (voted["toxic"] + doubt * F.lit(share)) / (voted["all"] + doubt)
    return F.when(voted["all"] > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), chance))).otherwise(F.lit(share))


def _length(n: Column, seen: Column, documents: int) -> Column:
    """Squared weight of a term."""
    weight = (1 + F.log(n.cast("double"))) * (F.log((1.0 + documents) / (1 + seen)) + 1)
    return weight * weight


def score(text: Column, model, nearest: int = NEAREST, evidence: int = 3) -> Column:
    """Struct column: ``score`` (0 to 1) and ``evidence``, the ids of the nearest examples, for texts outside the corpus.

    Terms of no example count as terms of no document; for documents of the corpus use ``score_corpus``.
    ``model`` is a broadcast variable of ``fit``'s result, bounded by the sample.
    """
    documents, share = model.value["documents"], model.value["share"]

    def told(v: Column) -> Column:
        outside = F.aggregate(v["outside"], F.lit(0.0), lambda a, o: a + _length(o["n"], F.lit(0), documents))
        return F.struct(_from_votes(v, outside, share).alias("score"), v["evidence"].alias("evidence"))

    return F.transform(F.array(votes(text, model, nearest, evidence)), told)[0]


def score_corpus(docs: DataFrame, model, seen: DataFrame, text: str = "text") -> DataFrame:
    """Columns of ``docs`` but the text, with ``score`` and ``evidence``; ``seen`` are the corpus's frequencies."""
    others = [c for c in docs.columns if c != text]
    numbered = docs.select(F.struct(*others).alias("row"), F.monotonically_increasing_id().alias("uid"), votes(F.col(text), model).alias("v"))
    voted = stash(numbered, "toxic-votes")
    outside = voted.select("uid", F.explode("v.outside").alias("o")).select("uid", "o.term", F.col("o.n").alias("times"))
    squares = outside.join(seen, "term", "left").select(
        "uid", _length(F.col("times"), F.coalesce("n", F.lit(0)), model.value["documents"]).alias("w")
    )
    # In one order, so that the sum is the same in every run.
    sums = squares.groupBy("uid").agg(F.aggregate(F.sort_array(F.collect_list("w")), F.lit(0.0), lambda a, w: a + w).alias("outside"))
    v = F.col("v")
    return voted.join(sums, "uid", "left").select(
        "row.*", _from_votes(v, F.coalesce("outside", F.lit(0.0)), model.value["share"]).alias("score"), v["evidence"].alias("evidence")
    )
