"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Each tokenizer gives a rising list of byte offsets at which its tokens end. The shorter list drives the
intersection: every end gallops through the longer list, in steps that double until it is passed, then by
binary search in the last step. Indices of common ends cut both token lists into groups; the differences of
their ranks give the range of tokens of either side in a group, and so the links: all pairs in a group.

Documents are worked off in units of bounded text. A unit names its distinct id pairs once; documents
refer to them by number. Pairs are counted over the corpus with one row per unit and pair, and the counts go
back to the units that hold the pair, so what moves is pairs of units and not links of documents.

Defined results: a text that is null, empty, or that either tokenizer does not give back byte for byte has
no tokens, no groups and an empty alignment; strings of special tokens in a text are plain text; repeated
rows and null ids give rows of their own and count as documents; a very long text is a unit of its own; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import stash

# Bytes of text in a unit: bounds what a task holds, unless one text alone is longer.
UNIT_BYTES = 2_000_000
# Groups with more links than this are counted by their distinct ids and not link by link.
FEW_LINKS = 256
# Characters of parts of texts that a task remembers besides those of a unit, each part counting some more for its
# results; the table is cleared when it is full, which changes no result.
REMEMBERED = 24_000_000
PART = 50
# Parts that are encoded side by side.
RUN = 500
# A pair of ids is one number: the first id above this many bits of the second.
ID_BITS = 24

EMPTY = np.empty(0, dtype=np.int64)

# Fixed value: the byte-level pattern that splits text into words before merging.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Pair:
    """Both tokenizers as plain data: byte tables by id, ranks of A, the model file of B."""

    a_tokens: list[bytes]
    a_ranks: dict[bytes, int]
    b_tokens: list[bytes]
    b_model: bytes

    def encoders(self) -> tuple[Callable[[str], list[int]], Callable[[str], list[int]]]:
        merges = tiktoken.Encoding("a", pat_str=WORD_PATTERN, mergeable_ranks=self.a_ranks, special_tokens={})
        pieces = sentencepiece.SentencePieceProcessor(model_proto=self.b_model)
        return merges.encode_ordinary, pieces.encode

    def cuts_at_blanks(self) -> bool:
        """Whether no token of B has a blank after another character, so that a single blank begins a token."""
        return not any(b" " in token.lstrip(b" ") for token in self.b_tokens)


def byte_alphabet() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: visible Latin-1 stands for itself, the rest follows U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_byte_level(path: str) -> tuple[list[bytes], dict[bytes, int]]:
    """(bytes of each id, merge ranks) of a byte-level tokenizer file whose ids follow its merges."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    byte_of, special = byte_alphabet(), {t["id"] for t in model.get("added_tokens", []) if t["special"]}
    vocabulary = model["model"]["vocab"]
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if i not in special}
    joined = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    order = [vocabulary[a + b] for a, b in joined]
    if any(a >= b for a, b in zip(order, order[1:])):
        raise ValueError(f"{path}: ids do not follow the order of the merges")
    tokens = [b""] * (max(vocabulary.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return tokens, ranks


def read_pieces(path: str) -> tuple[list[bytes], bytes]:
    """(bytes of each id, model file) of a piece tokenizer with byte fallback."""
    with open(path, "rb") as file:
        model = file.read()
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    tokens = []
    for i in range(pieces.vocab_size()):
        piece = pieces.id_to_piece(i)
        tokens.append(bytes([int(piece[3:-1], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    return tokens, model


def load(spark: SparkSession, a_path: str, b_path: str):
    """Broadcast of the fields of a ``Pair``; the driver reads the files."""
    return spark.sparkContext.broadcast((*read_byte_level(a_path), *read_pieces(b_path)))


def gallop(values: np.ndarray, ends: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each value the first index of ``ends`` that reaches it, searched from index ``start`` outwards.

    All values step side by side: the step doubles until the value is passed, on either side of the start,
    then the last step is halved. ``ends`` rises and reaches every value.
    """
    low, high = np.empty_like(start), np.empty_like(start)
    ahead = ends[start] < values
    last = len(ends) - 1
    on, at, step = np.flatnonzero(ahead), start[ahead], 1
    while len(on):
        low[on] = at
        reached = np.minimum(at + step, last)
        high[on] = reached
        short = ends[reached] < values[on]
        on, at, step = on[short], reached[short], step * 2
    on, at, step = np.flatnonzero(~ahead), start[~ahead], 1
    while len(on):
        high[on] = at
        reached = at - step
        low[on] = np.maximum(reached, -1)
        more = (reached >= 0) & (ends[np.maximum(reached, 0)] >= values[on])
        on, at, step = on[more], reached[more], step * 2
    on = np.flatnonzero(high - low > 1)
    while len(on):
        middle = (low[on] + high[on]) >> 1
        short = ends[middle] < values[on]
        low[on[short]] = middle[short]
        high[on[~short]] = middle[~short]
        on = on[high[on] - low[on] > 1]
    return high


def common_ends(a: np.ndarray, b: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices into two rising lists of ends at which both end.

    The lists hold many texts one after the other; ``a_first`` and ``b_first`` (one more than texts) say where
    each begins. A value starts its search at the place that its share of its own text suggests.
    """
    if len(a) > len(b):
        there, here = common_ends(b, a, b_first, a_first)
        return here, there
    sizes = np.diff(a_first)
    begin = np.repeat(a_first[:-1], sizes)
    rank = np.arange(len(a), dtype=np.int64) - begin
    stretch = np.repeat(np.diff(b_first) / np.maximum(sizes, 1), sizes)
    start = np.repeat(b_first[:-1], sizes) + (rank * stretch).astype(np.int64)
    place = gallop(a, b, np.minimum(start, max(len(b) - 1, 0)))
    same = np.flatnonzero(b[place] == a)
    return same, place[same]


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first[i], first[i] + 1, ... of every range, one after the other."""
    begin = np.cumsum(size) - size
    return np.repeat(first - begin, size) + np.arange(int(size.sum()), dtype=np.int64)


def _links(a_ids, b_ids, a_from, a_size, b_from, b_size, text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, text, times) of the links of groups; a pair may come several times for a text."""
    few = a_size * b_size <= FEW_LINKS
    # One row for each token of A in a small group, then one for each of its links.
    rows, width = _ranges(a_from[few], a_size[few]), np.repeat(b_size[few], a_size[few])
    left = np.repeat(a_ids[rows], width)
    right = b_ids[_ranges(np.repeat(b_from[few], a_size[few]), width)]
    owner = np.repeat(np.repeat(text[few], a_size[few]), width)
    parts = [((left << ID_BITS) | right, owner, np.ones(len(left), dtype=np.int64))]
    for g in np.flatnonzero(~few):
        ours, n = np.unique(a_ids[a_from[g] : a_from[g] + a_size[g]], return_counts=True)
        theirs, m = np.unique(b_ids[b_from[g] : b_from[g] + b_size[g]], return_counts=True)
        pairs = ((ours[:, None] << ID_BITS) | theirs[None, :]).ravel()
        parts.append((pairs, np.full(len(pairs), text[g]), (n[:, None] * m[None, :]).ravel()))
    return tuple(np.concatenate(p) for p in zip(*parts))


def _sum_up(what: np.ndarray, owner: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, what, times), each combination once and in order, with its times added up."""
    named, number = np.unique(what, return_inverse=True) if len(what) and what.max() >> 31 else (None, what)
    both = (owner << 31) | number
    order = np.argsort(both)
    both = both[order]
    head = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])[: len(both)])
    times = np.add.reduceat(times[order], head) if len(head) else times
    owner, number = both[head] >> 31, both[head] & ((1 << 31) - 1)
    return owner, number if named is None else named[number], times


def _pack(numbers: np.ndarray, kind: str) -> bytes:
    return zlib.compress(numbers.astype(kind).tobytes(), 1)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype=kind).astype(np.int64)


class Aligner:
    """Encodes and aligns the texts of one task, unit by unit.

    Where one blank stands between two visible characters both tokenizers begin a token, so a text is aligned
    part by part between such blanks, and a part that comes again is not aligned again.
    """

    def __init__(self, pair: Pair, remembered: int = REMEMBERED):
        self.pair = pair
        self.remembered = remembered
        self.encode_a, self.encode_b = pair.encoders()
        self.a_size = np.array([len(t) for t in pair.a_tokens], dtype=np.int64)
        self.b_size = np.array([len(t) for t in pair.b_tokens], dtype=np.int64)
        # Written forms of an id inside a side and at its end.
        self.a_form = np.array([f"{i}," for i in range(len(self.a_size))] + [f"{i}|" for i in range(len(self.a_size))], dtype=object)
        self.b_form = np.array([f"{i}," for i in range(len(self.b_size))] + [f"{i};" for i in range(len(self.b_size))], dtype=object)
        self.blank = re.compile(r" (?<=\S )(?=\S)") if pair.cuts_at_blanks() else None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.forms: list[str] = []
        # Of every part: whether it is whole, tokens of both sides, groups, links; then its pairs and how often each comes.
        self.counts = np.empty((0, 5), dtype=np.int64)
        self.first = np.zeros(1, dtype=np.int64)
        self.linked = np.empty((2, 0), dtype=np.int64)

    def parts(self, text: str | None) -> list[str]:
        if not text:
            return []
        return self.blank.split(text) if self.blank else [text]

    def plain(self, text: str) -> bool:
        """Whether a text can stand beside others: it begins and ends with a visible character."""
        return self.blank is not None and not (text[0].isspace() or text[-1].isspace())

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """([ids of A, ids of B], [where each text's ids begin], whole); no ids where a text is not given back.

        Plain texts in a row are encoded as one, a blank before each.
        """
        runs, sides = [], [([EMPTY], [EMPTY + 1]), ([EMPTY], [EMPTY + 1])]
        whole = np.ones(len(texts), dtype=bool)
        for i, t in enumerate(texts):
            if runs and self.plain(t) and runs[-1][2] and i - runs[-1][0] < RUN:
                runs[-1][1] = i + 1
            else:
                runs.append([i, i + 1, self.plain(t)])
        runs.reverse()
        while runs:
            i, j, _ = runs.pop()
            text = " ".join(texts[i:j])
            raw, coded = f" {text}".encode(), (self.encode_a(f" {text}"), self.encode_b(text))
            if all(b"".join([table[x] for x in own]) == raw for own, table in zip(coded, (self.pair.a_tokens, self.pair.b_tokens))):
                ends = np.cumsum([len(t.encode()) + 1 for t in texts[i:j]])
                for (ids, counts), own, table in zip(sides, coded, (self.a_size, self.b_size)):
                    ids.append(np.array(own, dtype=np.int64))
                    counts.append(np.diff(np.searchsorted(np.cumsum(table[ids[-1]]), ends) + 1, prepend=0))
            elif j - i > 1:
                runs += [[n, n + 1, False] for n in range(j - 1, i - 1, -1)]
            else:
                whole[i] = False
                for _, counts in sides:
                    counts.append(np.zeros(1, dtype=np.int64))
        first = [np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64) for _, counts in sides]
        return [np.concatenate(ids) for ids, _ in sides], first, whole

    def align(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(written alignments, counts, where the pairs of each text begin, pairs and times) of texts."""
        (a_ids, b_ids), (a_first, b_first), whole = self.encode(texts)
        a_ends, b_ends = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        a_cut, b_cut = common_ends(a_ends, b_ends, a_first, b_first) if len(a_ids) else (np.empty(0, dtype=np.int64),) * 2
        a_from, b_from = np.concatenate([[0], a_cut[:-1] + 1])[: len(a_cut)], np.concatenate([[0], b_cut[:-1] + 1])[: len(b_cut)]
        a_width, b_width = a_cut + 1 - a_from, b_cut + 1 - b_from
        owner = np.searchsorted(a_first, a_cut, side="right") - 1
        links = np.zeros(len(texts), dtype=np.int64)
        np.add.at(links, owner, a_width * b_width)
        counts = np.stack([whole, np.diff(a_first), np.diff(b_first), np.bincount(owner, minlength=len(texts)), links], axis=1)

        # Written alignment: the tokens of a group's A side, then of its B side.
        a_group, b_group = np.repeat(np.arange(len(a_cut)), a_width), np.repeat(np.arange(len(b_cut)), b_width)
        a_last, b_last = np.zeros(len(a_ids), dtype=np.int64), np.zeros(len(b_ids), dtype=np.int64)
        a_last[a_cut], b_last[b_cut] = len(self.a_size), len(self.b_size)
        written = np.empty(len(a_ids) + len(b_ids), dtype=object)
        written[np.arange(len(a_ids)) + b_from[a_group]] = self.a_form[a_ids + a_last]
        written[np.arange(len(b_ids)) + a_cut[b_group] + 1] = self.b_form[b_ids + b_last]
        written = written.tolist()
        borders = (a_first + b_first).tolist()
        forms = ["".join(written[i:j])[:-1] for i, j in zip(borders, borders[1:])]

        owner, pairs, times = _sum_up(*_links(a_ids, b_ids, a_from, a_width, b_from, b_width, owner))
        return forms, counts, np.searchsorted(owner, np.arange(len(texts) + 1)), np.stack([pairs, times])

    def learn(self, parts: list[list[str]]) -> None:
        """Align the parts not met before."""
        wanted = set(chain.from_iterable(parts))
        new = [p for p in wanted if p not in self.known]
        size = sum(map(len, new)) + PART * len(new)
        if self.held and self.held + size > self.remembered:
            self.forget()
            new = list(wanted)
            size = sum(map(len, new)) + PART * len(new)
        if not new:
            return
        self.held += size
        new.sort(key=self.plain)
        forms, counts, first, linked = self.align(new)
        self.known.update(zip(new, range(len(self.forms), len(self.forms) + len(new))))
        self.forms += forms
        self.counts = np.concatenate([self.counts, counts])
        self.first = np.concatenate([self.first, first[1:] + self.first[-1]])
        self.linked = np.concatenate([self.linked, linked], axis=1)

    def unit(self, texts: list[str | None]) -> dict[str, list]:
        """Columns of one unit: a row for each text, the pairs of the unit with its first row."""
        parts = [self.parts(t) for t in texts]
        self.learn(parts)
        numbers = [[self.known[p] for p in own] for own in parts]
        # A text that has a part which is not given back has no tokens at all.
        flawed = set(np.flatnonzero(self.counts[:, 0] == 0).tolist())
        if flawed:
            numbers = [own if flawed.isdisjoint(own) else [] for own in numbers]
        begin = np.cumsum([0, *map(len, numbers)])
        number = np.fromiter(chain.from_iterable(numbers), dtype=np.int64, count=int(begin[-1]))
        sums = np.concatenate([np.zeros((1, 5), dtype=np.int64), np.cumsum(self.counts[number], axis=0)])
        counts = np.diff(sums[begin], axis=0)

        # Each part of a text once, with its times; then the pairs of those parts.
        owner = np.repeat(np.arange(len(texts)), np.diff(begin))
        owner, number, times = _sum_up(number, owner, np.ones(len(number), dtype=np.int64))
        size = self.first[number + 1] - self.first[number]
        at = _ranges(self.first[number], size)
        named, pair = np.unique(self.linked[0, at], return_inverse=True)
        owner, pair, times = _sum_up(pair, np.repeat(owner, size), self.linked[1, at] * np.repeat(times, size))
        entry = np.searchsorted(owner, np.arange(len(texts) + 1))
        rest = [None] * (len(texts) - 1)
        return {
            "n_a": counts[:, 1], "n_b": counts[:, 2], "n_groups": counts[:, 3], "n_links": counts[:, 4],
            "alignment": [";".join([self.forms[n] for n in own]) for own in numbers],
            "numbers": [_pack(np.diff(pair[i:j], prepend=0), "<u4") for i, j in zip(entry, entry[1:])],
            "times": [_pack(times[i:j], "<u8") for i, j in zip(entry, entry[1:])],
            "pairs": [named, *rest],
            "holders": [np.bincount(pair, minlength=len(named)), *rest],
        }


UNIT_COLUMNS = {
    "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "alignment": pa.string(),
    "numbers": pa.binary(), "times": pa.binary(), "pairs": pa.list_(pa.int64()), "holders": pa.list_(pa.int64()),
}
UNIT_SCHEMA = (
    "unit long, n_a long, n_b long, n_groups long, n_links long, alignment string, numbers binary, times binary, "
    "pairs array<long>, holders array<long>"
)


def _cut(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of rows with at most ``most`` bytes together, or of one row."""
    out, first, held = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and held + size > most:
            out.append((first, i))
            first, held = i, 0
        held += size
    return [*out, (first, len(sizes))] if len(sizes) else out


def units(docs: DataFrame, tokenizers, doc_id: str = "doc_id", text: str = "text", unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """One row per document with its alignment; units hold their distinct pairs with their first document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner(Pair(*tokenizers.value)), 0
        task = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1)
            sizes = np.asarray(texts.cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"").to_numpy(zero_copy_only=False))
            for i, j in _cut(np.array([len(x) for x in sizes], dtype=np.int64), unit_bytes):
                own = aligner.unit(texts.slice(i, j - i).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i), pa.array([task + number] * (j - i), pa.int64()),
                        *[pa.array(own[name], kind) for name, kind in UNIT_COLUMNS.items()],
                    ],
                    names=["doc_id", "unit", *UNIT_COLUMNS],
                )
                number += 1

    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", read.schema["doc_id"].dataType), *T.StructType.fromDDL(UNIT_SCHEMA).fields])
    return read.mapInArrow(make, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold each id pair linked, and whether no pair of its A id has more."""
    held = _held(aligned)
    counts = stash(held.groupBy("pair").agg(F.sum("holders").alias("count")), "pairs")
    first = F.shiftright("pair", ID_BITS).alias("first")
    most = counts.groupBy(first).agg(F.max("count").alias("most"))
    return counts.withColumn("first", first).join(most, "first").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _held(aligned: DataFrame) -> DataFrame:
    pairs = aligned.where("pairs IS NOT NULL").select(F.col("unit").alias("holder"), F.posexplode(F.arrays_zip("pairs", "holders")).alias("number", "p"))
    return pairs.select("holder", "number", F.col("p.pairs").alias("pair"), F.col("p.holders").alias("holders"))


def align(
    docs: DataFrame,
    tokenizers,
    doc_id: str = "doc_id",
    text: str = "text",
    report: Callable[[Column], Column] = lambda alignment: alignment,
    unit_bytes: int = UNIT_BYTES,
) -> DataFrame:
    """Per row: token, group and link counts, how its links stand in the corpus, and its alignment.

    ``alignment`` lists the groups as ``a1,a2|b1;a3|b2,b3`` (decimal ids, A before B); ``report`` says what is
    kept of it, so that a digest need not carry it along. ``n_best`` counts the links whose pair is held by as
    many documents as any pair of its A id; ``count_sum`` adds up these numbers of documents over all links.
    """
    aligned = units(docs, tokenizers, doc_id, text, unit_bytes)
    aligned = stash(aligned.withColumn("alignment", report(F.col("alignment"))), "aligned")
    found = _held(aligned).select("holder", "number", "pair").join(pair_counts(aligned), "pair").drop("pair")

    def score(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        place = pairs.column("number").to_numpy()
        count, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
        count[place], best[place] = pairs.column("count").to_numpy(), pairs.column("best").to_numpy()
        sums, bests = [], []
        for numbers, times in zip(rows.column("numbers"), rows.column("times")):
            own, weight = np.cumsum(_unpack(numbers.as_py(), "<u4")), _unpack(times.as_py(), "<u8")
            sums.append(int((count[own] * weight).sum()))
            bests.append(int((best[own] * weight).sum()))
        kept = rows.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        return kept.append_column("n_best", pa.array(bests, pa.int64())).append_column(
            "count_sum", pa.array(sums, pa.int64())
        ).append_column("alignment", rows.column("alignment"))

    fields = {f.name: f for f in aligned.schema.fields}
    schema = T.StructType(
        [fields[n] for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), fields["alignment"]]
    )
    rows = aligned.drop("pairs", "holders")
    return rows.groupBy("unit").cogroup(found.groupBy("holder")).applyInArrow(score, schema)
