"""Byte-pair encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of the tree hold the rank of the pair that starts at each symbol, with the position as tie
break, so its root is the leftmost lowest-rank merge. A merge updates three leaves and their paths to the
root, in logarithmic time, until the root holds no mergeable pair. Short words are worked off many at a
time, one tree per row of an array; a long word has a tree of its own, with the same steps.

Every text is split into words by the tokenizer's own pattern; words and chunks that a task has met are remembered
in a table of bounded size (cleared when full, which changes no result). One pass, no shuffle. The
vocabulary file is read on the driver and broadcast: its size does not depend on the data.

Defined results: null and empty texts have no tokens and decode to the empty text; special tokens that
occur literally in a text become their own ids; very long words and texts are encoded whole.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from tokenizers import Tokenizer
from tokenizers.normalizers import Normalizer
from tokenizers.pre_tokenizers import PreTokenizer

from ledgerline.llm.common import text_function

NONE = np.int64(1) << np.int64(60)
SHORT = 32
REMEMBERED = 300_000
BATCH = 512
# Up to this character, all tables of letters and digits agree.
LATIN = "\u024f"
# White space as the vocabulary's own pattern language has it.
WHITE = r"\x09-\x0D\x20\x85\p{Z}"


def byte_letters() -> list[str]:
    """Printable stand-ins of the 256 bytes: visible Latin-1 characters stand for themselves."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """What a word-level byte BPE file says, in arrays that are cheap to send and to search."""

    tokens: list[str]
    start: np.ndarray  # id of each byte inside a word
    end: np.ndarray  # id of each byte at the end of a word
    pairs: np.ndarray  # left id * size + right id by slot, -1 in free slots
    ranks: np.ndarray
    merged: np.ndarray
    special: dict[str, int]
    pattern: str
    # The tokenizer's own normal form and words, whose character tables may differ from those of this language.
    normalizer: Normalizer
    words: PreTokenizer


def read_vocabulary(path: str) -> Vocabulary:
    """Read a tokenizers file of the kind: NFC, white space, lower case, split, byte letters, BPE with word ends."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    ids: dict[str, int] = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (max([*ids.values(), *special.values()]) + 1)
    for token, number in [*ids.items(), *special.items()]:
        tokens[number] = token
    suffix = spec["model"]["end_of_word_suffix"]
    letters, size = byte_letters(), len(tokens)
    keys, merged = [], []
    for merge in spec["model"]["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        keys.append(ids[left] * size + ids[right])
        merged.append(ids[left + right])
    slots, rank_at, merged_at = _slots(keys, merged)
    library = Tokenizer.from_file(path)
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    return Vocabulary(
        tokens=tokens,
        start=np.array([ids[c] for c in letters], dtype=np.int64),
        end=np.array([ids[c + suffix] for c in letters], dtype=np.int64),
        pairs=slots,
        ranks=rank_at,
        merged=merged_at,
        special=special,
        pattern=split["pattern"]["Regex"].replace(r"[^\s", f"[^{WHITE}"),
        normalizer=library.normalizer,
        words=library.pre_tokenizer,
    )


def _slot(key: np.ndarray, size: int) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def _slots(keys: list[int], merged: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs in an open table with room to spare, the rank being the place in the list."""
    size = 1 << (8 * len(keys)).bit_length()
    table, rank, result = (np.full(size, empty, dtype=np.int64) for empty in (-1, 0, 0))
    for i, (key, slot) in enumerate(zip(keys, _slot(np.array(keys, dtype=np.int64), size).tolist())):
        while table[slot] >= 0:
            slot = (slot + 1) % size
        table[slot], rank[slot], result[slot] = key, i, merged[i]
    return table, rank, result


def _look_up(vocabulary: Vocabulary, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank and result of joining two symbols; rank NONE if they never join."""
    key = np.where((left >= 0) & (right >= 0), left * len(vocabulary.tokens) + right, -2)
    size = len(vocabulary.pairs)
    at = _slot(key, size)
    there = vocabulary.pairs.take(at)
    lost = np.flatnonzero((there != key) & (there >= 0))
    while len(lost):
        flat = at.reshape(-1)
        flat[lost] = (flat[lost] + 1) % size
        there.reshape(-1)[lost] = again = vocabulary.pairs.take(flat[lost])
        lost = lost[(again != key.reshape(-1)[lost]) & (again >= 0)]
    return np.where(there == key, vocabulary.ranks.take(at), NONE), vocabulary.merged.take(at)


def encode_short(words: list[bytes], vocabulary: Vocabulary, width: int) -> list[list[int]]:
    """Ids of words of at most ``width`` bytes (a power of two), all trees side by side.

    Symbols, links and trees lie in flat arrays, one stretch for each word.
    """
    n, span = len(words), width + 2
    size = np.array([len(w) for w in words], dtype=np.int64)
    raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), dtype=np.uint8).reshape(n, width)
    column = np.arange(width)
    # Column 0 and the last one are borders that join with nothing.
    symbols = np.full((n, span), -1, dtype=np.int64)
    symbols[:, 1:-1] = np.where(column < size[:, None], vocabulary.start[raw], -1)
    symbols[np.arange(n), size] = vocabulary.end[raw[np.arange(n), size - 1]]
    # A leaf is rank * span + position: the least one is the leftmost of the lowest rank.
    trees = np.full((n, 2 * width), NONE, dtype=np.int64)
    rank, _ = _look_up(vocabulary, symbols[:, 1:-1], symbols[:, 2:])
    trees[:, width:] = np.where(rank < NONE, rank * span + column + 1, NONE)
    level = width
    while level > 1:
        level //= 2
        trees[:, level : 2 * level] = np.minimum(trees[:, 2 * level : 4 * level : 2], trees[:, 2 * level + 1 : 4 * level : 2])
    after = np.tile(np.arange(1, span + 1), (n, 1)).ravel()
    before = np.tile(np.arange(-1, span - 1), (n, 1)).ravel()
    symbol, tree = symbols.ravel(), trees.ravel()
    row = np.flatnonzero(trees[:, 1] < NONE)
    while len(row):
        base, root = row * span, row * (2 * width)
        here = tree.take(root + 1) % span
        gone = after.take(base + here)
        _, new = _look_up(vocabulary, symbol.take(base + here), symbol.take(base + gone))
        beyond, previous = after.take(base + gone), before.take(base + here)
        symbol[base + here], symbol[base + gone] = new, -1
        after[base + here], before[base + beyond] = beyond, here
        ahead, _ = _look_up(vocabulary, new, symbol.take(base + beyond))
        behind, _ = _look_up(vocabulary, symbol.take(base + previous), new)
        # Three leaves change; the first symbol has none before it and repeats its own.
        first = previous == 0
        value = np.where(ahead < NONE, ahead * span + here, NONE)
        left = np.where(first, value, np.where(behind < NONE, behind * span + previous, NONE))
        node = root + width - 1
        tree[node + gone], tree[node + here], tree[node + np.where(first, here, previous)] = NONE, value, left
        paths = [np.where(first, here, previous) + width - 1, here + width - 1, gone + width - 1]
        step = width
        while step > 1:
            step //= 2
            paths = [path >> 1 for path in paths]
            for path in paths if step > 1 else paths[:1]:
                child = root + 2 * path
                tree[root + path] = np.minimum(tree.take(child), tree.take(child + 1))
        row = row[tree.take(root + 1) < NONE]
    inner = symbol.reshape(n, span)[:, 1:-1]
    alive = inner >= 0
    flat, ends = inner[alive].tolist(), np.cumsum(alive.sum(axis=1)).tolist()
    return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def encode_long(word: bytes, vocabulary: Vocabulary, pairs: dict[int, tuple[int, int]]) -> list[int]:
    """Ids of one long word, with one tree. ``pairs``: rank and result by pair."""
    n, size = len(word), len(vocabulary.tokens)
    symbol = [int(vocabulary.start[b]) for b in word[:-1]] + [int(vocabulary.end[word[-1]])]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    width = 1 << max(1, (n - 1).bit_length())
    nothing = int(NONE)
    tree = [nothing] * (2 * width)

    def leaf(i: int) -> int:
        j = after[i]
        pair = pairs.get(symbol[i] * size + symbol[j]) if j < n else None
        return pair[0] * width + i if pair else nothing

    def update(i: int, value: int) -> None:
        node = width + i
        tree[node] = value
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                break
            tree[node] = least

    for i in range(n):
        tree[width + i] = leaf(i)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    while tree[1] < nothing:
        i = tree[1] % width
        j = after[i]
        symbol[i] = pairs[symbol[i] * size + symbol[j]][1]
        symbol[j] = -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        update(j, nothing)
        update(i, leaf(i))
        if before[i] >= 0:
            update(before[i], leaf(before[i]))
    return [s for s in symbol if s >= 0]


class Encoder:
    """Encodes texts, remembering words up to a bound."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.vocabulary = vocabulary
        self.remembered = remembered
        self.words = regex.compile(vocabulary.pattern)
        self.white, self.odd_space = regex.compile(f"[{WHITE}]+"), regex.compile("[\x1c-\x1f]")
        self.beyond = re.compile(f"[^\x00-{LATIN}]")
        self.special = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) or r"(?!)")
        self.number = [str(i) for i in range(len(vocabulary.tokens))]
        self.known: dict[str, list[int]] = {}
        self.pairs: dict[int, tuple[int, int]] | None = None

    def chunks(self, text: str) -> list[str]:
        """Stretches without white space, which no word crosses; a special token is a chunk of its own."""
        if "<" not in text or not self.special.search(text):
            return self._split(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [*self._split(text[at : m.start()]), m.group()]
            at = m.end()
        return out + self._split(text[at:])

    def _split(self, text: str) -> list[str]:
        if not text.isascii():
            if self.beyond.search(text):
                # All white space is a blank afterwards.
                return [c for c in self.vocabulary.normalizer.normalize_str(text).split(" ") if c]
            text = unicodedata.normalize("NFC", text)
        text = text.lower()
        if self.odd_space.search(text):
            return [c for c in self.white.split(text) if c]
        return text.split()

    def split_chunk(self, chunk: str) -> list[str]:
        """Words of a chunk by the tokenizer's pattern; plain words, and those before a mark, need no search."""
        if chunk in self.vocabulary.special:
            return [chunk]
        if not chunk.isascii() and self.beyond.search(chunk):
            return [chunk[i:j] for _, (i, j) in self.vocabulary.words.pre_tokenize_str(chunk)]
        if chunk.isalpha():
            return [chunk]
        if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.words.findall(chunk)

    def learn(self, chunks: set[str]) -> None:
        """Encode the chunks not met before, each distinct word once."""
        special = self.vocabulary.special
        words = {c: self.split_chunk(c) for c in chunks}
        ids = {w: [special[w]] for w in special}
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for word in set().union(*words.values()).difference(special):
            raw = word.encode("utf-8")
            width = 0 if len(raw) > SHORT else max(2, 1 << (len(raw) - 1).bit_length())
            by_width.setdefault(width, []).append((word, raw))
        for width, group in by_width.items():
            if width:
                for at in range(0, len(group), 4096):
                    part = group[at : at + 4096]
                    ids.update(zip([w for w, _ in part], encode_short([raw for _, raw in part], self.vocabulary, width)))
                continue
            if self.pairs is None:
                v = self.vocabulary
                self.pairs = dict(zip(v.pairs.tolist(), zip(v.ranks.tolist(), v.merged.tolist())))
                self.pairs.pop(-1, None)
            ids.update((word, encode_long(raw, self.vocabulary, self.pairs)) for word, raw in group)
        for chunk, own in words.items():
            self.known[chunk] = ids[own[0]] if len(own) == 1 else [i for w in own for i in ids[w]]

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """Token ids of each text."""
        chunks = [self.chunks(t) if t else [] for t in texts]
        wanted = set().union(*chunks)
        if len(self.known) + len(wanted) > self.remembered:
            self.known = {}
        self.learn(wanted.difference(self.known))
        known = self.known
        return [list(chain.from_iterable([known[c] for c in own])) for own in chunks]


def load(spark: SparkSession, path: str):
    """Broadcast vocabulary of the file at ``path``."""
    return spark.sparkContext.broadcast(read_vocabulary(path))


def _paused_collector(make):
    """Run a batch function without cyclic garbage collection: its tables hold no cycles, only many rows."""

    def run(batches):
        gc.disable()
        try:
            yield from make(batches)
        finally:
            gc.enable()

    return run


def encode(text: Column, vocabulary) -> Column:
    """Array column of token ids."""

    def ids_of(batches):
        encoder = Encoder(vocabulary.value)
        for texts in batches:
            out = []
            for at in range(0, len(texts), BATCH):
                out += encoder.encode_batch(texts.slice(at, BATCH).to_pylist())
            yield pa.array(out, type=pa.list_(pa.int32()))

    return text_function(_paused_collector(ids_of), "array<int>")(text)


def decode(ids: Column, vocabulary) -> Column:
    """Text column: the tokens of an id array, special ones too, joined by one space."""

    def text_of(batches):
        tokens = vocabulary.value.tokens
        for rows in batches:
            yield pa.array([" ".join([tokens[i] for i in r or []]) for r in rows.to_pylist()], type=pa.string())

    return text_function(_paused_collector(text_of), "string")(ids)


def round_trip(text: Column, vocabulary) -> Column:
    """Struct column: token count, digests of ids and of the decoded text, without moving either."""

    def digests(batches):
        encoder = Encoder(vocabulary.value)
        number, token = encoder.number.__getitem__, vocabulary.value.tokens.__getitem__
        for texts in batches:
            counts, ids, decoded = [], [], []
            for at in range(0, len(texts), BATCH):
                for own in encoder.encode_batch(texts.slice(at, BATCH).to_pylist()):
                    counts.append(len(own))
                    ids.append(sha256(" ".join(map(number, own)).encode()).hexdigest())
                    decoded.append(sha256(" ".join(map(token, own)).encode("utf-8")).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return text_function(_paused_collector(digests), "struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>")(text)
