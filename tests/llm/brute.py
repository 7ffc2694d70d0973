"""Plain single-process versions of the operators, for small tables."""

from __future__ import annotations

import re
from hashlib import sha256
from itertools import accumulate
from zlib import crc32

import xxhash
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

# Columns whose names clash with names the operators use inside.
EXTRA = {"uid": 7, "rank": "x", "fp": 1, "anchor": 2, "contamination": "own", "row": 0, "key": "k", "bucket": 9}


def table(spark, texts, first_id=0):
    """Documents with ids, null and repeated rows as given, and clashing extra columns."""
    rows = [(t[0], t[1]) if isinstance(t, tuple) else (first_id + i, t) for i, t in enumerate(texts)]
    names = ["doc_id", "text", *EXTRA]
    kinds = {int: "long", str: "string"}
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` {kinds[type(v)]}" for n, v in EXTRA.items())
    return spark.createDataFrame([(*r, *EXTRA.values()) for r in rows], schema).select(*names)


def digest(data: bytes) -> str:
    return sha256(data).hexdigest()


def removed_bytes(texts: list[str | None], width: int) -> list[tuple[int, int, int, str]]:
    raws = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for raw in raws:
        for p in range(len(raw) - width + 1):
            seen[raw[p : p + width]] = seen.get(raw[p : p + width], 0) + 1
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            if seen[raw[p : p + width]] > 1:
                gone[p : p + width] = b"\1" * width
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(raw), sum(gone), spans, digest(kept)))
    return out


def removed_words(docs: list[tuple[int | None, str | None]], width: int) -> list[tuple[int, int, str]]:
    words = [(float("inf") if i is None else i, (t or "").encode().split()) for i, t in docs]
    least: dict[tuple, float] = {}
    for rank, own in words:
        for p in range(len(own) - width + 1):
            key = tuple(own[p : p + width])
            least[key] = min(rank, least.get(key, rank))
    out = []
    for rank, own in words:
        gone = [False] * len(own)
        for p in range(len(own) - width + 1):
            if least[tuple(own[p : p + width])] < rank:
                gone[p : p + width] = [True] * width
        out.append((len(own), sum(gone), digest(b" ".join(w for w, g in zip(own, gone) if not g))))
    return out


def fingerprint(text: str | None, width: int = 4) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(ids: list, prints: list[int], radius: int = 4) -> list:
    """Smallest id of the component of each row; null ids only if there is nothing else."""
    parent = list(range(len(ids)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    groups: dict[int, list] = {}
    for i, own in enumerate(ids):
        groups.setdefault(find(i), []).append(own)
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(ids))]


def contamination(texts: list[str | None], items: list[tuple[str, str | None]], window: int) -> list[tuple]:
    def words_of(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    windows = []
    for name, text in items:
        own = words_of(text)
        width = min(window, len(own))
        windows += [(name, own[q : q + width]) for q in range(len(own) - width + 1) if width]
    out = []
    for text in texts:
        own = words_of(text)
        hit, names = set(), set()
        for name, passage in windows:
            for p in range(len(own) - len(passage) + 1):
                if own[p : p + len(passage)] == passage:
                    hit.update(range(p, p + len(passage)))
                    names.add(name)
        ids = ",".join(sorted(names))
        out.append((len(own), len(hit), len(names), digest(ids.encode()), bool(hit) and 20 * len(hit) >= len(own)))
    return out


def jaccard_groups(docs: list[tuple[int | None, str | None]], width: int, percent: int) -> list[tuple]:
    """(id, set size, smallest id of the component) of each row; rows without shingles stay alone."""
    sets = []
    for _, text in docs:
        words = (text or "").encode().lower().split()
        starts = range(max(1, len(words) - width + 1))
        sets.append(frozenset(tuple(words[i : i + width]) for i in starts) if words else frozenset())
    group = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for i, (own, _) in enumerate(docs):
        ids = [d for (d, _), g in zip(docs, group) if g == group[i] and d is not None]
        out.append((own, len(sets[i]), min(ids, default=None)))
    return out


def word_counts(docs: list[tuple[int | None, str | None]]) -> dict[str, int]:
    counts: dict[str, int] = {}
    for own, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if own is None else own}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling_variants(counts: dict[str, int]) -> dict[str, tuple]:
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        first = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = first if first is not None and counts[first] >= 10 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def alignment(texts: list[str | None], byte_level: str, pieces: str) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, alignment) of each text, by the tokenizers' own libraries."""
    one = Tokenizer.from_file(byte_level)
    one.encode_special_tokens = True
    two = SentencePieceProcessor(model_file=pieces)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    grouped, counts = [], {}
    for text in texts:
        groups = []
        if text:
            a, b, raw = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text), (" " + text).encode()
            a_raw = [bytes(byte_of[c] for c in one.id_to_token(i)) for i in a]
            b_raw = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(a_raw) == b"".join(b_raw) == raw:
                a_ends = [0, *accumulate(map(len, a_raw))]
                b_ends = [0, *accumulate(map(len, b_raw))]
                cuts = sorted(set(a_ends) & set(b_ends))
                for low, high in zip(cuts, cuts[1:]):
                    groups.append((a[a_ends.index(low) : a_ends.index(high)], b[b_ends.index(low) : b_ends.index(high)]))
        grouped.append(groups)
        for pair in {(x, y) for left, right in groups for x in left for y in right}:
            counts[pair] = counts.get(pair, 0) + 1
    best: dict[int, int] = {}
    for (x, _), n in counts.items():
        best[x] = max(n, best.get(x, 0))
    out = []
    for groups in grouped:
        links = [(x, y) for left, right in groups for x in left for y in right]
        written = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        out.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
            sum(counts[link] == best[link[0]] for link in links), sum(counts[link] for link in links), written,
        ))
    return out
