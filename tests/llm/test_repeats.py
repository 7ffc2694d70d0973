"""Byte and word substring deduplication against brute force."""

import random

import numpy as np
import pytest

from ledgerline.llm import anchors, repeated_bytes, repeated_words
from ledgerline.llm.repeated_words import FMIndex
from ledgerline.llm.suffixes import same_prefix_as_next, suffix_order
from tests.llm import brute


def random_texts(seed: int, alphabet: str = "abcd ", count: int = 30) -> list:
    """Texts sharing passages, with copies, nulls, empty texts, repeats inside a text and some umlauts."""
    draw = random.Random(seed)
    fresh = lambda n: "".join(draw.choice(alphabet) for _ in range(n))
    passages = [fresh(draw.randrange(20, 150)) for _ in range(6)]
    texts = [None, "", "x", "ä" * 60, "ab" * 80, "word " * 90]
    for _ in range(count):
        parts = [draw.choice([fresh(draw.randrange(1, 60)), draw.choice(passages), "é"]) for _ in range(draw.randrange(1, 6))]
        texts.append("".join(parts))
    texts += [texts[8], texts[8], texts[9]]
    return texts


@pytest.mark.parametrize("seed", range(4))
def test_suffix_order_is_the_order_of_suffixes(seed):
    draw = np.random.default_rng(seed)
    for n in [0, 1, 2, 3, 4, 5, 6, 7, 10, 50, 301]:
        for top in (1, 2, 5, 1000):
            symbols = draw.integers(1, top + 1, n)
            expected = sorted(range(n), key=lambda i: symbols[i:].tolist())
            assert suffix_order(symbols).tolist() == expected if n else len(symbols) == 0


def test_adjacent_prefixes_are_compared_exactly():
    symbols = np.array([5, 6, 7, 8, 9, 1, 5, 6, 7, 8, 4, 1, 5, 6, 2], dtype=np.int64)
    for depth in (1, 2, 3, 4, 5):
        places = np.array([0, 6, 12])
        expected = [
            symbols[a : a + depth].tolist() == symbols[b : b + depth].tolist() for a, b in ((0, 6), (6, 12))
        ]
        assert same_prefix_as_next(symbols, places, depth).tolist() == expected


def test_backward_search_counts_occurrences():
    draw = np.random.default_rng(5)
    words = draw.integers(2, 6, 400)
    index = FMIndex(np.append(words, 1))
    text = words.tolist()
    for _ in range(40):
        pattern = draw.integers(2, 6, draw.integers(1, 5)).tolist()
        low, high = np.array([0]), np.array([401])
        for symbol in reversed(pattern):
            low, high = index.extend(np.array([symbol]), low, high)
        count = sum(text[i : i + len(pattern)] == pattern for i in range(400))
        assert high[0] - low[0] == count


@pytest.mark.parametrize("seed,shard", [(1, 1_000_000), (2, 900), (3, 45), (4, 150)])
def test_repeated_bytes(spark, seed, shard):
    texts = random_texts(seed)
    docs = brute.table(spark, texts)
    found = repeated_bytes.remove_repeated(docs, width=40, gram=12, shard=shard).collect()
    got = {r["doc_id"]: (r["n_bytes"], sum(x["last"] - x["first"] for x in r["removed"]), len(r["removed"]), r["kept_sha256"]) for r in found}
    assert got == dict(enumerate(brute.removed_bytes(texts, 40)))


@pytest.mark.parametrize("seed,shard", [(1, 1_000_000), (2, 900), (3, 45), (4, 150)])
def test_repeated_words(spark, seed, shard):
    texts = random_texts(seed, "ab \n")
    docs = [(i * 3 % 37, t) for i, t in enumerate(texts)] + [(None, texts[10]), (5, texts[11]), (5, texts[11])]
    found = repeated_words.remove_repeated(brute.table(spark, docs), width=8, gram=3, shard=shard).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], sum(x["last"] - x["first"] for x in r["removed"]), r["kept_sha256"]) for r in found)
    assert got == sorted((str(d[0]), *e) for d, e in zip(docs, brute.removed_words(docs, 8)))


def test_empty_tables(spark):
    nothing = brute.table(spark, [])
    assert repeated_bytes.remove_repeated(nothing).count() == 0
    assert repeated_words.remove_repeated(nothing).count() == 0


def test_kept_text_is_what_the_digest_is_of(spark):
    from pyspark.sql import functions as F

    docs = brute.table(spark, ["a" * 30 + "b", "b" + "a" * 30, None]).select("doc_id", "text")
    found = repeated_bytes.remove_repeated(docs, width=10, gram=4)
    joined = docs.join(found, "doc_id").select(repeated_bytes.kept_text(F.col("text"), F.col("removed")).alias("k"), "kept_sha256")
    assert all(brute.digest(bytes(r["k"])) == r["kept_sha256"] for r in joined.collect())


def test_row_numbers_do_not_change_when_files_are_cut_anew(spark, tmp_path):
    texts = [f"{i} " * (i + 1) for i in range(60)]
    brute.table(spark, texts).repartition(6).write.parquet(f"{tmp_path}/docs")
    rows = anchors.numbered(spark.read.parquet(f"{tmp_path}/docs"), "doc_id", "text")
    seen = []
    for size in ("128m", "3k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "4m" if size == "128m" else "0")
        seen.append({r["uid"]: r["doc_id"] for r in rows.select("uid", "doc_id").collect()})
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen[0] == seen[1] and len(seen[0]) == 60


def periodic_texts() -> list:
    draw = random.Random(8)
    fresh = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    texts = ["-" * 3000, fresh(50) + "-" * 777 + fresh(60), "xyz" * 500 + fresh(30), fresh(30) + "zxy" * 400, fresh(90)]
    return texts + [(fresh(30) + "=" * draw.randrange(20, 300)) * 3 for _ in range(6)] + [fresh(20) + "0123456789" * 90]


@pytest.mark.parametrize("shard", [1_000_000, 700])
def test_periodic_stretches(spark, shard):
    texts = periodic_texts()
    found = repeated_bytes.remove_repeated(brute.table(spark, texts), width=40, gram=12, shard=shard).collect()
    got = {r["doc_id"]: (r["n_bytes"], sum(x["last"] - x["first"] for x in r["removed"]), len(r["removed"]), r["kept_sha256"]) for r in found}
    assert got == dict(enumerate(brute.removed_bytes(texts, 40)))
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = repeated_words.remove_repeated(brute.table(spark, docs), width=8, gram=3, shard=shard).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], sum(x["last"] - x["first"] for x in r["removed"]), r["kept_sha256"]) for r in found)
    assert got == sorted((str(d[0]), *e) for d, e in zip(docs, brute.removed_words(docs, 8)))


@pytest.mark.parametrize("period", ["-", "ab", "0123456789"])
def test_regions_of_a_periodic_stretch_stay_near_its_size(period):
    import pyarrow as pa

    spec = anchors.Windows("byte", 400, 128, 1_000_000)
    text = "start" + period * (200_000 // len(period)) + "end"
    runs = anchors.runs_of(anchors.symbols_of(text.encode(), "byte"), spec)
    first, last, anchor, joined = anchors.joined_runs(*runs, spec.width)
    assert joined.sum() == len(runs[0]) and first[0] == 0 and last[-1] == len(text) - 400
    assert (first[1:] == last[:-1] + 1).all()
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("anchor", pa.int64())]))
    rows = [{"first": a, "last": b, "anchor": h} for a, b, h in zip(first.tolist(), last.tolist(), anchor.tolist())]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([2]), pa.array([text]), pa.array([rows], kind)], names=["uid", "rank", "text", "runs"]
    )
    batches = list(anchors._regions(spec, 50_000)(iter([batch])))
    assert len(batches) > 3 and all(sum(map(len, b.column(6).to_pylist())) < 60_000 for b in batches)
    assert sum(sum(map(len, b.column(6).to_pylist())) for b in batches) < 2 * len(text)
    assert sum(sum(b.column(4).to_pylist()) for b in batches) == len(text) - 399


def test_words_whose_numbers_collide_are_not_taken_for_equal(spark):
    """A word of the Thue-Morse sequence and its complement agree as polynomials modulo 2**64 at any odd base."""
    ones = [i.bit_count() % 2 for i in range(1024)]
    word, other = "".join("ab"[b] for b in ones), "".join("ba"[b] for b in ones)
    assert (anchors.symbols_of(word.encode(), "word") == anchors.symbols_of(other.encode(), "word")).all()
    line = " ".join(f"w{i}" for i in range(49))
    docs = [(1, f"{line} {word}"), (2, f"{line} {other}"), (3, f"{line} {word}"), (4, f"x {line} {other} y")]
    found = {r["doc_id"]: r for r in repeated_words.remove_repeated(brute.table(spark, docs)).collect()}
    expected = brute.removed_words(docs, 50)
    for (own, _), (n, removed, kept) in zip(docs, expected):
        gone = sum(s["last"] - s["first"] for s in found[own]["removed"])
        assert (found[own]["n_words"], gone, found[own]["kept_sha256"]) == (n, removed, kept)
    assert [e[1] for e in expected] == [0, 0, 50, 50]


def test_window_classes_are_those_of_equal_windows():
    draw = np.random.default_rng(2)
    symbols = np.append(draw.integers(3, 5, 300), 1)
    for width in (1, 3, 7):
        classes = repeated_words.window_classes(symbols, suffix_order(symbols), width)
        windows = {}
        for i in range(301 - width):
            windows.setdefault(tuple(symbols[i : i + width]), set()).add(classes[i])
        assert all(len(c) == 1 for c in windows.values())
        assert len(set.union(*windows.values())) == len(windows)
