"""The Jaccard join, spelling variants and token alignment against brute force."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerline.llm import alignment, jaccard, spelling
from ledgerline.llm.common import read_table
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in read_table(spark, SMALL, "documents").collect()]


def in_order(rows):
    return sorted(rows, key=str)


def near_copies(draw):
    """Texts with groups of near copies of several kinds, a passage that all share, and odd rows."""
    words = [f"w{i}" for i in range(400)]
    line = lambda n: " ".join(draw.choice(words) for _ in range(n))
    common, texts = line(60), [None, "", " \t\n", "One", "one", "a b c", "A  b\nC", "x " * 40, "x " * 9]
    for size in (4, 5, 7, 30, 90, 200):
        base = line(size).split()
        for _ in range(6):
            own = list(base)
            for _ in range(draw.randrange(1 + size // 25)):
                own[draw.randrange(size)] = draw.choice(words)
            texts.append(" ".join(own))
    # A chain in which only neighbours are alike.
    chain = line(100).split()
    for i in range(12):
        chain = [f"c{i}" if at == 7 * i else w for at, w in enumerate(chain)]
        texts.append(" ".join(chain))
    texts += [f"{common} {line(40)}" for _ in range(8)] + [f"{line(4)} {common}" for _ in range(8)]
    return texts


@pytest.mark.parametrize("options", [{}, {"frequent": 1, "longer": 3}, {"frequent": 2, "rounds": 0}, {"verify": 0, "longer": 0}, {"frequent": 0, "longer": 40}])
def test_jaccard_groups(spark, options):
    draw = random.Random(11)
    texts = near_copies(draw)
    docs = [(i * 7 % 211, t) for i, t in enumerate(texts)] + [(None, texts[12]), (None, "no one else"), (5, texts[3]), (5, texts[30])]
    for percent in (85, 60):
        found = jaccard.groups(brute.table(spark, docs), percent=percent, **options).collect()
        expected = brute.jaccard_groups(docs, 4, percent)
        assert in_order(tuple(r) for r in found) == in_order(expected)
        assert len({c for _, _, c in expected}) < len({t for _, t in docs})


def test_jaccard_groups_of_a_very_long_text_and_of_none(spark):
    long = " ".join(f"v{i}" for i in range(60_000))
    docs = [(9, long), (4, long + " end"), (2, long[: len(long) // 2]), (1, None)]
    found = jaccard.groups(brute.table(spark, docs)).collect()
    assert in_order(tuple(r) for r in found) == in_order([(9, 59_997, 4), (4, 59_998, 4), (2, len(long[: len(long) // 2].split()) - 3, 2), (1, 0, 1)])
    assert jaccard.groups(brute.table(spark, [])).count() == 0
    assert [tuple(r) for r in jaccard.groups(brute.table(spark, [None, ""])).orderBy("doc_id").collect()] == [(0, 0, 0), (1, 0, 1)]


def test_shingles_met_by_one_group_only_are_not_paired(spark):
    """A large group of near copies is linked through its first nodes, with fewer pairs than its square."""
    draw = random.Random(2)
    base = [f"b{i}" for i in range(200)]
    texts = [" ".join(f"n{draw.randrange(9999)}" if i == at else w for i, w in enumerate(base)) for at in draw.choices(range(200), k=120)]
    docs = brute.table(spark, texts)
    marked = jaccard.sets(docs, "doc_id", "text", 4, 85, 10)
    nodes = marked.select(F.col("row").alias("node"), "key", "n", "prefix")
    links = jaccard.join(nodes, docs.select(jaccard.text_key(F.col("text")).alias("key"), "text"))
    assert links.count() < 10 * len(texts)
    assert {r["component_id"] for r in jaccard.groups(docs).collect()} == {0}


def test_unlike_nodes_of_a_large_group_are_not_verified(spark, monkeypatch):
    """Near copies of one base, most of which are not alike: few pairs go to the texts, and the groups are whole."""
    draw = random.Random(8)
    base, texts = [f"b{i}" for i in range(150)], []
    for _ in range(240):
        own = list(base)
        for at in draw.choices(range(150), k=draw.randrange(12)):
            own[at] = f"n{draw.randrange(9999)}"
        texts.append(" ".join(own))
    sizes, stash = [], jaccard.stash

    def counted(df, label):
        written = stash(df, label)
        if label == "pairs":
            sizes.append(written.count())
        return written

    monkeypatch.setattr(jaccard, "stash", counted)
    found = jaccard.groups(brute.table(spark, texts)).collect()
    expected = brute.jaccard_groups(list(enumerate(texts)), 4, 85)
    assert in_order(tuple(r) for r in found) == in_order(expected)
    assert len({c for _, _, c in expected}) > 100
    assert sum(sizes) < 8 * len(texts)


def test_sketches_differ_by_no_more_than_their_sets():
    draw = np.random.default_rng(3)
    for size, other in ((0, 3), (40, 0), (40, 8), (900, 200), (30_000, 900)):
        both, own = draw.integers(-(1 << 63), 1 << 63, size), draw.integers(-(1 << 63), 1 << 63, other)
        bits = jaccard.sketch(both) ^ jaccard.sketch(np.concatenate([both, own]))
        assert len(bits) * 64 == jaccard.SKETCH
        assert np.bitwise_count(bits.view(np.uint64)).sum() <= other
        assert (other > 8) or np.bitwise_count(bits.view(np.uint64)).sum() % 2 == other % 2


def test_op11_against_brute_force(spark):
    found = entry.queries()["op11_ngram_jaccard_join"](spark, SMALL)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert in_order(tuple(r) for r in found.collect()) == in_order(brute.jaccard_groups(documents(spark), 4, 85))


def mistyped(draw, word):
    at, letter = draw.randrange(len(word)), draw.choice("abcé")
    return draw.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])


@pytest.mark.parametrize("most_pairs", [spelling.MOST_PAIRS, 3, 0])
def test_spelling_variants(spark, most_pairs):
    draw = random.Random(5)
    stems = ["".join(draw.choice("abcdeéÿ") for _ in range(draw.randrange(7, 14))) for _ in range(12)]
    counts = {}
    for stem in stems:
        counts[stem] = draw.choice([3, 40, 500])
        for _ in range(8):
            word = mistyped(draw, stem)
            counts[word] = draw.choice([2, 4, 50])
            counts[mistyped(draw, word)] = 2
    counts |= {"aaaaaaa": 7, "aaaaaaaa": 70, "aaaaaaaaa": 700, "aaaaaab": 7, "aaaaaac": 7, "bbbbbbb": 9, "bbbbbbbb": 9}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("key", F.lit("x"))
    found = spelling.variants(words, most_pairs=most_pairs).collect()
    assert len(found) == len(counts)
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found} == brute.spelling_variants(counts)
    assert any(r["root"] not in (r["word"], r["form"]) for r in found)


def test_word_counts_of_odd_rows(spark):
    docs = [(1, None), (2, ""), (None, "Strasse STRASSE straße Äpfelchen äpfelchen"), (3, "strasse" * 20_000 + " 12,"), (3, "strasse" * 20_000), (4, "kurz kurz")]
    docs += [(i, "wandering Wandering wondering wanderings") for i in range(40)]
    found = {r["word"]: r["n"] for r in spelling.word_counts(brute.table(spark, docs)).collect()}
    assert found == brute.word_counts(docs)
    told = {r["word"]: r for r in spelling.variants(spelling.word_counts(brute.table(spark, docs))).collect()}
    assert {w: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for w, r in told.items()} == brute.spelling_variants(found)
    assert spelling.variants(spelling.word_counts(brute.table(spark, []))).count() == 0


def test_words_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    docs = [(i, " ".join(f"{a}{b}zzzzzz" for a in "abc" for b in "def")) for i in range(20)]
    assert {r["word"]: r["n"] for r in spelling.word_counts(brute.table(spark, docs)).collect()} == brute.word_counts(docs)


def test_op12_against_brute_force(spark):
    found = entry.queries()["op12_spelling_variants"](spark, SMALL).collect()
    expected = brute.spelling_variants(brute.word_counts(documents(spark)))
    assert len(found) == len(expected)
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found} == expected


def odd_texts(draw):
    signs = ["a", "b", " ", "  ", "\n", "\t", "é", "日", "本", "👍", "'s", "12", ".", " ", " ", "\x1c", "\x85", "ab", "́", "-"]
    texts = [None, "", " ", "   ", "a", " a", "a ", "a  b", "\n", "a▁b", "▁", "<|endoftext|> and <s>", "<0x41>", "x\x00y", "we'll don't I'M"]
    return texts + ["".join(draw.choice(signs) for _ in range(draw.randrange(1, 60))) for _ in range(120)]


@pytest.mark.parametrize("unit_bytes", [alignment.UNIT_BYTES, 300, 1])
def test_alignment(spark, unit_bytes):
    texts = odd_texts(random.Random(13)) * 2 + ["a", "long " * 3_000, "l" * 20_001, "日本" * 3_000, "--- " * 999]
    docs = brute.table(spark, [(None if i % 50 == 9 else i % 97, t) for i, t in enumerate(texts)])
    found = alignment.align(docs, alignment.load(spark, *FILES), unit_bytes=unit_bytes).collect()
    expected = [(None if i % 50 == 9 else i % 97, *row) for i, row in enumerate(brute.alignment(texts, *FILES))]
    assert in_order(tuple(r) for r in found) == in_order(expected)


def test_alignment_forgets_and_splits_large_groups(monkeypatch):
    texts = [t for t in odd_texts(random.Random(3))]
    monkeypatch.setattr(alignment, "FEW_LINKS", 1)
    pair = alignment.Pair(*alignment.read_byte_level(FILES[0]), *alignment.read_pieces(FILES[1]))
    forgetful, expected = alignment.Aligner(pair, remembered=1), brute.alignment(texts, *FILES)
    for i in range(0, len(texts), 10):
        own = forgetful.unit(texts[i : i + 10])
        rows = list(zip(own["n_a"], own["n_b"], own["n_groups"], own["n_links"], own["alignment"]))
        assert rows == [(*e[:4], e[6]) for e in expected[i : i + 10]]


def test_both_encoders_agree_with_the_libraries_on_all_characters():
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(FILES[0])
    pair = alignment.Pair(*alignment.read_byte_level(FILES[0]), *alignment.read_pieces(FILES[1]))
    encode, _ = pair.encoders()
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 200):
        text = "".join(f" a{chr(c)}b {chr(c)} 1{chr(c)}1{chr(c)}{chr(c)}  {chr(c)}\n" for c in points[at : at + 200])
        assert encode(text) == one.encode(text, add_special_tokens=False).ids, hex(points[at])


def test_gallop_finds_the_first_end_that_reaches_a_value():
    draw = np.random.default_rng(1)
    for size in (1, 2, 7, 500):
        ends = np.cumsum(draw.integers(1, 9, size))
        values = draw.integers(0, ends[-1] + 1, 300)
        start = draw.integers(0, size, 300)
        assert (alignment.gallop(values, ends, start) == np.searchsorted(ends, values)).all()


def test_alignment_of_an_empty_table(spark):
    assert alignment.align(brute.table(spark, []), alignment.load(spark, *FILES)).count() == 0


def test_op13_against_brute_force(spark):
    rows = entry.queries()["op13_cross_tokenizer_alignment"](spark, SMALL)
    docs = documents(spark)
    expected = [
        (own, *row[:6], brute.digest(row[6].encode()) if row[6] else "")
        for (own, _), row in zip(docs, brute.alignment([t for _, t in docs], *FILES))
    ]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows.columns == names
    assert in_order(tuple(r) for r in rows.collect()) == in_order(expected)
