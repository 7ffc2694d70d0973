"""Spelling variants: words one edit from each other, grouped under their frequent forms.

Asymmetric q-chunks. A word gives away two disjoint chunks, its first and its last half; another word offers its
positional grams of the same width. One inserted, deleted or replaced character spares a chunk: of two words of
one length the chunk stands at its own place, of two words whose lengths differ by one the first chunk stands at
its own place or the last one is shifted by one. Only the grams that can meet a chunk within that shift are sent.
Words that meet are verified by their edit distance. A pair that meets by its first chunk is not taken again by
its last one, so no pair comes twice.

A chunk that very many words share is not worked off pair by pair: what is left of its words is cut in two
chunks again, under the same rule, until few words meet.

Defined results: a null text has no words; a null id counts as the empty text; repeated rows count as often as
they occur; words of any length are handled, long chunks stand as a digest in the join key; of equally frequent
near words the smallest by code point is taken; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stash

# Distinct words, and characters of them, that a task adds up before it hands them on.
HELD_WORDS = 200_000
HELD_CHARACTERS = 16_000_000
# Pairs under one chunk above which its words are cut again.
MOST_PAIRS = 20_000
# Characters of a chunk above which a digest stands for it.
LONG = 40

# Fixed value: what a word is made of.
RUN = "[A-Za-zÀ-ÿ]+"


def damaged(doc_id: str, run: str, every: int) -> str:
    """``run`` without one of its characters if the crc32 of id and run is a multiple of ``every``."""
    h = crc32(f"{doc_id}:{run}".encode())
    if h % every:
        return run
    gone = h % len(run)
    return run[:gone] + run[gone + 1 :]


def word_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 31, least_length: int = 7, least: int = 2
) -> DataFrame:
    """(word, n): runs of letters in lower case, some of them damaged, with at least ``least`` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, total, held = re.compile(RUN), Counter(), 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for own_id, own in zip(batch.column(0).to_pylist(), batch.column(1)):
                # Lower case of bytes changes A-Z only.
                found = Counter(runs.findall((own.as_py() or "").encode().lower().decode()))
                for run, n in found.items():
                    if len(run) < least_length:
                        continue
                    word = damaged(own_id, run, every)
                    if len(word) >= least_length:
                        if word not in total:
                            held += len(word)
                        total[word] += n
                if len(total) >= HELD_WORDS or held >= HELD_CHARACTERS:
                    yield out()
                    total, held = Counter(), 0
        yield out()

    read = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(text).cast("string"))
    counted = read.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


def _short(chunk: Column) -> Column:
    return F.when(F.char_length(chunk) > LONG, F.md5(chunk)).otherwise(chunk)


def _cut(rows: DataFrame) -> DataFrame:
    """Every row with its first and with its last chunk added to the key, and the rest of the word left.

    ``extra`` is 1 for a word seen as the longer of a pair: the chunks are those of the shorter one.
    """
    size = F.expr("(char_length(rest) - extra) div 2")
    front, back = F.expr("left(rest, (char_length(rest) - extra) div 2)"), F.expr("right(rest, (char_length(rest) - extra) div 2)")
    after, before = F.expr("substr(rest, (char_length(rest) - extra) div 2 + 1)"), F.expr("left(rest, char_length(rest) - (char_length(rest) - extra) div 2)")
    ways = F.array(
        F.struct(F.concat("key", F.lit("/0"), _short(front)).alias("key"), after.alias("rest"), F.col("missed")),
        # Taken by its last chunk, a pair must not agree in the first one.
        F.struct(F.concat("key", F.lit("/1"), _short(back)).alias("key"), before.alias("rest"), F.array_append("missed", _short(front)).alias("missed")),
    )
    return rows.where(size > 0).select("word", "n", "extra", F.explode(ways).alias("w")).select("word", "n", "extra", "w.*")


def _verified(rows: DataFrame) -> DataFrame:
    """Pairs of words under one key that are one edit apart."""
    one, two = rows.where("extra = 0").alias("one"), rows.alias("two")
    ordered = (F.col("two.extra") == 1) | (F.col("one.word") < F.col("two.word"))
    apart = ~F.exists(F.zip_with("one.missed", "two.missed", lambda a, b: a == b), lambda same: same)
    near = F.levenshtein(F.col("one.word"), F.col("two.word"), 1) == 1
    met = one.join(two, (F.col("one.key") == F.col("two.key")) & ordered).where(apart & near)
    return met.select(F.col("one.word").alias("a"), F.col("one.n").alias("a_n"), F.col("two.word").alias("b"), F.col("two.n").alias("b_n"))


def near_words(words: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """(a, a_n, b, b_n): every pair of words (word, n) that are one edit apart, once."""
    seen = F.explode(F.array(F.lit(0), F.lit(1))).alias("extra")
    rows = words.where(F.char_length("word") > 1).select("word", "n", F.col("word").alias("rest"), seen)
    rows = rows.withColumn("key", (F.char_length("word") - F.col("extra")).cast("string")).withColumn("missed", F.array().cast("array<string>"))
    found = None
    while True:
        rows = stash(_cut(rows), "chunks")
        size = rows.groupBy("key").agg(F.count_if(F.col("extra") == 0).alias("short"), F.count(F.lit(1)).alias("all"))
        hot = stash(size.where(F.col("short") * F.col("all") > most_pairs).select("key"), "hot")
        more = not hot.isEmpty()
        pairs = _verified(rows.join(hot, "key", "left_anti") if more else rows)
        found = pairs if found is None else found.unionByName(pairs)
        if not more:
            return found
        rows = rows.join(hot, "key", "left_semi")
        # A single character left cannot be cut: its few spellings are compared as they are.
        found = found.unionByName(_verified(rows.where("char_length(rest) - extra < 2")))


def variants(words: DataFrame, ratio: int = 10, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word (word, n).

    ``form`` is the most frequent near word if it is at least ``ratio`` times as frequent; ``root`` is where the
    forms lead from a word, the word itself if it has none.
    """
    words = stash(words.select("word", "n"), "words")
    pairs = near_words(words, most_pairs)
    both = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
            F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
        )
    ).alias("p")
    first = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("first")
    best = pairs.select(both).select("p.*").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first)
    form_n = -F.col("first.less")
    fits = form_n >= ratio * F.col("n")
    told = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("first.near")).alias("form"), F.when(fits, form_n).alias("form_n"),
    )
    told = stash(told, "forms")
    roots = follow(told.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def follow(roots: DataFrame) -> DataFrame:
    """(word, root): where the links of a table (word, root) without circles lead; each round doubles the way."""
    while True:
        roots = stash(roots, "roots")
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(ahead, "root", "left_semi").isEmpty():
            return roots
        roots = roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
