"""Spot signatures: chains of content words that follow common words, as DataFrame expressions only.

A common word (article, preposition, form of "to be") directly followed by a content word is a spot; its
signature is the chain of the next two content words, common words between them skipped. A text's
fingerprint is its sorted set of 64-bit signature hashes. Edits far from a spot leave its signature alone,
and boilerplate without common words makes no spots. A text with fewer than eight spots (a line, a list of
names) is fingerprinted by its words as well, an empty one by nothing. Two texts are always compared over the
same kind of signatures: their chains if both have enough spots, else chains and words of both.

Sets are partitioned by length: two sets whose lengths are too far apart cannot reach a similarity, and
the rarest tokens of a set must meet those of any set that is similar enough. ``near_pairs`` joins on both
and checks the rest with the Jaccard similarity. Equal fingerprints are one class before that.

Defined results: null texts count as empty; two empty fingerprints have likeness 1, an empty and another 0;
equal texts have equal fingerprints; a null id sorts as the smallest; repeated ids follow each other by
text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import sha256_text

# Common words of English, German, French and Spanish.
COMMON_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was were with "
    "als am an auch auf aus bei das dem den der des die ein eine einen einer er es für im in ist mit nicht sich sie "
    "sind und von war zu zum zur "
    "au aux avec ce dans de des du elle en est et il la le les ne ou par pas pour que qui se son sont sur un une "
    "al como con del el en es está la las lo los más no o para pero por que se ser su sus un una y"
)
FEW_SPOTS = 8
ROWS_IN_BUCKET = 2_000
MOST_BUCKETS = 20_000


def _plain(text: Column) -> Column:
    """Lower-case words of a text, each between two blanks."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "), F.lit(" "))


def chain_hashes(text: Column) -> Column:
    """Signature hashes of all spots of a text, repeats included."""
    common = "|".join(sorted(set(COMMON_WORDS.split())))
    # Common words become marks, so a chain is what stands between them.
    marked = F.regexp_replace(_plain(text), f"(?<= )(?:{common})(?= )", "|")
    chains = F.regexp_extract_all(marked, F.lit(r"\| (?=([^| ]+[| ]+[^| ]+) )"), F.lit(1))
    return F.transform(chains, lambda c: F.xxhash64(F.regexp_replace(c, "[| ]+", " ")))


def with_words(text: Column, chains: Column) -> Column:
    """Sorted set of the chains and words of a text."""
    words = F.filter(F.split(_plain(text), " "), lambda w: w != "")
    return F.array_sort(F.array_distinct(F.concat(chains, F.transform(words, lambda w: F.xxhash64(w)))))


def signed(text: Column) -> Column:
    """Struct column: ``few``, whether a text has few spots, and ``sigs``, its sorted set of signature hashes."""

    def of(chains: Column) -> Column:
        few = F.size(chains) < FEW_SPOTS
        sigs = F.when(few, with_words(text, chains)).otherwise(F.array_sort(F.array_distinct(chains)))
        return F.struct(few.alias("few"), sigs.alias("sigs"))

    # The chains are named once, so that they are found once.
    return F.transform(F.array(chain_hashes(text)), of)[0]


def signatures(text: Column) -> Column:
    """Sorted set of signature hashes of a text."""
    return signed(text)["sigs"]


def as_text(signature_set: Column) -> Column:
    """A fingerprint as text: the hashes in hexadecimal, in order."""
    return F.array_join(F.transform(signature_set, lambda h: F.lower(F.hex(h))), " ")


def likeness(one: Column, two: Column, at_least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 without comparing where lengths cannot reach ``at_least``."""
    shorter, longer = F.least(F.size(one), F.size(two)), F.greatest(F.size(one), F.size(two))
    shared = F.size(F.array_intersect(one, two))
    exact = F.when(longer == 0, F.lit(1.0)).otherwise(shared / (F.size(one) + F.size(two) - shared))
    return F.when(shorter < F.lit(at_least) * longer, F.lit(0.0)).otherwise(exact)


def pair_likeness(one: Column, one_text: Column, two: Column, two_text: Column) -> Column:
    """Likeness of two ``signed`` texts over one kind of signatures: with words where either has few spots."""

    def whole(sign: Column, text: Column) -> Column:
        # The set of a text with few spots has its words.
        return F.when(sign["few"], sign["sigs"]).otherwise(with_words(text, sign["sigs"]))

    same = one["few"] == two["few"]
    words = F.transform(F.array(F.struct(whole(one, one_text).alias("a"), whole(two, two_text).alias("b"))), lambda p: likeness(p["a"], p["b"]))
    return F.when(same, likeness(one["sigs"], two["sigs"])).otherwise(words[0])


def _next_text(docs: DataFrame, doc_id: str, text: str, rows_in_bucket: int) -> DataFrame:
    """(doc_id, text, sign, next_text, next_sign): the next document in descending id, the first after the last.

    Ids are cut into ranges; each range is ordered on its own, with the first row of the next range put
    behind its last row. The texts are shuffled once.
    """
    # A null id comes last of all.
    key = F.coalesce(F.col(doc_id).cast("double"), F.lit(-1e300))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), key.alias("key"))
    count = rows.count()
    buckets = min(MOST_BUCKETS, count // rows_in_bucket + 1)
    # A single range is cut too: the bucketing wants a border.
    borders = [0.0]
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        borders = sorted(set(rows.agg(F.percentile_approx("key", shares, 10_000)).first()[0]))
    splits = [float("-inf"), *borders, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="key", outputCol="bucket").transform(rows)
    cut = cut.withColumn("bucket", F.col("bucket").cast("int"))
    order = F.struct(F.col("key").alias("k"), F.col("doc_id").alias("i"), F.xxhash64("text").alias("h"), F.col("text").alias("t"))
    # One row for each range: its first row goes behind the range before it, the first range's behind the last.
    firsts = cut.groupBy("bucket").agg(F.max(order).alias("f")).select("bucket", F.col("f.t").alias("text"))
    around = Window.orderBy(F.col("bucket").desc())
    behind = firsts.withColumn("to", F.lag("bucket").over(around)).withColumn(
        "to", F.coalesce("to", F.min("bucket").over(Window.partitionBy(F.lit(1))))
    )
    ends = behind.select(
        F.lit(None).cast(rows.schema["doc_id"].dataType).alias("doc_id"), "text", F.lit(None).cast("double").alias("key"), F.col("to").alias("bucket"), F.lit(1).alias("end")
    )
    both = cut.withColumn("end", F.lit(0)).unionByName(ends)
    both = both.repartition("bucket").withColumn("sign", signed(F.col("text")))
    down = Window.partitionBy("bucket").orderBy(
        F.col("end"), F.col("key").desc(), F.col("doc_id").desc(), F.xxhash64("text").desc(), F.col("text").desc()
    )
    with_next = both.withColumn("next_text", F.lead("text").over(down)).withColumn("next_sign", F.lead("sign").over(down))
    return with_next.where(F.col("end") == 0).select("doc_id", "text", "sign", "next_text", "next_sign")


def compare_with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows_in_bucket: int = ROWS_IN_BUCKET) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text has the last third of the characters replaced by the first as many of the next document.
    """
    rows = _next_text(docs, doc_id, text, rows_in_bucket)
    size = F.char_length("text")
    edited = F.concat(F.expr("left(text, char_length(text) - char_length(text) div 3)"), F.expr("left(next_text, char_length(text) div 3)"))
    edits = rows.select("doc_id", "text", "sign", "next_text", "next_sign", size.cast("long").alias("n_chars"), edited.alias("edited"))
    done = edits.withColumn("edited_sign", signed(F.col("edited")))
    sign, text = F.col("sign"), F.col("text")
    return done.select(
        "doc_id",
        "n_chars",
        sha256_text(F.col("edited")).alias("edited_sha256"),
        as_text(F.col("sign.sigs")).alias("fingerprint"),
        as_text(F.col("edited_sign.sigs")).alias("edited_fingerprint"),
        pair_likeness(sign, text, F.col("edited_sign"), F.col("edited")).alias("near_edited"),
        pair_likeness(sign, text, F.col("next_sign"), F.col("next_text")).alias("near_next"),
    )


def near_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", at_least: float = 0.8) -> DataFrame:
    """(a, b, similarity) between representatives of equal sets; a < b are their smallest ids.

    Texts with enough spots are compared by their chains. Where either text has few spots, chains and words of
    both are compared, and a text stands for those with the same chains and words.

    Set lengths are cut into partitions that grow by 1 / ``at_least``, so similar sets lie in one partition
    or in neighbours. Of each set, only as many of its rarest signatures are joined as a similar set must
    share one of; common signatures never become join keys unless a set has nothing rarer.
    """
    if not 0 < at_least <= 1:
        raise ValueError("at_least must be above 0 and at most 1")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), signed(F.col(text)).alias("sign"))
    rows = rows.select("id", "text", "sign.few", "sign.sigs").where(F.size("sigs") > 0)
    whole = F.when(F.col("few"), F.col("sigs")).otherwise(with_words(F.col("text"), F.col("sigs")))
    by_chains = _similar(rows.where(~F.col("few")).groupBy("sigs", "few").agg(F.min("id").alias("id")), at_least)
    by_words = _similar(rows.select("id", "few", whole.alias("sigs")).groupBy("sigs", "few").agg(F.min("id").alias("id")), at_least, few=True)
    return by_chains.unionByName(by_words)


def _similar(sets: DataFrame, at_least: float, few: bool = False) -> DataFrame:
    """Similar pairs of ``sets`` (id, few, sigs); ``few``: only those in which either text has few spots."""
    tokens = sets.select("id", "few", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    often = tokens.groupBy("sig").count()
    ranked = tokens.join(often, "sig").groupBy("id", "few", "n").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("count", "sig"))), lambda s: s["sig"]).alias("rarest")
    )
    share = F.col("n") - F.ceil(F.col("n") * F.lit(at_least)) + 1
    first = F.slice("rarest", F.lit(1), share.cast("int"))
    # The partition of a length n is floor(log n / log(1 / at_least)); the next one up may match too.
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / min(at_least, 0.999)))).cast("int")
    cut = ranked.select("id", "few", "n", F.array_sort("rarest").alias("sigs"), step.alias("part"), F.explode(first).alias("sig"))
    left = cut.select(F.col("id").alias("a"), F.col("few").alias("few_a"), F.col("n").alias("n_a"), F.col("sigs").alias("sigs_a"), "part", "sig")
    right = cut.select(
        F.col("id").alias("b"), F.col("few").alias("few_b"), F.col("n").alias("n_b"), F.col("sigs").alias("sigs_b"), F.explode(F.array("part", F.col("part") - 1)).alias("part"), "sig"
    )
    fits = (F.col("n_a") <= F.col("n_b")) & (F.col("n_a") >= F.col("n_b") * at_least) & (F.col("a") != F.col("b"))
    if few:
        fits = fits & (F.col("few_a") | F.col("few_b"))
    met = left.join(right, ["part", "sig"]).where(fits)
    scored = met.withColumn("similarity", likeness(F.col("sigs_a"), F.col("sigs_b"), at_least))
    return scored.where(F.col("similarity") >= at_least).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity"
    ).distinct()
