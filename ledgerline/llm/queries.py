"""One query for each operator over the given tables, with the SQL of those that SQL can express."""

from __future__ import annotations

import secrets
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    alignment,
    bpe,
    decontamination,
    jaccard,
    language,
    pseudonyms,
    repeated_bytes,
    repeated_words,
    simhash,
    spelling,
    spot_signatures,
    token_counts,
    toxicity,
)
from ledgerline.llm.common import held_out, read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
KEY_SETTING = "spark.ledgerline.pseudonymKey"
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def pseudonym_key(spark: SparkSession) -> str:
    """The key named in the session, else one drawn at random that holds as long as the session."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    length = token_counts.encoded_length(F.col("text"), token_counts.load_ranks(spark, RANKS), public_tokenizers.PATTERN)
    return token_counts.suffix_sums(token_counts.histogram(docs, length))


def op2_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", bpe.round_trip(F.col("text"), bpe.load(spark, TOKENIZER)).alias("c"))
    return coded.select("doc_id", "c.*")


def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = repeated_bytes.remove_repeated(read_table(spark, folder, "documents"))
    return done.select("doc_id", "n_bytes", *_removed(), "kept_sha256")


def _removed() -> list[Column]:
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"])
    return [size.alias("n_removed"), F.size("removed").cast("long").alias("n_spans")]


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 3, 1)
    labels = read_table(spark, folder, "labels").where(~out).select("doc_id", "toxic")
    seen = toxicity.document_frequencies(docs)
    model = spark.sparkContext.broadcast(toxicity.fit(docs.join(labels, "doc_id"), docs, seen=seen))
    scored = toxicity.score_corpus(docs.withColumn("held_out", out), model, seen)
    score = F.col("score")
    return scored.select(
        "doc_id", "held_out", "score", F.when(score >= 0.7, 1).otherwise(0).alias("predicted"),
        F.array_join("evidence", ",").alias("nearest"),
    )


def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 4, 2)
    model = language.fit(docs.where(~out))
    told = docs.select("doc_id", out.alias("held_out"), language.predict(F.col("text"), model).alias("p"))
    return told.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op7_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    done = docs.select("doc_id", pseudonyms.pseudonymise(F.col("text"), pseudonym_key(spark)).alias("p"))
    return done.select(
        "doc_id",
        F.col("p.text").alias("text"),
        F.size("p.found").alias("n_values"),
        F.array_join(F.array_sort(F.array_distinct(F.col("p.found.kind"))), ",").alias("kinds"),
    )


def op8_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    return spot_signatures.compare_with_edits(read_table(spark, folder, "documents"))


def op9_fm_index_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = repeated_words.remove_repeated(read_table(spark, folder, "documents"))
    return done.select("doc_id", "n_words", _removed()[0], "kept_sha256")


def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.find_contamination(docs, read_table(spark, folder, "benchmark"))
    return found.select("doc_id", *[c.alias(n) for n, c in decontamination.verdict(F.col("contamination")).items()])


def op11_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.groups(read_table(spark, folder, "documents"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(read_table(spark, folder, "documents")))


def op13_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    def digest(groups: Column) -> Column:
        return F.when(groups == "", "").otherwise(F.sha2(groups, 256))

    docs = read_table(spark, folder, "documents")
    aligned = alignment.align(docs, alignment.load(spark, BYTE_LEVEL, PIECES), report=digest)
    return aligned.withColumnRenamed("alignment", "groups_sha256")


OP10_SQL = r"""
WITH item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark),
windows AS (
    SELECT item_id, least(13, len(words)) AS width, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS q, words
    FROM item_words WHERE len(words) > 0),
wanted AS (SELECT DISTINCT item_id, width, array_to_string(words[q : q + width - 1], ' ') AS passage FROM windows),
doc_words AS (
    SELECT doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM doc_words),
hits AS (
    SELECT d.doc_id, d.p, w.width, w.item_id
    FROM (SELECT DISTINCT width FROM wanted) widths, places d, wanted w
    WHERE w.width = widths.width AND d.p + widths.width - 1 <= len(d.words)
      AND array_to_string(d.words[d.p : d.p + widths.width - 1], ' ') = w.passage),
covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(p, p + width)) AS place FROM hits) c GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
          FROM hits GROUP BY doc_id),
diagonals AS (
    SELECT doc_id, item_id, p - q AS diagonal, p, width,
           p - row_number() OVER (PARTITION BY doc_id, item_id, p - q ORDER BY p) AS run
    FROM (SELECT DISTINCT h.doc_id, h.item_id, h.p, h.width, w.q
          FROM hits h JOIN windows w ON w.item_id = h.item_id AND w.width = h.width
          JOIN doc_words d ON d.doc_id = h.doc_id
          WHERE array_to_string(w.words[w.q : w.q + w.width - 1], ' ')
              = array_to_string(d.words[h.p : h.p + h.width - 1], ' ')) x),
longest AS (SELECT doc_id, max(length) AS longest_match
            FROM (SELECT doc_id, count(*) - 1 + max(width) AS length FROM diagonals
                  GROUP BY doc_id, item_id, diagonal, run) r GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.words) AS contaminated,
       CAST(coalesce(l.longest_match, 0) AS INTEGER) AS longest_match
FROM doc_words d LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id) LEFT JOIN longest l USING (doc_id)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_bpe_round_trip,
        op3_suffix_array_dedup,
        op4_toxicity,
        op5_simhash_near_dedup,
        op6_language_id,
        op7_pii_pseudonyms,
        op8_spot_signatures,
        op9_fm_index_dedup,
        op10_benchmark_decontamination,
        op11_ngram_jaccard_join,
        op12_spelling_variants,
        op13_cross_tokenizer_alignment,
    )
}

OP9_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (SELECT r, doc_id, p, md5(array_to_string(words[p : p + 49], ' ')) AS key
            FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM w) x),
first_in AS (SELECT key, min(doc_id) AS least FROM windows GROUP BY key HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 50)) AS place
         FROM windows JOIN first_in USING (key) WHERE least < doc_id),
words AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM w),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY place) AS text FROM words ANTI JOIN gone USING (r, place) GROUP BY r),
removed AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, coalesce(removed.n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)
"""

SQL: dict[str, str] = {"op9_fm_index_dedup": OP9_SQL, "op10_benchmark_decontamination": OP10_SQL}
