"""The training-data pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage is one operator of ``ledgerline.llm`` applied to all that the stage before it kept. The first
four return the columns of ``documents``; the last returns one row of token digests for each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontamination, language, pseudonyms, simhash
from ledgerline.llm.common import held_out, read_table, stash
from ledgerline.llm.queries import TOKENIZER, pseudonym_key

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told (null text or no letter) go; a missing ``lang`` is filled in."""
    docs = docs.select(*COLUMNS)
    model = language.fit(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    told = docs.withColumn("told", language.predict(F.col("text"), model))
    kept = told.where(F.col("told.lang") != language.UNDETERMINED)
    return kept.withColumn("lang", F.coalesce("lang", "told.lang")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id, one row of it if it is repeated."""
    # The row number tells repeated rows apart; it is written once, since another job may number other rows so.
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", F.monotonically_increasing_id().alias("row"))
    numbered = stash(docs.select(*COLUMNS, row.alias("key")), "numbered")
    groups = simhash.near_duplicates(numbered, doc_id="key")
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.row").alias("row"))
    return numbered.join(kept, F.col("key.row") == kept["row"], "left_semi").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least one word in twenty lies in a benchmark passage go."""
    found = decontamination.find_contamination(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))
    return found.where(~decontamination.verdict(F.col("contamination"))["contaminated"]).select(*COLUMNS)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to pseudonyms of the same format; ``n_chars`` follows the new text."""
    done = docs.select(*COLUMNS).withColumn("done", pseudonyms.pseudonymise(F.col("text"), pseudonym_key(spark)))
    text = F.col("done.text")
    return done.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of the text they decode to."""
    vocabulary = bpe.load(spark, TOKENIZER)
    coded = docs.select("doc_id", "lang", "source", bpe.round_trip(F.col("text"), vocabulary).alias("c"))
    return coded.select("doc_id", "lang", "source", "c.*")


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", replace_personal_data),
    ("BPE encoding and decoding", encode),
]

# SQL can neither fit the language machines nor follow the links of fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written below ``spark.checkpoint.dir`` and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stash(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
