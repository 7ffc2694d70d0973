"""Exact token counts for every context limit from a length histogram.

Documents are aggregated by encoded length; what is left is one row for each length that occurs. Suffix
sums over that table answer, for any limit, how many documents and tokens lie at or above it, how many
tokens are left when every document is cut at the limit, and every quantile, without reading text again.
Lengths are summed in two levels (blocks of lengths, then lengths in a block), so no task orders them all.

Defined results: null and empty texts have length 0 and are counted; repeated rows count as often as they
occur; a null group is a group of its own; an empty table gives an empty histogram; other columns are not
read.
"""

from __future__ import annotations

import base64

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stash, text_function

BLOCK = 4096


def load_ranks(spark: SparkSession, path: str):
    """Broadcast ranks of a public byte-pair vocabulary; its size does not depend on the data."""
    with open(path, "rb") as file:
        lines = [line.split() for line in file if line.strip()]
    return spark.sparkContext.broadcast({base64.b64decode(token): int(rank) for token, rank in lines})


def encoded_length(text: Column, ranks, pattern: str) -> Column:
    """Number of tokens of a text; strings of special tokens are ordinary text."""

    def lengths(batches):
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        for texts in batches:
            yield pa.array([len(encoding.encode_ordinary(t.as_py() or "")) for t in texts], type=pa.int64())

    return text_function(lengths, "long")(text)


def histogram(docs: DataFrame, length: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, n_tokens, documents): one row for each encoded length that occurs."""
    return docs.select(*by, length.alias("n_tokens")).groupBy(*by, "n_tokens").agg(F.count("*").alias("documents"))


def suffix_sums(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A histogram with what lies at or above each length, and what a cut at that length leaves.

    ``documents_up_to`` and ``share_up_to`` answer quantiles, ``truncated_total`` the tokens kept when every
    document is cut to ``n_tokens``.
    """
    rows = stash(counts.withColumn("block", F.expr(f"n_tokens div {BLOCK}")), "lengths")
    tokens = F.col("documents") * F.col("n_tokens")
    blocks = rows.groupBy(*by, "block").agg(F.sum("documents").alias("d"), F.sum(tokens).alias("t"))
    up = Window.partitionBy(*by).orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    blocks = blocks.select(
        *[F.col(b).alias(f"_{i}") for i, b in enumerate(by)],
        F.col("block").alias("_block"),
        F.coalesce(F.sum("d").over(up), F.lit(0)).alias("d_above"),
        F.coalesce(F.sum("t").over(up), F.lit(0)).alias("t_above"),
        F.sum("d").over(whole).alias("d_all"),
        F.sum("t").over(whole).alias("t_all"),
    )
    same = F.col("block") == F.col("_block")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_{i}"))
    inside = Window.partitionBy(*by, "block").orderBy(F.col("n_tokens").desc())
    joined = rows.join(blocks, same)
    documents = F.sum("documents").over(inside) + F.col("d_above")
    at_least = F.sum(tokens).over(inside) + F.col("t_above")
    out = joined.select(
        *by,
        "n_tokens",
        "documents",
        tokens.alias("tokens"),
        documents.alias("documents_at_least"),
        at_least.alias("tokens_at_least"),
        "d_all",
        "t_all",
    )
    below = F.col("t_all") - F.col("tokens_at_least")
    up_to = F.col("d_all") - F.col("documents_at_least") + F.col("documents")
    return out.select(
        *by,
        "n_tokens",
        "documents",
        "tokens",
        "documents_at_least",
        "tokens_at_least",
        up_to.alias("documents_up_to"),
        (up_to / F.col("d_all")).alias("share_up_to"),
        (below + F.col("n_tokens") * F.col("documents_at_least")).alias("truncated_total"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, documents_over, truncated_total) for any context limits, whether they occur as lengths or not."""
    wanted = F.explode(F.array(*[F.lit(n).cast("long") for n in limits])).alias("limit")
    # With F the documents above the limit, the cut total is the tokens at or below it plus limit * F.
    over = F.col("n_tokens") > F.col("limit")
    return (
        sums.select("n_tokens", "documents", "tokens", wanted)
        .groupBy("limit")
        .agg(
            F.sum(F.when(over, F.col("documents")).otherwise(0)).alias("documents_over"),
            F.sum(F.when(over, F.col("limit") * F.col("documents")).otherwise(F.col("tokens"))).alias("truncated_total"),
        )
    )


def quantile(sums: DataFrame, share: float) -> Column:
    """Aggregate column: the least length that at least ``share`` of the documents do not exceed."""
    return F.min(F.when(F.col("share_up_to") >= share, F.col("n_tokens")))
