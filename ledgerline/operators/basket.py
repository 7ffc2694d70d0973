"""Market baskets: item sets, association rules and their rendering."""

from __future__ import annotations

import warnings

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import join_sorted, split_tags
from ledgerline.model import StarModel, with_known
from ledgerline.session import freeze

# Support, lift and rendering of published rules.
MIN_SUPPORT = 0.01
MIN_LIFT = 1.0
ACTIONABLE_LIFT = 1.2
ARROW = "  ->  "
# Fixed output: how a rule is read out.
RULE_SENTENCE = "Users who order %s also order %s (lift %.3fx, confidence %.0f%%, support %.1f%%)"

# Baskets of this mean size below this support are reported as dense.
DENSE_BASKET, DENSE_SUPPORT = 12, 0.5
# Bits of a mask that one row of an item set unfolds into at once.
LOW_BITS = 12


def tag_pairs(model: StarModel, basket: str | None = None) -> DataFrame:
    """Distinct (basket, tag) pairs from the sellers that a basket's orders touch.

    Repeat orders collapse to one (basket, seller) row before the tag list is exploded.
    """
    c = model.c
    basket = basket or c.user
    touched = with_known(model.orders, basket, c.seller).select(basket, c.seller).distinct()
    tags = model.restaurant.select(c.seller, F.explode(split_tags(F.col(c.tags))).alias("item"))
    return touched.join(tags, c.seller).select(F.col(basket).alias("basket"), "item").distinct()


def build_baskets(pairs: DataFrame) -> DataFrame:
    """One sorted item array per basket; its length is bounded by the number of items."""
    return pairs.groupBy("basket").agg(F.array_sort(F.collect_set("item")).alias("items"))


def frequent_itemsets(baskets: DataFrame, min_support: float = MIN_SUPPORT, max_len: int | None = None) -> DataFrame:
    """Item sets with their support, mined in parallel by FP-growth.

    The number of sets grows with the density of the baskets, not with their number: raise
    ``min_support`` where baskets hold most of the items. ``max_len`` selects from the result.
    """
    baskets = freeze(baskets)
    shape = baskets.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("items")).alias("mean")).first()
    total = shape["n"]
    if (shape["mean"] or 0) > DENSE_BASKET and min_support < DENSE_SUPPORT:
        warnings.warn(f"baskets hold {shape['mean']:.1f} items on average: expect very many item sets", stacklevel=2)
    model = FPGrowth(itemsCol="items", minSupport=min_support).fit(baskets)
    sets = model.freqItemsets.select(
        F.array_sort("items").alias("items"),
        F.col("freq"),
        (F.col("freq").cast("double") / F.lit(float(total))).alias("support"),
    )
    return sets.where(F.size("items") <= max_len) if max_len else sets


def _splits(sets: DataFrame, low_bits: int) -> DataFrame:
    """(items, support, mask) of every split of an item set into two non-empty parts.

    A set of many items is first dealt out in ranges of masks, which go to different tasks, and a range then
    unfolds into its masks: no row unfolds into more than 2**low_bits of them at once.
    """
    ranges = sets.where(F.size("items") > 1).withColumn("size", F.size("items"))
    dealt = ranges.withColumn("range", F.expr(f"explode(sequence(0L, shiftleft(1L, greatest(size - {low_bits}, 0)) - 1))"))
    # Only large sets are worth a shuffle.
    large = dealt.where(F.col("size") > low_bits).repartition("items", "range")
    every = dealt.where(F.col("size") <= low_bits).unionByName(large)
    masks = every.withColumn("low", F.expr(f"explode(sequence(0L, shiftleft(1L, least(size, {low_bits})) - 1))"))
    masks = masks.withColumn("mask", F.expr(f"shiftleft(range, {low_bits}) | low"))
    return masks.where("mask > 0 AND mask < shiftleft(1L, size) - 1").select("items", "support", "mask")


def association_rules(itemsets: DataFrame, min_lift: float = MIN_LIFT, low_bits: int = LOW_BITS) -> DataFrame:
    """Every split of every item set into two non-empty parts, with confidence and lift.

    A bit mask per split picks the antecedent; the supports of both parts are looked up by joining
    the item sets to themselves on the sorted array.
    """
    sets = freeze(itemsets)
    splits = _splits(sets, low_bits).select(
        "support",
        F.expr("filter(items, (item, i) -> (mask & shiftleft(1L, i)) != 0)").alias("antecedents"),
        F.expr("filter(items, (item, i) -> (mask & shiftleft(1L, i)) = 0)").alias("consequents"),
    )
    left = sets.select(F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support"))
    right = sets.select(F.col("items").alias("consequents"), F.col("support").alias("consequent_support"))
    rules = (
        splits.join(left, "antecedents")
        .join(right, "consequents")
        .withColumn("confidence", F.col("support") / F.col("antecedent_support"))
        .withColumn("lift", F.col("confidence") / F.col("consequent_support"))
    )
    return rules.where(F.col("lift") >= min_lift).select(
        "antecedents", "consequents", "antecedent_support", "consequent_support", "support", "confidence", "lift"
    )


def top_itemsets(itemsets: DataFrame, n: int = 10) -> DataFrame:
    return (
        itemsets.withColumn("itemset", join_sorted(F.col("items")))
        .orderBy(F.desc("freq"), "itemset")
        .limit(n)
        .select("itemset", "freq", "support")
    )


def top_rules(rules: DataFrame, n: int = 50, places: int = 4) -> DataFrame:
    """Best rules by lift, rendered as text and rounded; ties are ordered by their text.

    Lift is compared after rounding away floating-point noise, so both directions of a rule tie.
    """
    rendered = rules.select(
        join_sorted(F.col("antecedents")).alias("antecedents"),
        join_sorted(F.col("consequents")).alias("consequents"),
        *["support", "confidence", "lift"],
    ).withColumn("rule", F.concat("antecedents", F.lit(ARROW), "consequents"))
    best = rendered.orderBy(F.desc(F.round("lift", 9)), "antecedents", "consequents").limit(n)
    return best.select(
        "rule", "antecedents", "consequents", *[F.bround(m, places).alias(m) for m in ("support", "confidence", "lift")]
    )


def rule_labels(rules: DataFrame, width: int = 18) -> DataFrame:
    """Short labels for a chart of rules."""
    label = F.concat(F.substring("antecedents", 1, width), F.lit(ARROW), F.substring("consequents", 1, width))
    return rules.withColumn("label", label)


def explain_rules(rules: DataFrame, n: int = 3) -> DataFrame:
    """One sentence per leading rule and whether its lift is worth acting on."""
    best = rules.orderBy(F.desc("lift"), "antecedents", "consequents").limit(n)
    sentence = F.format_string(
        RULE_SENTENCE,
        "antecedents", "consequents", "lift", F.col("confidence") * 100, F.col("support") * 100,
    )
    return best.select(
        "antecedents", "consequents", sentence.alias("reading"), (F.col("lift") > ACTIONABLE_LIFT).alias("actionable")
    )
