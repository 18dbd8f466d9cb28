"""Items bought together: association rules over baskets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.session import stored


def pair_rules(lines: DataFrame, basket: str, item: str, min_support: float = 0.01, min_confidence: float = 0.0) -> DataFrame:
    """Rules from one item to one item: `antecedent, consequent, confidence, support, together, baskets`.

    Items below `min_support` cannot be in a rule and go first, so a basket holds at most the frequent items: no more
    than (mean basket size / `min_support`) of them however long it is. Its pairs are counted once, before the shuffle where
    they repeat, and give a rule each way.
    """
    bought, baskets, counts = _bought(lines, basket, item, min_support)
    items = bought.join(counts.select(item), item).groupBy(basket).agg(F.sort_array(F.collect_set(item)).alias("_items"))
    first = items.select(F.posexplode("_items").alias("_at", "a"), "_items")
    pairs = first.select("a", F.explode(F.expr("slice(_items, _at + 2, size(_items))")).alias("b"))
    together = pairs.groupBy("a", "b").agg(F.count("*").alias("together")).where(F.col("together") >= min_support * baskets)
    both = F.explode(F.array(F.struct(F.col("a").alias("antecedent"), F.col("b").alias("consequent")), F.struct(F.col("b").alias("antecedent"), F.col("a").alias("consequent"))))
    rules = together.select("together", both.alias("r")).select("r.*", "together")
    return (
        rules.join(counts.withColumnRenamed(item, "antecedent"), "antecedent")
        .select(
            "antecedent",
            "consequent",
            (F.col("together") / F.col("_n")).alias("confidence"),
            (F.col("together") / F.lit(baskets)).alias("support"),
            "together",
            F.lit(baskets).cast("long").alias("baskets"),
        )
        .where(F.col("confidence") >= min_confidence)
    )


def _bought(lines: DataFrame, basket: str, item: str, min_support: float) -> tuple[DataFrame, int, DataFrame]:
    """What each basket holds, the number of baskets, and the frequent items with their counts `_n`; read once, written once."""
    bought = stored(lines.select(basket, item).distinct())
    baskets = bought.select(basket).distinct().count()
    counts = bought.where(F.col(item).isNotNull()).groupBy(item).agg(F.count("*").alias("_n"))
    return bought, baskets, stored(counts.where(F.col("_n") >= min_support * baskets))


def as_recommendations(rules: DataFrame, kind: str, timestamp: Column) -> DataFrame:
    """Rules in the shape of the recommendation messages (`BASKET_BASED`, `VIEW_BASED`, `SESSION_BASED`)."""
    return rules.select(
        F.lit(kind).alias("recommendation_type"),
        F.col("antecedent").alias("trigger"),
        F.array("consequent").alias("recommended_products"),
        "confidence",
        timestamp.alias("timestamp"),
    )
