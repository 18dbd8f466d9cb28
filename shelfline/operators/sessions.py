"""What is looked at together in a session: rules from ordered and from unordered pairs of items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators.keyed import order_by_key
from shelfline.session import stored


def following_pairs(steps: DataFrame, key: str, session: str, item: str, gap: int = 3, order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """(key, session, antecedent, consequent): items of a session and the different ones that follow within `gap` steps, each pair once a session.

    A step meets the next `gap` ones of its key, so the pairs grow with the steps and not with their square, whatever a session's length; a key with very many
    steps is cut into slices that overlap by `gap` rows. Steps without an item keep their place but are in no pair.
    """
    keyed = order_by_key(steps, [key], order, after=gap)
    spec = keyed.window()
    later = F.array(*(F.struct(F.lead(session, k).over(spec).alias("s"), F.lead(item, k).over(spec).alias("i")) for k in range(1, gap + 1)))
    met = keyed.finish(keyed.df.withColumn("_later", later))
    pairs = met.select(key, session, F.col(item).alias("antecedent"), F.explode("_later").alias("l"))
    kept = pairs.where((F.col("l.s") == F.col(session)) & (F.col("l.i") != F.col("antecedent")))
    return kept.select(key, session, "antecedent", F.col("l.i").alias("consequent")).distinct()


def session_rules(
    steps: DataFrame, key: str, session: str, item: str, gap: int = 3, min_sessions: int = 2, min_confidence: float = 0.0, order: Sequence[str] = ("ts", "seq")
) -> DataFrame:
    """Rules `antecedent` before `consequent`: `together` sessions have both in that order within `gap` steps.

    `confidence` is their share of the sessions with the antecedent, `support` that of all sessions. Rules of fewer than `min_sessions` sessions
    are left out.
    """
    held = stored(steps.select(key, session, item).distinct())
    sessions = held.select(key, session).distinct().count()  # whether or not they have an item
    having = held.where(F.col(item).isNotNull()).groupBy(F.col(item).alias("antecedent")).agg(F.count("*").alias("having"))
    pairs = following_pairs(steps, key, session, item, gap, order)
    together = pairs.groupBy("antecedent", "consequent").agg(F.count("*").alias("together")).where(F.col("together") >= min_sessions)
    return (
        together.join(having, "antecedent")
        .select(
            "antecedent",
            "consequent",
            "together",
            (F.col("together") / F.col("having")).alias("confidence"),
            (F.col("together") / F.lit(sessions)).alias("support"),
        )
        .where(F.col("confidence") >= min_confidence)
    )
