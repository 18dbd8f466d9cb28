"""Materialised views over keyed streams, and the joins around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators.keyed import latest
from shelfline.operators.ledger import KEY

ORDER = ("ts", "seq")


def merge_partial(
    full: DataFrame,
    partial: DataFrame,
    fields: Sequence[str] = ("inventory", "price"),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """The product view: the last full row per product with later partial updates merged in.

    Only non-null fields merge; partial rows of a product without a full row, or before its last
    full row, have no effect. Full rows have all `fields` set, so the newest non-null value over
    both inputs is the merged one and a single aggregate answers it.
    """
    both = full.withColumn("_full", F.lit(True)).unionByName(
        partial.select(KEY, *order, *fields).withColumn("_full", F.lit(False)), allowMissingColumns=True
    )
    at = F.struct(*order)
    rest = [c for c in full.columns if c != KEY]
    base = F.max_by(F.when(F.col("_full"), F.struct(*rest)), F.when(F.col("_full"), at))
    merged = both.groupBy(KEY).agg(
        base.alias("_base"),
        *(
            F.max_by(f, F.when(F.col(f).isNotNull(), at)).alias(f"_new_{f}")
            for f in fields
        ),
    )
    return merged.where(F.col("_base").isNotNull()).select(
        KEY,
        *(
            F.coalesce(F.col(f"_new_{c}"), F.col("_base")[c]).alias(c) if c in fields else F.col("_base")[c].alias(c)
            for c in rest
        ),
    )


def upsert_fields(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """Per key the newest non-null value of every field: present fields overwrite, absent ones stay."""
    at = F.struct(*order)
    fields = [c for c in rows.columns if c not in (*keys, *order)]
    return rows.groupBy(*keys).agg(
        *(F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in fields),
        *(F.max(at)[c].alias(c) for c in order),
    )


def lookup(rows: DataFrame, view: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """Rows joined with their view row, and the rows that have none."""
    return rows.join(view, key, "inner"), rows.join(view.select(key), key, "left_anti")


def looked_up(rows: DataFrame, view: DataFrame, key: str = KEY) -> DataFrame:
    """All rows with their view row's columns and `found`: one join, both inputs read once."""
    joined = rows.join(view.withColumn("found", F.lit(True)), key, "left")
    return joined.withColumn("found", F.coalesce("found", F.lit(False)))


def recommended_products(recommendations: DataFrame, view: DataFrame, first: int = 4) -> DataFrame:
    """The first `first` recommended ids as products, in their order; ids not in the view drop out."""
    kept = [c for c in recommendations.columns if c != "recommended_products"]
    ids = F.slice("recommended_products", 1, first)
    return recommendations.select(*kept, F.posexplode(ids).alias("position", KEY)).join(view, KEY, "inner")


def orders_with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Order lines with their order's columns; an order without lines keeps one row of nulls."""
    return orders.join(items, "order_id", "left")


def preferred_language(settings: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Each user's last language setting; users back on DEFAULT drop out."""
    return latest(settings, ["user_id"], order).where(F.col("language") != "DEFAULT")
