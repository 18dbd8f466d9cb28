"""Reads of the product view: listings, search, top lists, recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.ledger import KEY

SORTS = ("featured", "price-low", "price-high", "rating", "newest", "popular")


def in_category(category: str) -> Column:
    return F.lower("category") == category.lower()


def matches(text: str, tags: bool = False, brand: bool = False) -> Column:
    """Case-blind substring of name or description, on request also of brand and tags."""
    wanted = text.lower()
    fields = ["name", "description", *(["brand"] if brand else [])]
    hit = F.lit(False)
    for c in fields:
        hit = hit | F.coalesce(F.contains(F.lower(c), F.lit(wanted)), F.lit(False))
    if tags:
        hit = hit | F.coalesce(F.exists("tags", lambda t: F.contains(F.lower(t), F.lit(wanted))), F.lit(False))
    return hit


def _order(sort: str) -> list[Column]:
    by = {
        "featured": [],
        "price-low": [F.col("price").asc()],
        "price-high": [F.col("price").desc()],
        "rating": [F.coalesce("rating", F.lit(0.0)).desc()],
        "newest": [F.coalesce("ts", F.lit(0)).desc()] if sort == "newest" else [],
        "popular": [F.coalesce("review_count", F.lit(0)).desc()],
    }
    if sort not in by:
        raise ValueError(f"unknown sort {sort!r}; one of {', '.join(SORTS)}")
    return [*by[sort], F.col(KEY)]


def list_products(view: DataFrame, category: str | None = None, search: str | None = None, limit: int = 20, include_tags: bool = False) -> DataFrame:
    """A page of products by search text, else by category, else of all; ordered by id."""
    if search:
        view = view.where(matches(search, tags=include_tags))
    elif category:
        view = view.where(in_category(category))
    return view.orderBy(KEY).limit(limit)


def search_products(view: DataFrame, text: str) -> DataFrame:
    """All products with the text in name, description or a tag."""
    return view.where(matches(text, tags=True))


def browse(
    view: DataFrame,
    category: str | None = None,
    text: str | None = None,
    price: tuple[float | None, float | None] | None = None,
    sort: str = "featured",
) -> DataFrame:
    """The product page: exact category, text, price range, sort order. All matches, ranked by Spark's range sort.

    A price bound holds only where it is given, also on one side; products without a price are left out then.
    """
    if category and category != "All":
        view = view.where(F.col("category") == category)
    if text and text.strip():
        view = view.where(matches(text, tags=True, brand=True))
    low, high = price or (None, None)
    if low is not None:
        view = view.where(F.col("price") >= low)
    if high is not None:
        view = view.where(F.col("price") <= high)
    return view.orderBy(*_order(sort))


def trending(view: DataFrame, k: int = 8) -> DataFrame:
    return view.orderBy(F.col("review_count").desc(), KEY).limit(k)


def featured(view: DataFrame, k: int = 8) -> DataFrame:
    """The first `k` products rated 4 or better."""
    return view.where(F.col("rating") >= 4.0).orderBy(KEY).limit(k)


def featured_by_score(view: DataFrame, k: int = 8) -> DataFrame:
    """The top `k` by rating times reviews."""
    score = F.coalesce("rating", F.lit(0.0)) * F.coalesce("review_count", F.lit(0))
    return view.withColumn("score", score).orderBy(F.col("score").desc(), KEY).limit(k)


def first_recommendation(view: DataFrame, k: int = 5) -> DataFrame:
    """The fixed recommendation: the ids of the first `k` products, one row."""
    first = view.select(KEY).orderBy(KEY).limit(k)
    return first.agg(F.sort_array(F.collect_list(KEY)).alias("recommended_products"))


def unseen_recommendations(sessions: DataFrame, seen: DataFrame, view: DataFrame, k: int = 5) -> DataFrame:
    """Per session the trending candidates its events have not touched.

    `sessions` has `session_id`; `seen` distinct `session_id, product_id`. The candidates are `k`
    fixed rows, so each session is checked against `k` products, not against the catalogue.
    """
    candidates = trending(view, k).select(KEY, F.col("review_count").alias("_rank")).withColumn("_one", F.lit(1))
    pairs = sessions.withColumn("_one", F.lit(1)).join(F.broadcast(candidates), "_one").drop("_one")
    active = seen.select("session_id").distinct().withColumn("_active", F.lit(True))
    return (
        pairs.join(seen.select("session_id", KEY), ["session_id", KEY], "left_anti")
        .join(active, "session_id", "left")
        .select(
            "session_id",
            KEY,
            F.when(F.col("_active"), "PERSONALIZED").otherwise("TRENDING_NOW").alias("type"),
            F.when(F.col("_active"), "Based on your recent activity").otherwise("Trending products").alias("reason"),
        )
    )


def recent_points(points: DataFrame, window_ms: int = 30_000, ts: str = "ts") -> DataFrame:
    """The points of the last `window_ms` before the newest one."""
    newest = points.agg(F.max(ts).alias("_newest"))  # one row
    return points.join(F.broadcast(newest), F.col(ts) > F.col("_newest") - window_ms).drop("_newest")
