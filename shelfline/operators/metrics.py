"""Counters, distributions, shares, window aggregates and session features of tracked events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.keyed import latest, order_by_key, running
from shelfline.operators.timers import number_sessions

ORDER = ("ts", "seq")


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("n"))


def user_product_views(events: DataFrame) -> DataFrame:
    """Product views per user and product; events without either are skipped."""
    seen = (F.col("event_type") == "PRODUCT_VIEW") & F.col("product_id").isNotNull() & F.col("user_id").isNotNull()
    return events.where(seen).groupBy("user_id", "product_id").agg(F.count("*").alias("views"))


def user_category_views(events: DataFrame, category_too: bool = False) -> DataFrame:
    """Category browses per user and category.

    Only `category_id` counts; with `category_too` the other spelling of the field counts as well.
    """
    category = F.coalesce("category_id", "category") if category_too else F.col("category_id")
    seen = (F.col("event_type") == "CATEGORY_BROWSE") & category.isNotNull() & F.col("user_id").isNotNull()
    return events.where(seen).groupBy("user_id", category.alias("category_id")).agg(F.count("*").alias("views"))


def inventory_state(view: DataFrame) -> DataFrame:
    """Product count, category count and units in stock; the list itself is the view."""
    return view.agg(
        F.count("*").alias("total_products"),
        F.count_distinct("category").alias("total_categories"),
        F.sum(F.col("inventory").cast("long")).alias("total_units"),
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, as after a load."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out


def online_users(presence: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Users whose last presence message is a join."""
    messages = presence.where(F.col("type").isin("USER_JOINED", "USER_LEFT"))
    now = latest(messages.select("user_id", "type", *order), ["user_id"], order)
    return now.where(F.col("type") == "USER_JOINED").select("user_id")


def session_seen(events: DataFrame, key: str = "session_id") -> DataFrame:
    """Distinct products and categories per session, as rows."""
    pair = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("seen"))
    both = F.explode(F.array(pair("product", "product_id"), pair("category", "category_id")))
    return events.select(key, both.alias("s")).select(key, "s.*").where(F.col("seen").isNotNull()).distinct()


def kpis(events: DataFrame, revenue: Column) -> DataFrame:
    """Orders, revenue, active users and orders per active user."""
    ordered = F.col("event_type") == "ORDER_PLACED"
    return events.agg(
        F.count_if(ordered).alias("orders"),
        F.sum(F.when(ordered, revenue)).alias("revenue_cents"),
        F.count_distinct("user_id").alias("active_users"),
        F.count_distinct(F.when(ordered, F.col("user_id"))).alias("buyers"),
    ).withColumn("conversion_rate", F.try_divide(F.col("buyers"), F.col("active_users")))


def approximate_users(events: DataFrame, by: Sequence[str] = (), rsd: float = 0.02) -> DataFrame:
    """Active users per group from sketches that merge, for dashboards over very long ranges."""
    return events.groupBy(*by).agg(F.approx_count_distinct("user_id", rsd).alias("active_users"))


def category_share(rows: DataFrame, category: str, amount: Column) -> DataFrame:
    """Amount per category and its share of the total, largest first."""
    per = rows.groupBy(category).agg(F.sum(amount).alias("amount_cents"))
    total = per.agg(F.sum("amount_cents").alias("_total"))  # one row
    return (
        per.join(F.broadcast(total), F.lit(True))
        .withColumn("share", F.try_divide(F.col("amount_cents"), F.col("_total")))
        .drop("_total")
    )


def seen_in_last(events: DataFrame, window_ms: int, key: str = "user_id", order: Sequence[str] = ORDER) -> DataFrame:
    """Per event the number of the key's events in the `window_ms` up to it (`recent`).

    Every event adds one when it comes and takes it away when the window has passed, so a running
    sum counts the window; a range frame would need all of a hot key in one task.
    """
    ts, *rest = order
    step = F.explode(
        F.array(
            F.struct(F.lit(0).alias("_gone"), F.lit(1).alias("_step"), F.col(ts).alias("_at")),
            F.struct(F.lit(1).alias("_gone"), F.lit(-1).alias("_step"), (F.col(ts) + window_ms).alias("_at")),
        )
    )
    steps = events.select("*", step.alias("_s")).select(*events.columns, "_s.*")
    keyed = order_by_key(steps, [key], ["_at", "_gone", *rest])
    out = keyed.finish(running(keyed, keyed.df, {"recent": ("sum", F.col("_step"))}))
    return out.where(F.col("_gone") == 0).drop("_gone", "_step", "_at")


def session_features(events: DataFrame, gap_ms: int, key: str = "user_id", order: Sequence[str] = ORDER) -> DataFrame:
    """Depth, views, clicks, click rate and mean time on a view, per session."""
    sessions = number_sessions(events, gap_ms, key, order, chain=True)
    keyed = order_by_key(sessions, [key], order, after=1)
    spec = keyed.window()
    same = F.lead("session_no").over(spec) == F.col("session_no")
    dwell = keyed.finish(keyed.df.withColumn("dwell_ms", F.when(same, F.lead("ts").over(spec) - F.col("ts"))))
    view, click = F.col("event_type") == "PRODUCT_VIEW", F.col("event_type") == "RECOMMENDATION_CLICKED"
    return (
        dwell.groupBy(key, "session_no")
        .agg(
            F.count("*").alias("depth"),
            F.count_if(view).alias("views"),
            F.count_if(click).alias("clicks"),
            F.sum(F.when(view, F.col("dwell_ms"))).alias("_dwell"),
            F.count(F.when(view, F.col("dwell_ms"))).alias("_dwells"),
            F.count_if(F.col("event_type") == "ORDER_PLACED").alias("orders"),
        )
        .withColumn("click_rate", F.try_divide(F.col("clicks"), F.col("views")))
        .withColumn("avg_view_ms", F.try_divide(F.col("_dwell"), F.col("_dwells")))
        .withColumn("abandonment_risk", F.when((F.col("views") > 0) & (F.col("orders") == 0), "High").otherwise("Low"))
        .drop("_dwell", "_dwells", "orders")
    )


def category_affinity(views: DataFrame, key: str = "user_id", category: str = "category") -> DataFrame:
    """Each user's most seen category; ties go to the first name."""
    counts = views.groupBy(key, category).agg(F.count("*").alias("views"))
    best = F.min_by(F.struct(category, "views"), F.struct(-F.col("views"), F.col(category)))
    return counts.groupBy(key).agg(best.alias("_b")).select(key, "_b.*")


def salted_totals(rows: DataFrame, keys: Sequence[str], value: str, distinct: str, salts: int = 32) -> DataFrame:
    """Count, sum and distinct count per key in two steps, with a hot key spread over `salts` tasks.

    The salt is a hash of the counted column, so each distinct value lives in one salt only and the
    distinct counts of the salts add up.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(distinct), F.lit(salts)))
    per_value = salted.groupBy(*keys, "_salt", distinct).agg(
        F.count("*").alias("_n"), F.sum(value).alias("_v")
    )
    per_salt = per_value.groupBy(*keys, "_salt").agg(
        F.sum("_n").alias("_n"), F.sum("_v").alias("_v"), F.count(distinct).alias("_d")
    )
    return per_salt.groupBy(*keys).agg(
        F.sum("_n").alias("n"), F.sum("_v").alias("total"), F.sum("_d").alias("distinct_values")
    )


def tumbling(events: DataFrame, by: Sequence[str], width: str = "5 minutes", at: str = "event_time") -> DataFrame:
    """Events per event-time window and group."""
    return _windowed(events.groupBy(F.window(at, width), *by), by)


def sliding(events: DataFrame, by: Sequence[str], width: str = "10 minutes", slide: str = "1 minute", at: str = "event_time") -> DataFrame:
    return _windowed(events.groupBy(F.window(at, width, slide), *by), by)


def _windowed(grouped, by: Sequence[str]) -> DataFrame:
    return grouped.agg(F.count("*").alias("n"), F.sum("value_cents").alias("value_cents")).select(
        F.unix_millis("window.start").alias("window_start"), *by, "n", "value_cents"
    )
