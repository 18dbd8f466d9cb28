"""Counters, windows, shares and session features over the tracked events."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import metrics as M
from shelfline.operators.running import cents
from shelfline.plans import tables as t
from shelfline.plans.quiet import DAY, SESSIONS
from shelfline.plans.registry import query

BY = ("ts", "event_id")
WITH = "WITH " + t.EVENTS


@query("event_counts", WITH + " SELECT event_type, count(*) AS n FROM tracked GROUP BY 1")
def event_counts(spark, folder):
    return M.event_counts(t.events(spark, folder))


@query(
    "user_product_views",
    WITH + " SELECT user_id, product_id, count(*) AS views FROM tracked WHERE event_type = 'PRODUCT_VIEW' AND product_id IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2",
)
def user_product_views(spark, folder):
    return M.user_product_views(t.events(spark, folder))


@query(
    "user_category_views",
    WITH + " SELECT user_id, CAST(product_id % 12 AS VARCHAR) AS category_id, count(*) AS views FROM tracked WHERE event_type = 'CATEGORY_BROWSE' GROUP BY 1, 2",
)
def user_category_views(spark, folder):
    events = t.events(spark, folder).withColumn("category_id", (F.col("product_id") % 12).cast("string"))
    return M.user_category_views(events)


@query(
    "inventory_state",
    "WITH " + t.CATALOGUE + " SELECT count(*) AS total_products, count(DISTINCT category) AS total_categories, CAST(sum(inventory) AS BIGINT) AS total_units FROM catalogue",
)
def inventory_state(spark, folder):
    return M.inventory_state(t.catalogue(spark, folder))


@query("distinct_categories", "SELECT DISTINCT p_type AS category FROM part")
def distinct_categories(spark, folder):
    return M.distinct_values(t.catalogue(spark, folder), "category")


@query("distinct_languages", "SELECT DISTINCT lang FROM documents")
def distinct_languages(spark, folder):
    return M.distinct_values(t.table(spark, folder, "documents"), "lang")


NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations")


@query("row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in NAMES))
def row_counts(spark, folder):
    return M.row_counts({n: t.table(spark, folder, n) for n in NAMES})


@query(
    "online_users",
    """WITH p AS (SELECT user_id, epoch_us(ts) // 1000 AS ts, event_id, event_type FROM events WHERE event_type IN ('signup', 'error'))
SELECT user_id FROM p QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND event_type = 'signup'""",
)
def online_users(spark, folder):
    presence = t.table(spark, folder, "events").select(
        "user_id", t.millis("ts").alias("ts"), "event_id",
        F.when(F.col("event_type") == "signup", "USER_JOINED").when(F.col("event_type") == "error", "USER_LEFT").alias("type"),
    )
    return M.online_users(presence, BY)


@query(
    "session_seen",
    """SELECT DISTINCT l_orderkey AS session_id, 'product' AS kind, CAST(l_partkey AS VARCHAR) AS seen FROM lineitem
UNION ALL SELECT DISTINCT l_orderkey, 'category', l_returnflag FROM lineitem""",
)
def session_seen(spark, folder):
    rows = t.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("session_id"), F.col("l_partkey").alias("product_id"), F.col("l_returnflag").alias("category_id")
    )
    return M.session_seen(rows)


@query(
    "kpis",
    WITH + """ SELECT count(*) FILTER (WHERE event_type = 'ORDER_PLACED') AS orders,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE event_type = 'ORDER_PLACED') AS BIGINT) AS revenue_cents,
       count(DISTINCT user_id) AS active_users, count(DISTINCT user_id) FILTER (WHERE event_type = 'ORDER_PLACED') AS buyers,
       count(DISTINCT user_id) FILTER (WHERE event_type = 'ORDER_PLACED')::DOUBLE / count(DISTINCT user_id) AS conversion_rate
FROM tracked""",
)
def kpis(spark, folder):
    return M.kpis(t.events(spark, folder), cents(F.col("value")))


@query(
    "approximate_users",
    "WITH " + t.EVENTS + " SELECT DISTINCT event_type, true AS within_5_percent FROM tracked",
)
def approximate_users(spark, folder):
    """Whether the sketch's count is within 5 % of the exact one, per event type."""
    events = t.events(spark, folder)
    sketch = M.approximate_users(events, ["event_type"], 0.01)
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    name = next(c for c in sketch.columns if c != "event_type")
    near = F.abs(F.col(name) - F.col("exact")) <= F.greatest(F.col("exact") * 0.05, F.lit(1.0))
    return sketch.join(exact, "event_type").select("event_type", near.alias("within_5_percent"))


@query(
    "category_share",
    """WITH c AS (SELECT p_type AS category, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS amount_cents
           FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT category, amount_cents, amount_cents::DOUBLE / CAST(sum(amount_cents) OVER () AS BIGINT) AS share FROM c""",
)
def category_share(spark, folder):
    part = t.table(spark, folder, "part").select("p_partkey", F.col("p_type").alias("category"))
    lines = t.table(spark, folder, "lineitem").select("l_partkey", "l_extendedprice")
    rows = lines.join(part, lines.l_partkey == part.p_partkey)
    return M.category_share(rows, "category", cents(F.col("l_extendedprice")))


@query(
    "seen_in_last_hours",
    WITH + """ SELECT a.event_id, a.user_id, count(*) AS recent FROM tracked a JOIN tracked b ON b.user_id = a.user_id
  AND (b.ts, b.event_id) <= (a.ts, a.event_id) AND b.ts >= a.ts - 43200000 GROUP BY 1, 2""",
)
def seen_in_last_hours(spark, folder):
    return M.seen_in_last(t.events(spark, folder), DAY // 2, order=BY).select("event_id", "user_id", "recent")


@query(
    "session_features",
    SESSIONS + """,
d AS (SELECT *, CASE WHEN lead(session_no) OVER w = session_no THEN lead(ts) OVER w - ts END AS dwell
      FROM numbered WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
f AS (SELECT user_id, session_no, count(*) AS depth, count(*) FILTER (WHERE event_type = 'PRODUCT_VIEW') AS views,
             count(*) FILTER (WHERE event_type = 'RECOMMENDATION_CLICKED') AS clicks,
             count(*) FILTER (WHERE event_type = 'ORDER_PLACED') AS orders,
             CAST(sum(dwell) FILTER (WHERE event_type = 'PRODUCT_VIEW') AS BIGINT) AS s, count(dwell) FILTER (WHERE event_type = 'PRODUCT_VIEW') AS c
      FROM d GROUP BY 1, 2)
SELECT user_id, session_no, depth, views, clicks, CASE WHEN views > 0 THEN clicks::DOUBLE / views END AS click_rate,
       CASE WHEN c > 0 THEN s::DOUBLE / c END AS avg_view_ms, CASE WHEN views > 0 AND orders = 0 THEN 'High' ELSE 'Low' END AS abandonment_risk
FROM f""",
)
def session_features(spark, folder):
    return M.session_features(t.events(spark, folder), DAY // 2, order=BY)


@query(
    "category_affinity",
    """WITH v AS (SELECT o_custkey AS user_id, p_brand AS category, count(*) AS views FROM lineitem JOIN orders ON o_orderkey = l_orderkey
           JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT user_id, category, views FROM v QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY views DESC, category) = 1""",
)
def category_affinity(spark, folder):
    part = t.table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("category"))
    orders = t.table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
    lines = t.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    return M.category_affinity(lines.join(part, "l_partkey").join(orders, "l_orderkey"))


@query(
    "salted_totals",
    """SELECT l_returnflag AS flag, count(*) AS n, CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS total,
       count(DISTINCT l_partkey) AS distinct_values FROM lineitem GROUP BY 1""",
)
def salted_totals(spark, folder):
    rows = t.table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_quantity").cast("int").alias("quantity"), "l_partkey"
    )
    return M.salted_totals(rows, ["flag"], "quantity", "l_partkey")


def timed(spark, folder):
    return t.table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("event_time"), F.col("event_type").alias("category"), cents(F.col("value")).alias("value_cents")
    )


@query(
    "tumbling_windows",
    """SELECT epoch_us(ts) // 300000000 * 300000 AS window_start, event_type AS category, count(*) AS n,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents FROM events GROUP BY 1, 2""",
)
def tumbling_windows(spark, folder):
    return M.tumbling(timed(spark, folder), ["category"])


@query(
    "sliding_windows",
    """SELECT (epoch_us(ts) // 60000000 - k) * 60000 AS window_start, event_type AS category, count(*) AS n,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents FROM events, range(10) r(k) GROUP BY 1, 2""",
)
def sliding_windows(spark, folder):
    return M.sliding(timed(spark, folder), ["category"])
