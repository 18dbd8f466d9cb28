"""Timers in their batch form: stale products, snapshots, sessions, abandoned carts."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import ledger as L
from shelfline.operators import timers as T
from shelfline.plans import tables as t
from shelfline.plans.inventory import LEDGER
from shelfline.plans.registry import query
from shelfline.plans.state import HORIZON

DAY = 86_400_000


@query(
    "stale_inventory",
    LEDGER + f""",
nx AS (SELECT *, lead(ts) OVER (PARTITION BY product_id ORDER BY {t.BY_LINE}) AS nxt FROM ledger)
SELECT product_id, ts + {30 * DAY} AS ts, 'part-' || product_id AS product_name, 'STALE_INVENTORY' AS event_type,
       current_inventory, 'No updates for 720.0 hours' AS change_reason
FROM nx WHERE nxt - ts > {30 * DAY} OR (nxt IS NULL AND {HORIZON} - ts >= {30 * DAY})""",
)
def stale_inventory(spark, folder):
    entries = L.ledger(t.ledger_rows(spark, folder), t.LINE_ORDER, chain=True)
    return T.stale_events(T.stale(entries, HORIZON, 30 * DAY, t.LINE_ORDER), 30 * DAY)


@query(
    "stale_severity",
    "WITH " + t.PRODUCT_UPDATES + f""",
nx AS (SELECT *, lead(ts) OVER (PARTITION BY product_id ORDER BY {t.BY_LINE}) AS nxt FROM product_updates)
SELECT product_id, name, inventory AS last_inventory, ts AS last_update_ts, ts + {60 * DAY} AS stale_ts,
       coalesce(nxt, {HORIZON}) - ts AS stale_ms,
       CASE WHEN coalesce(nxt, {HORIZON}) - ts > {120 * DAY} THEN 'HIGH' ELSE 'MEDIUM' END AS severity
FROM nx WHERE nxt - ts > {60 * DAY} OR (nxt IS NULL AND {HORIZON} - ts >= {60 * DAY})""",
)
def stale_severity(spark, folder):
    out = T.stale(t.product_updates(spark, folder), HORIZON, 60 * DAY, t.LINE_ORDER)
    return out.select(
        "product_id", "name", F.col("inventory").alias("last_inventory"), F.col("ts").alias("last_update_ts"),
        "stale_ts", "stale_ms", "severity",
    )


@query(
    "snapshots",
    "WITH " + t.PRODUCT_UPDATES + f""",
first AS (SELECT product_id, min(ts) AS start FROM product_updates GROUP BY 1),
ticks AS (SELECT product_id, unnest(range(start + {90 * DAY}, {HORIZON} + 1, {90 * DAY})) AS snapshot_ts FROM first),
seen AS (SELECT k.product_id, snapshot_ts, inventory, price,
                row_number() OVER (PARTITION BY k.product_id, snapshot_ts ORDER BY {", ".join("u." + c + " DESC" for c in t.LINE_ORDER)}) AS rn
         FROM ticks k JOIN product_updates u ON u.product_id = k.product_id AND u.ts <= snapshot_ts)
SELECT product_id, snapshot_ts, inventory, price FROM seen WHERE rn = 1""",
)
def snapshots(spark, folder):
    out = T.snapshots(t.product_updates(spark, folder), HORIZON, 90 * DAY, t.LINE_ORDER)
    return out.select("product_id", "snapshot_ts", "inventory", "price")


SESSIONS = "WITH " + t.EVENTS + f""",
g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < {DAY // 2} THEN 0 ELSE 1 END AS fresh
      FROM tracked WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no
      FROM g)"""


@query(
    "session_timeouts",
    SESSIONS + f"""
SELECT user_id, session_no, min(ts) AS session_start, max(ts) + {DAY // 2} AS timeout_ts, count(*) AS item_count,
       max(ts) + {DAY // 2} - min(ts) AS duration_ms FROM numbered GROUP BY 1, 2""",
)
def session_timeouts(spark, folder):
    return T.session_timeouts(t.events(spark, folder), DAY // 2, order=("ts", "event_id"))


@query("session_items", SESSIONS + " SELECT user_id, session_no, ts, event_id, product_id FROM numbered")
def session_items(spark, folder):
    out = T.number_sessions(t.events(spark, folder), DAY // 2, order=("ts", "event_id"))
    return out.select("user_id", "session_no", "ts", "event_id", "product_id")


@query(
    "abandoned_carts",
    "WITH " + t.EVENTS + f"""
SELECT a.user_id, a.ts, a.event_id, a.product_id FROM tracked a
WHERE a.event_type = 'PRODUCT_VIEW' AND NOT EXISTS (
  SELECT 1 FROM tracked o WHERE o.user_id = a.user_id AND o.event_type = 'ORDER_PLACED'
    AND (o.ts, o.event_id) > (a.ts, a.event_id) AND o.ts - a.ts <= {2 * DAY})""",
)
def abandoned_carts(spark, folder):
    """Views stand in for cart adds: the given events have no cart adds."""
    out = T.abandoned(t.events(spark, folder), 2 * DAY, order=("ts", "event_id"), start="PRODUCT_VIEW")
    return out.select("user_id", "ts", "event_id", "product_id")
