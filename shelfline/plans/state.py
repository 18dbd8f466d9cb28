"""Change detection and running state over catalogue updates and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import changes as C
from shelfline.operators import ledger as L
from shelfline.operators import running as R
from shelfline.plans import tables as t
from shelfline.plans.registry import query

LAGGED = (
    "WITH " + t.PRODUCT_UPDATES + f""",
lagged AS (
  SELECT *, lag(inventory) OVER w AS prev, lag(price) OVER w AS old, lag(ts) OVER w AS prev_ts
  FROM product_updates WINDOW w AS (PARTITION BY product_id ORDER BY {t.BY_LINE}))"""
)
KEYS = ["product_id", "ts", "order_id", "line_no"]


@query(
    "change_tracker",
    LAGGED + """
SELECT product_id, ts, order_id, line_no, 'NEW_PRODUCT' AS change_type, 0 AS previous_inventory,
       inventory AS current_inventory, CAST(NULL AS INT) AS delta, CAST(NULL AS DOUBLE) AS previous_price,
       CAST(NULL AS DOUBLE) AS current_price, CAST(NULL AS BIGINT) AS ms_since_last
FROM lagged WHERE prev_ts IS NULL
UNION ALL SELECT product_id, ts, order_id, line_no, CASE WHEN inventory > prev THEN 'RESTOCK' ELSE 'SALE' END, prev,
       inventory, inventory - prev, NULL, NULL, ts - prev_ts FROM lagged WHERE prev <> inventory
UNION ALL SELECT product_id, ts, order_id, line_no, 'PRICE_CHANGE', NULL, NULL, NULL, old, price, NULL
FROM lagged WHERE abs(price - old) > 0.01""",
)
def change_tracker(spark, folder):
    out = C.track_changes(t.product_updates(spark, folder), t.LINE_ORDER)
    return out.drop("supplier_id", "amount")


@query(
    "change_tracker_ttl",
    LAGGED + """,
alive AS (SELECT *, ts - prev_ts <= 2592000000 AS known FROM lagged)
SELECT product_id, ts, order_id, line_no, 'NEW_PRODUCT' AS change_type, inventory AS current_inventory
FROM alive WHERE prev_ts IS NULL OR NOT known
UNION ALL SELECT product_id, ts, order_id, line_no, CASE WHEN inventory > prev THEN 'RESTOCK' ELSE 'SALE' END, inventory
FROM alive WHERE known AND prev <> inventory
UNION ALL SELECT product_id, ts, order_id, line_no, 'PRICE_CHANGE', NULL FROM alive WHERE known AND abs(price - old) > 0.01""",
)
def change_tracker_ttl(spark, folder):
    out = C.track_changes(t.product_updates(spark, folder), t.LINE_ORDER, ttl_ms=30 * 86_400_000)
    return out.select(*KEYS, "change_type", "current_inventory")


@query(
    "product_events",
    LAGGED + """
SELECT product_id, ts, order_id, line_no, 'PRODUCT_ADDED' AS event_type, 0 AS previous_inventory, inventory AS current_inventory
FROM lagged WHERE prev_ts IS NULL
UNION ALL SELECT product_id, ts, order_id, line_no,
   CASE WHEN inventory = 0 THEN 'OUT_OF_STOCK' WHEN prev = 0 THEN 'BACK_IN_STOCK' WHEN inventory < prev THEN 'INVENTORY_DECREASED'
        ELSE 'INVENTORY_INCREASED' END, prev, inventory FROM lagged WHERE prev <> inventory
UNION ALL SELECT product_id, ts, order_id, line_no, 'PRICE_CHANGED', prev, inventory FROM lagged WHERE abs(price - old) > 0.01""",
)
def product_events(spark, folder):
    out = C.product_events(t.product_updates(spark, folder), t.LINE_ORDER)
    return out.select(*KEYS, "event_type", "previous_inventory", "current_inventory")


@query(
    "product_alerts",
    LAGGED + """
SELECT product_id, ts, order_id, line_no, 'LOW_STOCK' AS alert_type,
       CASE WHEN inventory <= 5 THEN 'CRITICAL' ELSE 'WARNING' END AS severity
FROM lagged WHERE inventory > 0 AND inventory < 10 AND (prev_ts IS NULL OR prev <> inventory)
UNION ALL SELECT product_id, ts, order_id, line_no, 'OUT_OF_STOCK', 'CRITICAL' FROM lagged
WHERE inventory = 0 AND (prev_ts IS NULL OR prev <> inventory)
UNION ALL SELECT product_id, ts, order_id, line_no, 'PRICE_DROP', 'INFO' FROM lagged
WHERE abs(price - old) > 0.01 AND (price - old) / old * 100 <= -10.0""",
)
def product_alerts(spark, folder):
    out = C.product_alerts(t.product_updates(spark, folder), t.LINE_ORDER)
    return out.select(*KEYS, "alert_type", "severity")


@query(
    "single_events",
    LAGGED + """
SELECT product_id, ts, order_id, line_no,
       CASE WHEN prev_ts IS NULL THEN 'PRODUCT_ADDED' WHEN prev <> inventory AND inventory = 0 THEN 'OUT_OF_STOCK'
            WHEN prev <> inventory AND prev = 0 THEN 'BACK_IN_STOCK' WHEN inventory < prev THEN 'INVENTORY_DECREASED'
            WHEN inventory > prev THEN 'INVENTORY_INCREASED' WHEN abs(old - price) > 0.01 THEN 'PRICE_CHANGED'
            ELSE 'PRODUCT_UPDATED' END AS event_type,
       CAST(NULL AS VARCHAR) AS alert_level, coalesce(prev, 0) AS previous_inventory, inventory AS current_inventory,
       prev_ts IS NULL AS is_initial_load, ts - prev_ts AS ms_since_last
FROM lagged
UNION ALL SELECT product_id, ts, order_id, line_no, 'LOW_STOCK_ALERT', CASE WHEN inventory <= 5 THEN 'CRITICAL' ELSE 'WARNING' END,
       NULL, inventory, NULL, NULL FROM lagged WHERE inventory BETWEEN 1 AND 10
UNION ALL SELECT product_id, ts, order_id, line_no, 'SALE_STARTED', NULL, NULL, inventory, NULL, NULL FROM lagged
WHERE prev = inventory AND abs(old - price) > 0.01 AND price < old AND (old - price) / old * 100 >= 10""",
)
def single_events(spark, folder):
    out = C.single_events(t.product_updates(spark, folder), t.LINE_ORDER)
    return out.select(
        *KEYS, "event_type", "alert_level", "previous_inventory", "current_inventory", "is_initial_load", "ms_since_last"
    )


SALES = LAGGED + """,
sales AS (SELECT *, prev - inventory AS units_sold, (prev - inventory) * CAST(round(price * 100) AS BIGINT) AS sale_cents
          FROM lagged WHERE inventory < prev)"""


@query(
    "sales_total",
    SALES + f"""
SELECT product_id, ts, order_id, line_no, units_sold, sale_cents,
       CAST(sum(sale_cents) OVER (PARTITION BY product_id ORDER BY {t.BY_LINE} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_cents
FROM sales""",
)
def sales_total(spark, folder):
    out = R.sales_total(t.product_updates(spark, folder), t.LINE_ORDER)
    return out.select(*KEYS, "units_sold", "sale_cents", "total_cents")


@query(
    "price_trend",
    "WITH " + t.PRODUCT_UPDATES + f"""
SELECT product_id, ts, order_id, line_no, price AS current_price,
       CAST(count(*) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS INT) AS history_size,
       min(price) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS lowest,
       first_value(price) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS oldest,
       CASE WHEN price > lag(price, 1) OVER w AND lag(price, 1) OVER w > lag(price, 2) OVER w THEN 'INCREASING'
            WHEN price < lag(price, 1) OVER w AND lag(price, 1) OVER w < lag(price, 2) OVER w THEN 'DECREASING'
            ELSE 'STABLE' END AS trend
FROM product_updates WINDOW w AS (PARTITION BY product_id ORDER BY {t.BY_LINE})""",
)
def price_trend(spark, folder):
    out = R.price_trend(t.product_updates(spark, folder), order=t.LINE_ORDER)
    return out.select(
        *KEYS,
        F.col("price").alias("current_price"),
        F.size("price_history").alias("history_size"),
        F.array_min("price_history").alias("lowest"),
        F.element_at("price_history", 1).alias("oldest"),
        "trend",
    )


@query(
    "category_sales",
    SALES + f""",
per AS (SELECT s.*, unnest(CASE WHEN p.p_type = p.p_brand THEN [p.p_type] ELSE [p.p_type, p.p_brand] END) AS category
        FROM sales s JOIN part p ON p.p_partkey = s.product_id)
SELECT product_id, ts, order_id, line_no, category, units_sold,
       CAST(sum(units_sold) OVER (PARTITION BY product_id, category ORDER BY {t.BY_LINE} ROWS UNBOUNDED PRECEDING) AS BIGINT)
         AS category_units
FROM per""",
)
def category_sales(spark, folder):
    part = t.table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.array("p_type", "p_brand").alias("categories")
    )
    products = t.product_updates(spark, folder).join(part, "product_id")
    return R.category_sales(products, t.LINE_ORDER).select(*KEYS, "category", "units_sold", "category_units")


@query(
    "running_stats",
    "WITH " + t.ORDER_ITEMS + f"""
SELECT product_id, ts, order_id, line_no, CAST(sum(qty) OVER w AS BIGINT) AS running_sum, count(qty) OVER w AS running_count,
       min(qty) OVER w AS running_min, max(qty) OVER w AS running_max,
       CAST(sum(qty) OVER w AS DOUBLE) / count(qty) OVER w AS running_avg
FROM order_items WINDOW w AS (PARTITION BY product_id ORDER BY {t.BY_LINE} ROWS UNBOUNDED PRECEDING)""",
)
def running_stats(spark, folder):
    out = R.running_stats(t.order_items(spark, folder), ["product_id"], "qty", t.LINE_ORDER)
    return out.select(*KEYS, "running_sum", "running_count", "running_min", "running_max", "running_avg")


@query(
    "anomalies",
    """WITH r AS (SELECT user_id AS device_id, epoch_us(ts) // 1000 AS ts, event_id AS seq, CAST(round(value * 100) AS BIGINT) AS reading FROM events),
s AS (SELECT *, CAST(sum(reading) OVER a AS DOUBLE) / count(reading) OVER a AS average,
             CAST(sum(reading) OVER n AS DOUBLE) AS s1, CAST(sum(reading * reading) OVER n AS DOUBLE) AS s2, count(reading) OVER n AS n
      FROM r WINDOW a AS (PARTITION BY device_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING),
                    n AS (PARTITION BY device_id ORDER BY ts, seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)),
d AS (SELECT *, sqrt(greatest(0.0::DOUBLE, s2 / n - average * 2.0::DOUBLE * (s1 / n) + average * average)) AS std_dev FROM s)
SELECT device_id, ts, seq, reading, round(average, 6) AS average, round(std_dev, 4) AS std_dev, 'HIGH' AS severity
FROM d WHERE abs(reading - average) > std_dev * 3.0::DOUBLE""",
)
def anomalies(spark, folder):
    readings = t.table(spark, folder, "events").select(
        F.col("user_id").alias("device_id"),
        t.millis("ts").alias("ts"),
        F.col("event_id").alias("seq"),
        R.cents(F.col("value")).alias("reading"),
    )
    return R.anomalies(readings).select(
        "device_id", "ts", "seq", "reading", F.round("average", 6).alias("average"),
        F.round("std_dev", 4).alias("std_dev"), "severity",
    )


#: The event types of the given table.
TRANSACTION_KINDS = ("view", "click", "purchase", "signup", "error")


@query(
    "balances",
    """WITH tx AS (SELECT user_id AS account_id, epoch_us(ts) // 1000 AS ts, event_id AS seq, event_type AS type,
       CAST(round(value * 100) AS BIGINT) * CASE WHEN event_type IN ('purchase', 'error') THEN -1 ELSE 1 END AS amount FROM events)
SELECT account_id, ts, seq, type, amount, CAST(sum(amount) OVER a - amount AS BIGINT) AS previous_balance,
       CAST(sum(amount) OVER a AS BIGINT) AS new_balance, count(*) OVER k AS type_count,
       sum(amount) OVER a < 0 AS overdraft, sum(amount) OVER a < -100000 AS fraud_alert
FROM tx WINDOW a AS (PARTITION BY account_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING),
               k AS (PARTITION BY account_id, type ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)""",
)
def balances(spark, folder):
    kind = F.col("event_type")
    tx = t.table(spark, folder, "events").select(
        F.col("user_id").alias("account_id"),
        t.millis("ts").alias("ts"),
        F.col("event_id").alias("seq"),
        kind.alias("type"),
        (R.cents(F.col("value")) * F.when(kind.isin("purchase", "error"), -1).otherwise(1)).alias("amount"),
    )
    return R.balances(tx, fraud_below=-100_000, kinds=TRANSACTION_KINDS)


@query(
    "last_visitors",
    "WITH " + t.EVENTS + """,
v AS (SELECT product_id, user_id, max((ts, event_id)) AS seen FROM tracked WHERE event_type = 'PRODUCT_VIEW' GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seen DESC) AS position FROM v)
SELECT product_id, user_id, CAST(position AS INT) AS position FROM r WHERE position <= 5""",
)
def last_visitors(spark, folder):
    views = t.events(spark, folder).where("event_type = 'PRODUCT_VIEW'")
    out = R.last_distinct(views, ["product_id"], "user_id", 5, ("ts", "event_id"))
    return out.select("product_id", "user_id", "position")


@query(
    "inventory_value",
    "WITH " + t.PRODUCT_UPDATES + f""",
ranked AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY {", ".join(c + " DESC" for c in t.LINE_ORDER)}) AS rn
           FROM product_updates)
SELECT p_type AS category, CAST(sum(inventory * CAST(round(price * 100) AS BIGINT)) AS BIGINT) AS value_cents, count(*) AS products
FROM ranked JOIN part ON p_partkey = product_id WHERE rn = 1 GROUP BY 1""",
)
def inventory_value(spark, folder):
    part = t.table(spark, folder, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"))
    products = t.product_updates(spark, folder).join(part, "product_id")
    return R.inventory_value(products, t.LINE_ORDER)


LEVELS = """levels AS (
  SELECT l_partkey % 200 AS product_id, l_suppkey % 3 AS site, epoch_ms(l_shipdate) AS ts, l_orderkey AS order_id,
         l_linenumber AS line_no, l_suppkey AS supplier_id, l_partkey AS part_id, l_extendedprice AS amount,
         CAST(l_quantity AS INT) // 5 AS inventory
  FROM lineitem)"""
LEVEL_ORDER = ("ts", "order_id", "line_no", "supplier_id", "part_id", "amount")
TOTALS = "WITH " + LEVELS + f""",
moved AS (SELECT *, inventory - coalesce(lag(inventory) OVER (PARTITION BY product_id, site ORDER BY {", ".join(LEVEL_ORDER)}), 0) AS delta
          FROM levels),
totals AS (SELECT *, CAST(sum(delta) OVER (PARTITION BY product_id ORDER BY {", ".join(LEVEL_ORDER)} ROWS UNBOUNDED PRECEDING) AS BIGINT)
                  AS total_inventory FROM moved)"""


def levels(spark, folder):
    return t.table(spark, folder, "lineitem").select(
        (F.col("l_partkey") % 200).alias("product_id"),
        (F.col("l_suppkey") % 3).alias("site"),
        t.millis("l_shipdate").alias("ts"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_extendedprice").alias("amount"),
        F.expr("CAST(l_quantity AS INT) DIV 5").cast("int").alias("inventory"),
    )


@query(
    "warehouse_totals",
    TOTALS + """ SELECT product_id, ts, order_id, line_no, part_id, site, inventory, total_inventory, total_inventory < 10 AS low_total
FROM totals""",
)
def warehouse_totals(spark, folder):
    out = R.warehouse_totals(levels(spark, folder), order=LEVEL_ORDER)
    return out.select("product_id", "ts", "order_id", "line_no", "part_id", "site", "inventory", "total_inventory", "low_total")


HORIZON = 1_104_537_600_000  # 2005-01-01, after the last ship date


@query(
    "reorder_due",
    TOTALS + f""",
f AS (SELECT *, total_inventory < 10 AS low, coalesce(lag(total_inventory < 10) OVER (PARTITION BY product_id ORDER BY {", ".join(LEVEL_ORDER)}), false) AS was
      FROM totals),
g AS (SELECT *, lead(ts) OVER (PARTITION BY product_id ORDER BY {", ".join(LEVEL_ORDER)}) AS nxt FROM f WHERE low <> was)
SELECT product_id, ts AS low_since, coalesce(nxt, {HORIZON}) AS low_until, ts + 7200000 AS reorder_at
FROM g WHERE low AND coalesce(nxt, {HORIZON}) - ts >= 7200000""",
)
def reorder_due(spark, folder):
    return R.reorder_due(levels(spark, folder), 2 * 3_600_000, HORIZON, order=LEVEL_ORDER)
