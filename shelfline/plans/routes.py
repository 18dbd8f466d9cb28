"""Side outputs and routing over the catalogue and order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions.records import parse_once
from shelfline.operators import ledger as L
from shelfline.operators import routing as R
from shelfline.operators.running import cents, running_global
from shelfline.plans import tables as t
from shelfline.plans import inventory  # noqa: F401  (its SQL is reused below)
from shelfline.schemas import TOPIC_INVENTORY_ALERTS, TOPIC_INVENTORY_EVENTS, TOPIC_UI_FANOUT
from shelfline.sinks.topics import ledger_messages
from shelfline.plans.registry import ORACLES, query


@query(
    "inventory_router",
    "WITH " + t.CATALOGUE + """,
c AS (SELECT product_id, name, inventory, price / 10.0::DOUBLE AS price, rating FROM catalogue),
d AS (SELECT *, price * 1.15::DOUBLE AS orig FROM c)
SELECT product_id, name, inventory, price, 'main' AS output, CAST(NULL AS INT) AS threshold, CAST(NULL AS DOUBLE) AS original_price,
       CAST(NULL AS DOUBLE) AS discount_percent FROM d
UNION ALL SELECT product_id, name, inventory, price, 'OUT_OF_STOCK', 0, NULL, NULL FROM d WHERE inventory = 0
UNION ALL SELECT product_id, name, inventory, price, 'LOW_STOCK', 10, NULL, NULL FROM d WHERE inventory <> 0 AND inventory < 10
UNION ALL SELECT product_id, name, inventory, price, 'PRICE_DROP', NULL, orig, (orig - price) / orig * 100
FROM d WHERE rating > 4.5 AND price < 100 AND (orig - price) / orig * 100 > 10""",
)
def inventory_router(spark, folder):
    products = t.catalogue(spark, folder).withColumn("price", F.col("price") / 10.0)
    out = R.inventory_routes(products.select("product_id", "name", "inventory", "price", "rating"))
    return out.drop("rating")


@query(
    "alert_union",
    "WITH " + t.CATALOGUE + """
SELECT product_id, 'OUT_OF_STOCK' AS alert_type FROM catalogue WHERE inventory = 0
UNION ALL SELECT product_id, 'LOW_STOCK' FROM catalogue WHERE inventory BETWEEN 1 AND 9""",
)
def alert_union(spark, folder):
    routed = R.inventory_routes(t.catalogue(spark, folder))
    return routed.where(F.col(R.OUTPUT).isin("OUT_OF_STOCK", "LOW_STOCK")).select("product_id", F.col(R.OUTPUT).alias("alert_type"))


@query(
    "error_split",
    """SELECT l_partkey AS product_id, l_orderkey AS order_id, l_linenumber AS line_no,
       CASE WHEN CAST(l_quantity AS INT) - 3 < 0 THEN 'INVALID_INVENTORY' WHEN l_extendedprice * l_discount <= 0 THEN 'INVALID_PRICE' END AS error_type,
       CASE WHEN CAST(l_quantity AS INT) - 3 < 0 THEN 'Inventory cannot be negative: ' || (CAST(l_quantity AS INT) - 3) END AS error_message
FROM lineitem""",
)
def error_split(spark, folder):
    rows = t.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        (F.col("l_quantity").cast("int") - 3).alias("inventory"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("price"),
    )
    message = F.when(F.col("error_type") == "INVALID_INVENTORY", F.col("error_message"))
    return R.split_errors(rows).select("product_id", "order_id", "line_no", "error_type", message.alias("error_message"))


@query(
    "high_value_metrics",
    """SELECT p_type AS category, count(*) AS high_value_count, CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS BIGINT) AS high_value_cents,
       CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS DOUBLE) / count(*) AS average_cents
FROM part WHERE p_retailprice > 950 GROUP BY 1""",
)
def high_value_metrics(spark, folder):
    return R.high_value_metrics(t.catalogue(spark, folder), 950, ("category",))


@query(
    "high_value_running",
    """WITH h AS (SELECT o_orderkey AS order_id, epoch_ms(o_orderdate) AS ts, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
           FROM orders WHERE o_totalprice > 250000)
SELECT order_id, ts, count(*) OVER w AS running_count, CAST(sum(cents) OVER w AS BIGINT) AS running_total,
       CAST(sum(cents) OVER w AS DOUBLE) / count(*) OVER w AS running_average
FROM h WINDOW w AS (ORDER BY ts, order_id ROWS UNBOUNDED PRECEDING)""",
)
def high_value_running(spark, folder):
    orders = t.table(spark, folder, "orders").where(F.col("o_totalprice") > 250_000).select(
        F.col("o_orderkey").alias("order_id"),
        t.millis("o_orderdate").alias("ts"),
        cents(F.col("o_totalprice")).alias("cents"),
    )
    day = F.floor(F.col("ts") / 86_400_000)
    return running_global(orders, "cents", ("ts", "order_id"), day).drop("cents")


CATEGORY_TAGS = {"ECONOMY": "category-economy", "STANDARD": "category-standard", "PROMO": "category-promo"}


@query(
    "category_routes",
    """SELECT p_partkey AS product_id, CASE p_type WHEN 'ECONOMY' THEN 'category-economy' WHEN 'STANDARD' THEN 'category-standard'
       WHEN 'PROMO' THEN 'category-promo' ELSE 'unknown' END AS output FROM part""",
)
def category_routes(spark, folder):
    return R.category_routes(t.catalogue(spark, folder), CATEGORY_TAGS).select("product_id", "output")


@query(
    "rule_routes",
    """WITH rules AS (SELECT o_orderpriority AS priority, max(o_totalprice) * 0.9::DOUBLE AS at_least FROM orders GROUP BY 1)
SELECT o_orderkey AS order_id, 'high-value ' || o_orderpriority AS output
FROM orders JOIN rules ON priority = o_orderpriority WHERE o_totalprice >= at_least""",
)
def rule_routes(spark, folder):
    """Rules come from the data: orders near the largest of their priority are routed on their own."""
    orders = t.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("total")
    )
    rules = orders.groupBy("priority").agg(
        (F.max("total") * 0.9).alias("at_least"), F.lit(None).cast("double").alias("below")
    ).withColumn("output", F.concat(F.lit("high-value "), "priority"))
    return R.rule_routes(orders, rules, "priority", "total").select("order_id", "output")


@query(
    "order_split",
    """SELECT o_orderkey AS order_id, 'main' AS output FROM orders WHERE o_totalprice > 0
UNION ALL SELECT o_orderkey, 'fraud' FROM orders WHERE o_totalprice > 450000 AND o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, 'high-value' FROM orders WHERE o_totalprice > 300000
UNION ALL SELECT o_orderkey, 'invalid' FROM orders WHERE o_totalprice <= 0""",
)
def order_split(spark, folder):
    orders = t.table(spark, folder, "orders")
    total = F.col("o_totalprice")
    return R.route(
        orders.select(F.col("o_orderkey").alias("order_id"), "o_totalprice", "o_orderstatus"),
        {
            "main": total > 0,
            "fraud": (total > 450_000) & (F.col("o_orderstatus") == "P"),
            "high-value": total > 300_000,
            "invalid": total <= 0,
        },
    ).select("order_id", "output")


@query(
    "ledger_fanout",
    f"""WITH e AS ({ORACLES["inventory_events"]}), a AS ({ORACLES["inventory_alerts"]})
SELECT 'inventory-events' AS topic, event_type AS kind, count(*) AS n FROM e GROUP BY 2
UNION ALL SELECT 'inventory-alerts', alert_type, count(*) FROM a GROUP BY 2""",
)
def ledger_fanout(spark, folder):
    """Events and alerts of one ledger pass, counted per sink."""
    outputs = L.ledger_outputs(L.ledger(t.ledger_rows(spark, folder), t.LINE_ORDER))
    kind = F.coalesce("event.event_type", "alert.alert_type").alias("kind")
    topic = F.when(F.col("event").isNotNull(), TOPIC_INVENTORY_EVENTS).otherwise(TOPIC_INVENTORY_ALERTS).alias("topic")
    return outputs.groupBy(topic, kind).agg(F.count("*").alias("n"))


@query(
    "topic_messages",
    f"""WITH e AS ({ORACLES["inventory_events"]}), a AS ({ORACLES["inventory_alerts"]})
SELECT CAST(product_id AS VARCHAR) AS key, 'inventory-events' AS topic, NULL AS wrapped, event_type AS kind, ts, current_inventory, current_inventory - previous_inventory AS change,
       event_type = 'OUT_OF_STOCK' AS critical, reason AS text FROM e
UNION ALL SELECT CAST(product_id AS VARCHAR), 'websocket_fanout', 'INVENTORY_UPDATE', event_type, ts, current_inventory, current_inventory - previous_inventory,
       event_type = 'OUT_OF_STOCK', reason FROM e
UNION ALL SELECT CAST(product_id AS VARCHAR), 'inventory-alerts', NULL, alert_type, ts, NULL, NULL, NULL, message FROM a""",
)
def topic_messages(spark, folder):
    """All messages of one ledger pass, read back field by field."""
    sent = ledger_messages(L.ledger_outputs(L.ledger(t.ledger_rows(spark, folder), t.LINE_ORDER)))
    wrapped = F.col("topic") == TOPIC_UI_FANOUT
    fields = "eventType string, alertType string, timestamp bigint, currentInventory int, inventoryChange int, critical boolean, changeReason string, message string"
    whole = F.from_json("value", f"{fields}, payload struct<{fields.replace(' ', ':').replace(',:', ', ')}>")
    read = parse_once(sent, "_whole", whole)
    read = read.select("key", "topic", wrapped.alias("_ui"), F.when(wrapped, F.col("_whole.eventType")).alias("wrapped"), "_whole")
    of = lambda name: F.when(F.col("_ui"), F.col(f"_whole.payload.{name}")).otherwise(F.col(f"_whole.{name}"))
    return read.select(
        "key", "topic", "wrapped", F.coalesce(of("eventType"), of("alertType")).alias("kind"), of("timestamp").alias("ts"),
        of("currentInventory").alias("current_inventory"), of("inventoryChange").alias("change"), of("critical").alias("critical"),
        F.coalesce(of("changeReason"), of("message")).alias("text"),
    )
