"""Parsers and validators over JSON text that Spark writes from the given tables.

Which rows get which defect is a function of the row, and every row takes part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions import records as R
from shelfline.plans import tables as t
from shelfline.plans.registry import query


def product_texts(spark, folder):
    """One text per part: an object, an array of two, or one with a defect."""
    key = F.col("p_partkey")
    text = F.to_json(
        F.struct(
            F.concat(F.lit("P"), key.cast("string")).alias("productId"),
            F.col("p_name").alias("name"),
            F.col("p_retailprice").alias("price"),
            F.col("p_type").alias("category"),
            F.col("p_size").alias("inventory"),
            F.array("p_brand").alias("tags"),
        )
    )
    second = F.to_json(
        F.struct(F.concat(F.lit("Q"), key.cast("string")).alias("productId"), F.col("p_size").cast("string").alias("inventory"))
    )
    case = key % 11
    value = (
        F.when(case == 0, F.concat(F.lit("["), text, F.lit(",null,"), second, F.lit("]")))
        .when(case == 1, F.concat(F.lit("["), text, F.lit(",{\"productId\":\"x\",\"extra\":1}]")))
        .when(case == 2, F.lit("  "))
        .when(case == 3, F.col("p_name"))
        .when(case == 4, F.regexp_replace(text, '"inventory":', '"stock":'))
        .when(case == 5, F.concat(F.lit(" "), text, F.lit("\n")))
        .when(case == 7, F.regexp_replace(text, r'"tags":\[.*\]', '"tags":"x"'))
        .when(case == 8, F.regexp_replace(text, '"productId":"P[0-9]+"', '"productId":{"a":1}'))
        .when(case == 9, F.to_json(F.array(text)))
        .when(case == 10, F.regexp_replace(text, '"tags":', '"tags":[[1]],"tags2":'))
        .otherwise(text)
    )
    return t.table(spark, folder, "part").select(value.alias("value"))


@query(
    "product_parser",
    """SELECT 'P' || p_partkey AS product_id, p_name AS name, p_retailprice AS price, p_size AS inventory, p_brand AS tag
FROM part WHERE p_partkey % 11 IN (0, 5, 6)
UNION ALL SELECT 'Q' || p_partkey, NULL, 0.0::DOUBLE, p_size, NULL FROM part WHERE p_partkey % 11 = 0""",
)
def product_parser(spark, folder):
    valid = R.parse_products(product_texts(spark, folder)).valid
    return valid.select(
        F.col("productId").alias("product_id"), "name", "price", "inventory", F.element_at("tags", 1).alias("tag")
    )


@query(
    "product_dead_letters",
    """SELECT CASE p_partkey % 11 WHEN 3 THEN 'not JSON' ELSE 'unknown field or unreadable value' END AS reject_reason, count(*) AS n
FROM part WHERE p_partkey % 11 NOT IN (0, 2, 5, 6) GROUP BY 1""",
)
def product_dead_letters(spark, folder):
    dead = R.parse_products(product_texts(spark, folder)).dead
    return dead.groupBy("reject_reason").agg(F.count("*").alias("n"))


def order_texts(spark, folder):
    line, qty = F.col("l_linenumber"), F.col("l_quantity").cast("int").cast("string")
    key, part = F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")
    body = lambda order, product, quantity: F.concat(
        F.lit('{"orderId":'), order, F.lit(',"productId":'), product, F.lit(',"quantity":'), quantity,
        F.lit(',"timestamp":'), t.millis("l_shipdate").cast("string"), F.lit("}"),
    )
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    value = (
        F.when(line == 1, body(quoted(key), quoted(part), qty))
        .when(line == 2, body(quoted(key), quoted(part), quoted(qty)))
        .when(line == 3, body(quoted(key), part, F.concat(qty, F.lit(".7"))))
        .when(line == 4, body(quoted(key), quoted(part), F.lit("0")))
        .when(line == 5, body(F.lit("null"), quoted(part), qty))
        .when(line == 6, body(F.lit('""'), quoted(part), qty))
        .otherwise(F.concat(F.lit("line "), key))
    )
    return t.table(spark, folder, "lineitem").select(value.alias("value"))


@query(
    "order_item_parser",
    """SELECT CASE l_linenumber WHEN 5 THEN 'null' ELSE CAST(l_orderkey AS VARCHAR) END AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_quantity AS INT) AS quantity, epoch_ms(l_shipdate) AS ts
FROM lineitem WHERE l_linenumber IN (1, 2, 3, 5)""",
)
def order_item_parser(spark, folder):
    return R.parse_order_items(order_texts(spark, folder)).valid.select(
        F.col("orderId").alias("order_id"), F.col("productId").alias("product_id"), "quantity", F.col("timestamp").alias("ts")
    )


@query(
    "order_item_dead_letters",
    """SELECT CASE l_linenumber WHEN 4 THEN 'quantity not positive' WHEN 6 THEN 'no orderId' ELSE 'malformed JSON' END AS reject_reason,
       count(*) AS n FROM lineitem WHERE l_linenumber NOT IN (1, 2, 3, 5) GROUP BY 1""",
)
def order_item_dead_letters(spark, folder):
    dead = R.parse_order_items(order_texts(spark, folder)).dead
    return dead.groupBy("reject_reason").agg(F.count("*").alias("n"))


def change_texts(spark, folder):
    line = F.col("l_linenumber")
    return t.table(spark, folder, "lineitem").select(
        F.to_json(
            F.struct(
                F.when(line == 2, "u").when(line == 3, "d").otherwise("c").alias("op"),
                t.millis("l_shipdate").alias("ts_ms"),
                F.struct(F.when(line == 4, "orders").otherwise("order_items").alias("table")).alias("source"),
                F.when(
                    line != 5,
                    F.struct(
                        (F.col("l_orderkey") * 8 + line).alias("order_item_id"),
                        F.col("l_orderkey").cast("string").alias("order_id"),
                        F.col("l_partkey").cast("string").alias("product_id"),
                        F.col("l_quantity").cast("int").alias("quantity"),
                    ),
                ).alias("after"),
            )
        ).alias("value")
    )


@query(
    "cdc_order_items",
    """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS INT) AS quantity,
       epoch_ms(l_shipdate) AS ts, l_orderkey * 8 + l_linenumber AS order_item_id
FROM lineitem WHERE l_linenumber NOT IN (2, 3, 4, 5)""",
)
def cdc_order_items(spark, folder):
    return R.cdc_order_items(change_texts(spark, folder)).select(
        F.col("orderId").alias("order_id"), F.col("productId").alias("product_id"), "quantity",
        F.col("timestamp").alias("ts"), "order_item_id",
    )


@query(
    "cdc_orders",
    "SELECT CAST(l_orderkey AS VARCHAR) AS order_id, 'ORDER_PLACED' AS event_type, epoch_ms(l_shipdate) AS ts FROM lineitem WHERE l_linenumber = 4",
)
def cdc_orders(spark, folder):
    return R.cdc_orders(change_texts(spark, folder)).select(
        F.col("orderId").alias("order_id"), F.col("eventType").alias("event_type"), F.col("timestamp").alias("ts")
    )


def raw_events(spark, folder):
    """Ledger-like events straight from order lines, some of which break the rules."""
    line = F.col("l_linenumber")
    units = F.col("l_quantity").cast("int")
    return t.table(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("productId"),
        F.when(line != 2, F.concat(F.lit("part-"), F.col("l_partkey").cast("string"))).otherwise(" ").alias("productName"),
        F.when(F.col("l_returnflag") == "R", "OUT_OF_STOCK")
        .when(F.col("l_returnflag") == "A", "PRICE_CHANGED")
        .otherwise("LOW_STOCK_ALERT")
        .alias("eventType"),
        units.alias("previousInventory"),
        (units - 25).alias("currentInventory"),
        F.col("l_extendedprice").alias("previousPrice"),
        F.when(line != 3, F.col("l_extendedprice") * 0.5).alias("currentPrice"),
        F.when(line == 4, 0).otherwise(t.millis("l_shipdate")).cast("long").alias("timestamp"),
        F.when(line == 5, "critical").alias("alertLevel"),
    )


@query(
    "event_validation",
    """WITH e AS (SELECT *, CASE l_returnflag WHEN 'R' THEN 'OUT_OF_STOCK' WHEN 'A' THEN 'PRICE_CHANGED' ELSE 'LOW_STOCK_ALERT' END AS event_type,
       CAST(l_quantity AS INT) - 25 AS cur FROM lineitem)
SELECT event_type, CAST(l_linenumber = 2 AS INT) + CAST(l_linenumber = 4 AS INT) + CAST(cur < 0 AS INT)
         + CAST(event_type = 'PRICE_CHANGED' AND l_linenumber = 3 AS INT) + CAST(event_type = 'OUT_OF_STOCK' AND cur > 0 AS INT) AS violations,
       CASE WHEN l_linenumber = 5 THEN 'critical' WHEN event_type = 'LOW_STOCK_ALERT' THEN 'WARNING' END AS alert_level,
       l_linenumber = 5 OR event_type = 'OUT_OF_STOCK' AS critical, count(*) AS n, CAST(sum(cur - CAST(l_quantity AS INT)) AS BIGINT) AS moved
FROM e GROUP BY ALL""",
)
def event_validation(spark, folder):
    checked = R.derived_fields(R.validate_events(raw_events(spark, folder)))
    return checked.groupBy(
        F.col("eventType").alias("event_type"), F.size("violations").alias("violations"),
        F.col("alertLevel").alias("alert_level"), "critical",
    ).agg(F.count("*").alias("n"), F.sum("inventoryChange").alias("moved"))


@query(
    "alert_validation",
    """SELECT coalesce(CASE WHEN c_nationkey % 3 = 0 THEN 'INFO' END, 'MEDIUM') AS severity,
       CAST(c_custkey % 5 = 0 AS INT) + CAST(c_acctbal <= 0 AS INT) AS violations, count(*) AS n FROM customer GROUP BY ALL""",
)
def alert_validation(spark, folder):
    alerts = t.table(spark, folder, "customer").select(
        F.lit("LOW_STOCK").alias("alertType"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).otherwise("").alias("productId"),
        F.col("c_name").alias("message"),
        F.when(F.col("c_nationkey") % 3 == 0, "INFO").alias("severity"),
        F.ceil("c_acctbal").alias("timestamp"),
    )
    alerts = alerts.withColumn("timestamp", F.when(F.col("timestamp") > 0, F.col("timestamp")))
    out = R.validate_alerts(alerts)
    return out.groupBy("severity", F.size("violations").alias("violations")).agg(F.count("*").alias("n"))


@query(
    "tracked_event_types",
    """SELECT CASE event_type WHEN 'view' THEN 'PRODUCT_VIEW' WHEN 'click' THEN 'RECOMMENDATION_CLICKED' WHEN 'purchase' THEN 'ORDER_PLACED'
         WHEN 'signup' THEN 'USER_LOGIN' ELSE 'rejected: unknown event type' END AS outcome, count(*) AS n, count(DISTINCT user_id) AS users
FROM events GROUP BY 1""",
)
def tracked_event_types(spark, folder):
    kind = F.col("event_type")
    texts = t.table(spark, folder, "events").select(
        F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("eventId"),
                F.col("user_id").cast("string").alias("userId"),
                F.when(kind == "view", "PRODUCT_VIEW").when(kind == "click", "RECOMMENDATION_CLICKED")
                .when(kind == "purchase", "ORDER_PLACED").when(kind == "signup", "USER_LOGIN")
                .otherwise("SORT_CHANGE").alias("eventType"),
                t.millis("ts").alias("timestamp"),
                "value",
            )
        ).alias("value")
    )
    tagged = R.parse_tracked(texts).tagged
    outcome = F.coalesce(F.concat(F.lit("rejected: "), "reject_reason"), F.col("eventType"))
    return tagged.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"), F.count_distinct("userId").alias("users"))


@query(
    "envelopes",
    """SELECT sha2.id AS uuid, ts AS timestamp, CAST(user_id % 7 AS VARCHAR) AS key, CAST(user_id AS VARCHAR) AS to_user,
       'ECOMMERCE_EVENT' AS event_type, event_id, product_id
FROM (SELECT event_id, user_id, epoch_us(ts) // 1000 AS ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id FROM events) e,
     LATERAL (SELECT sha256(e.user_id || '|' || e.event_id) AS id) sha2""",
)
def envelopes(spark, folder):
    e = t.events(spark, folder)
    out = R.envelope(
        e, "ECOMMERCE_EVENT", F.struct("event_id", "product_id"), F.col("user_id") % 7, F.col("user_id"), F.col("ts"),
        R.record_id("user_id", "event_id"),
    )
    return out.select(
        "uuid", "timestamp", "key", F.col("toUserId").alias("to_user"), F.col("eventType").alias("event_type"),
        F.get_json_object("payload", "$.event_id").cast("long").alias("event_id"),
        F.get_json_object("payload", "$.product_id").cast("long").alias("product_id"),
    )


@query(
    "topic_inspection",
    """WITH m AS (SELECT 'orders' AS topic, l_partkey AS p FROM lineitem UNION ALL SELECT 'products', p_partkey FROM part)
SELECT topic, count(*) AS n FROM m WHERE p = 42 GROUP BY 1""",
)
def topic_inspection(spark, folder):
    orders = t.table(spark, folder, "lineitem").select(
        F.to_json(F.struct(F.col("l_partkey").cast("string").alias("productId"), "l_orderkey")).alias("value")
    )
    products = t.table(spark, folder, "part").select(
        F.to_json(F.struct(F.col("p_partkey").cast("string").alias("productId"), "p_name")).alias("value")
    )
    out = R.inspect_topics({"orders": orders, "products": products}, "42")
    return out.groupBy("topic").agg(F.count("*").alias("n"))


@query(
    "assistant_messages",
    """SELECT CAST(conv_id AS VARCHAR) AS session_id, CASE WHEN role = 'system' THEN 'INIT' ELSE 'USER_MESSAGE' END AS type,
       CASE WHEN role <> 'system' THEN text END AS text, turn AS ts
FROM conversations WHERE role = 'system' OR (role = 'user' AND trim(text) <> '')""",
)
def assistant_messages(spark, folder):
    turns = t.table(spark, folder, "conversations").where(F.col("role") != "assistant")
    none = F.lit(None).cast("string")
    rows = turns.select(
        F.col("conv_id").cast("string").alias("session_id"),
        F.col("role").alias("user_id"),
        F.when(F.col("role") != "system", F.col("text")).alias("text"),
        none.alias("basket"), none.alias("product"), none.alias("context"),
        F.col("turn").alias("timestamp"),
    )
    return R.assistant_messages(rows).select(
        F.col("sessionId").alias("session_id"), "type", "text", F.col("timestamp").alias("ts")
    )


@query(
    "assistant_responses",
    """SELECT sha256(conv_id || '/' || turn) AS message_id, CAST(conv_id AS VARCHAR) AS session_id, text, turn AS ts
FROM conversations WHERE role = 'assistant'""",
)
def assistant_responses(spark, folder):
    turns = t.table(spark, folder, "conversations").where(F.col("role") == "assistant")
    texts = turns.select(
        F.to_json(
            F.struct(
                F.sha2(F.concat_ws("/", "conv_id", "turn"), 256).alias("messageId"),
                F.col("conv_id").cast("string").alias("sessionId"),
                "text",
                F.col("turn").alias("timestamp"),
            )
        ).alias("value")
    )
    return R.assistant_responses(texts, F.lit(0).cast("long")).select(
        F.col("messageId").alias("message_id"), F.col("sessionId").alias("session_id"), "text", F.col("timestamp").alias("ts")
    )


@query(
    "geo_features",
    "SELECT c_custkey AS id, c_acctbal / 100.0::DOUBLE AS latitude, CAST(c_nationkey AS DOUBLE) AS longitude FROM customer",
)
def geo_features(spark, folder):
    """Feature lines from customers: balance as latitude, nation as longitude."""
    lines = t.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat(
            F.to_json(
                F.struct(
                    F.lit("Feature").alias("type"),
                    F.struct(
                        F.array(F.col("c_nationkey").cast("double"), F.col("c_acctbal") / 100.0).alias("coordinates")
                    ).alias("geometry"),
                )
            ),
            F.lit(","),
        ).alias("value"),
    )
    return R.geo_features(lines)


@query(
    "catalogue_load",
    """SELECT 'P' || p_partkey AS product_id, 'products' AS table_name, p_name AS name, CAST(NULL AS INT) AS on_hand, CAST(NULL AS INT) AS available,
       CAST(NULL AS INT) AS reorder_point FROM part WHERE p_partkey % 11 IN (0, 5, 6)
UNION ALL SELECT 'P' || p_partkey, 'inventory', NULL, p_size, p_size, 10 FROM part WHERE p_partkey % 11 IN (0, 5, 6)
UNION ALL SELECT 'Q' || p_partkey, 'products', NULL, NULL, NULL, NULL FROM part WHERE p_partkey % 11 = 0
UNION ALL SELECT 'Q' || p_partkey, 'inventory', NULL, p_size, p_size, 10 FROM part WHERE p_partkey % 11 = 0""",
)
def catalogue_load(spark, folder):
    from shelfline.sinks.relational import catalogue_load_rows

    rows = catalogue_load_rows(R.parse_products(product_texts(spark, folder)).valid)
    return rows.select("product_id", "table_name", "name", "on_hand", "available", "reorder_point")


@query(
    "dispatched_envelopes",
    """SELECT CASE WHEN event_id % 50 = 0 THEN 'unknown event type' WHEN event_id % 51 = 0 THEN 'no event type' END AS reject_reason,
       CASE WHEN event_id % 50 = 0 THEN 'OTHER' WHEN event_id % 51 = 0 THEN NULL WHEN event_type = 'purchase' THEN 'SHOPPING_CART' ELSE 'ECOMMERCE_EVENT' END AS event_type,
       count(*) AS n FROM events GROUP BY ALL""",
)
def dispatched_envelopes(spark, folder):
    kind = (
        F.when(F.col("event_id") % 50 == 0, "OTHER").when(F.col("event_id") % 51 == 0, F.lit(None).cast("string"))
        .when(F.col("event_type") == "purchase", "SHOPPING_CART").otherwise("ECOMMERCE_EVENT")
    )
    texts = t.table(spark, folder, "events").select(
        F.to_json(F.struct(kind.alias("eventType"), F.struct("event_id", "value").alias("payload"))).alias("value")
    )
    return R.by_envelope_type(texts).groupBy("reject_reason", F.col("eventType").alias("event_type")).agg(F.count("*").alias("n"))


@query(
    "enriched_tracking",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 3 = 0 THEN 'session-' || user_id ELSE 's' || event_id END AS session_id,
       CAST(user_id AS VARCHAR) AS user_id, CASE WHEN event_id % 2 = 0 THEN 0 ELSE epoch_us(ts) // 1000 END AS ts,
       'web' AS channel, CASE WHEN event_id % 5 = 0 THEN 'own' ELSE 'default' END AS campaign FROM events""",
)
def enriched_tracking(spark, folder):
    key, user = F.col("event_id"), F.col("user_id").cast("string")
    rows = t.table(spark, folder, "events").select(
        key.cast("string").alias("eventId"),
        F.when(key % 3 != 0, F.concat(F.lit("s"), key.cast("string"))).alias("sessionId"),
        F.when(key % 4 != 0, user).alias("userId"),
        F.when(key % 2 != 0, t.millis("ts")).alias("timestamp"),
        "event_type",
        F.when(key % 5 == 0, F.create_map(F.lit("campaign"), F.lit("own"))).alias("metadata"),
        user.alias("known_user"),
    ).withColumnRenamed("event_type", "eventType").withColumn("productId", F.lit(None).cast("string"))
    out = R.enrich_tracked(
        rows, F.concat(F.lit("session-"), F.col("known_user")), F.col("known_user"), F.lit(0).cast("long"),
        {"channel": F.lit("web"), "campaign": F.lit("default")},
    )
    return out.select(
        F.col("eventId").alias("event_id"), F.col("sessionId").alias("session_id"), F.col("userId").alias("user_id"),
        F.col("timestamp").alias("ts"), F.col("metadata")["channel"].alias("channel"), F.col("metadata")["campaign"].alias("campaign"),
    )


@query(
    "deduplicated_orders",
    """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS line_id, CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(max(CAST(l_quantity AS INT)) AS INT) AS quantity, CAST(count(*) AS BIGINT) + count(CASE WHEN l_linenumber % 2 = 0 THEN 1 END) AS deliveries
FROM lineitem GROUP BY ALL""",
)
def deduplicated_orders(spark, folder):
    """Order lines that arrive directly, and every second one by change capture too; each is deducted once."""
    from shelfline.operators.changes import once

    lines = t.table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line_id"),
        F.col("l_partkey").cast("string").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"), "l_linenumber",
    )
    copies = F.when(F.col("l_linenumber") % 2 == 0, F.array(F.lit("direct"), F.lit("cdc"))).otherwise(F.array(F.lit("direct")))
    delivered = lines.withColumn("path", F.explode(copies)).drop("l_linenumber")
    return once(delivered, ["line_id", "product_id"], ["quantity", "path"]).drop("path")
