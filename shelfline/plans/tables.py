"""The given tables as shop entities: the same mapping as DataFrames and as SQL text.

Catalogue updates and order items are the rows of `lineitem` (returned lines set the stock, the
others order from it), the catalogue is `part`, tracked events and cart actions are `events`, chat
is `conversations`. Each mapping is a projection of a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_ORDER = ("ts", "order_id", "line_no", "supplier_id", "amount")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def millis(col: str):
    return F.unix_millis(F.col(col).cast("timestamp"))


# ---- lineitem: catalogue updates and order items -------------------------------------------------


def ledger_rows(spark: SparkSession, folder: str) -> DataFrame:
    return as_ledger_rows(table(spark, folder, "lineitem"))


def as_ledger_rows(lines: DataFrame) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    units = F.col("l_quantity").cast("int")
    return lines.select(
        F.col("l_partkey").alias("product_id"),
        millis("l_shipdate").alias("ts"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_extendedprice").alias("amount"),
        F.when(returned, "PRODUCT").otherwise("ORDER").alias("kind"),
        F.when(returned, 0).otherwise(units).alias("qty"),
        F.when(returned, units).alias("inventory"),
        F.when(returned, F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.when(returned, F.concat(F.lit("part-"), F.col("l_partkey").cast("string"))).alias("name"),
    )


LEDGER_ROWS = """ledger_rows AS (
  SELECT l_partkey AS product_id, epoch_ms(l_shipdate) AS ts, l_orderkey AS order_id,
         l_linenumber AS line_no, l_suppkey AS supplier_id, l_extendedprice AS amount,
         CASE WHEN l_returnflag = 'R' THEN 'PRODUCT' ELSE 'ORDER' END AS kind,
         CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS INT) END AS qty,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INT) END AS inventory,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice / l_quantity END AS price,
         'part-' || l_partkey AS name
  FROM lineitem)"""


def product_updates(spark: SparkSession, folder: str) -> DataFrame:
    return (
        ledger_rows(spark, folder)
        .where(F.col("kind") == "PRODUCT")
        .select("product_id", *LINE_ORDER, "inventory", "price", "name")
    )


PRODUCT_UPDATES = LEDGER_ROWS + """,
product_updates AS (SELECT * FROM ledger_rows WHERE kind = 'PRODUCT')"""


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return (
        ledger_rows(spark, folder)
        .where(F.col("kind") == "ORDER")
        .select("product_id", *LINE_ORDER, "qty")
    )


ORDER_ITEMS = LEDGER_ROWS + """,
order_items AS (SELECT product_id, ts, order_id, line_no, supplier_id, amount, qty
                FROM ledger_rows WHERE kind = 'ORDER')"""

BY_LINE = "ts, order_id, line_no, supplier_id, amount"


# ---- part: the catalogue -------------------------------------------------------------------------


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        key.alias("product_id"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_brand", "p_name").alias("description"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        (F.col("p_size") - 1).alias("inventory"),
        F.array(F.lower("p_type"), F.lower("p_brand")).alias("tags"),
        ((key % 41) / F.lit(10.0) + F.lit(1.0)).alias("rating"),
        (key * 7919 % 1000).cast("int").alias("review_count"),
    )


CATALOGUE = """catalogue AS (
  SELECT p_partkey AS product_id, p_name AS name, p_brand || ' ' || p_name AS description,
         p_retailprice AS price, p_type AS category, p_brand AS brand, p_size - 1 AS inventory,
         [lower(p_type), lower(p_brand)] AS tags,
         CAST(p_partkey % 41 AS DOUBLE) / 10.0::DOUBLE + 1.0::DOUBLE AS rating,
         CAST(p_partkey * 7919 % 1000 AS INT) AS review_count
  FROM part)"""


# ---- events: tracked events, cart actions, sessions ----------------------------------------------


def events(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id",
        millis("ts").alias("ts"),
        "user_id",
        F.when(kind == "view", "PRODUCT_VIEW")
        .when(kind == "click", "RECOMMENDATION_CLICKED")
        .when(kind == "purchase", "ORDER_PLACED")
        .when(kind == "signup", "CATEGORY_BROWSE")
        .otherwise(F.upper(kind))
        .alias("event_type"),
        F.get_json_object("props", "$.k").cast("long").alias("product_id"),
        "value",
    )


EVENTS = """tracked AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ts, user_id,
         CASE event_type WHEN 'view' THEN 'PRODUCT_VIEW' WHEN 'click' THEN 'RECOMMENDATION_CLICKED'
              WHEN 'purchase' THEN 'ORDER_PLACED' WHEN 'signup' THEN 'CATEGORY_BROWSE'
              ELSE upper(event_type) END AS event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, value
  FROM events)"""


def cart_actions(spark: SparkSession, folder: str) -> DataFrame:
    """Views and clicks add, signups change a quantity, errors remove, every 20th purchase clears."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("user_id").alias("cart_id"),
        millis("ts").alias("ts"),
        F.col("event_id").alias("seq"),
        F.when(kind.isin("view", "click"), "ADD")
        .when(kind == "signup", "UPDATE_QUANTITY")
        .when(kind == "error", "REMOVE")
        .when(F.col("event_id") % 20 == 0, "CLEAR")
        .otherwise("ADD")
        .alias("action"),
        (F.get_json_object("props", "$.k").cast("long") % 10).alias("product_id"),
        (F.col("event_id") % 5 + 1).cast("int").alias("quantity"),
        F.round(F.col("value") * 100).cast("long").alias("price_cents"),
    )


CART_ACTIONS = """cart_actions AS (
  SELECT user_id AS cart_id, epoch_us(ts) // 1000 AS ts, event_id AS seq,
         CASE WHEN event_type IN ('view', 'click') THEN 'ADD' WHEN event_type = 'signup' THEN 'UPDATE_QUANTITY'
              WHEN event_type = 'error' THEN 'REMOVE' WHEN event_id % 20 = 0 THEN 'CLEAR' ELSE 'ADD' END AS action,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS product_id,
         CAST(event_id % 5 + 1 AS INT) AS quantity, CAST(round(value * 100) AS BIGINT) AS price_cents
  FROM events)"""


# ---- conversations: chat -------------------------------------------------------------------------


def chat(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as messages: each room's turns go to its own user, every third one to the whole room."""
    conv, turn = F.col("conv_id"), F.col("turn")
    return table(spark, folder, "conversations").select(
        F.concat_ws("-", conv, turn).alias("id"),
        conv.alias("room"),
        turn.alias("seq"),
        F.concat_ws("-", "role", conv % 25).alias("user_id"),
        F.when(F.col("role") == "system", "USER_JOINED").otherwise("CHAT_MESSAGE").alias("type"),
        F.when(turn % 3 != 0, F.concat_ws("-", F.lit("user"), (conv + turn) % 25)).alias("to_user"),
        F.col("text").alias("message"),
    )


CHAT = """chat AS (
  SELECT conv_id || '-' || turn AS id, conv_id AS room, turn AS seq, role || '-' || conv_id % 25 AS user_id,
         CASE WHEN role = 'system' THEN 'USER_JOINED' ELSE 'CHAT_MESSAGE' END AS type,
         CASE WHEN turn % 3 <> 0 THEN 'user-' || (conv_id + turn) % 25 END AS to_user, text AS message
  FROM conversations)"""
