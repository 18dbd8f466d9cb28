"""Chat delivery, languages, buffers and fan-out targets over the conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import chat as C
from shelfline.operators.keyed import last_n
from shelfline.plans import tables as t
from shelfline.plans.registry import query
from shelfline.schemas import CHAT_BUFFER

DELIVERY = "WITH " + t.CHAT + """,
online AS (SELECT DISTINCT user_id FROM chat WHERE type = 'CHAT_MESSAGE'),
prefs AS (SELECT DISTINCT user_id, CASE WHEN room % 25 % 3 = 0 THEN 'DE' WHEN room % 25 % 3 = 1 THEN 'FR' ELSE 'DEFAULT' END AS language FROM chat)"""


def messages(spark, folder):
    chat = t.chat(spark, folder)
    german = F.create_map(F.lit("DE"), F.concat(F.lit("de: "), "message"))
    return chat.withColumn("event_type", F.lit("CHAT_MESSAGE")).withColumn("translations", german)


def online(spark, folder):
    return t.chat(spark, folder).where("type = 'CHAT_MESSAGE'").select("user_id").distinct()


def preferences(spark, folder):
    group = F.col("room") % 25 % 3
    language = F.when(group == 0, "DE").when(group == 1, "FR").otherwise("DEFAULT")
    return t.chat(spark, folder).select("user_id", language.alias("language")).distinct()


@query(
    "chat_audience",
    DELIVERY + """
SELECT id, CAST(NULL AS VARCHAR) AS recipient FROM chat WHERE to_user IS NULL
UNION ALL SELECT id, to_user FROM chat WHERE to_user IN (SELECT user_id FROM online)
UNION ALL SELECT id, user_id FROM chat WHERE to_user IS NOT NULL AND to_user <> user_id AND user_id IN (SELECT user_id FROM online)""",
)
def chat_audience(spark, folder):
    return C.audience(messages(spark, folder), online(spark, folder)).select("id", "recipient")


@query(
    "chat_delivery",
    DELIVERY + """,
aud AS (SELECT id, type, message, CAST(NULL AS VARCHAR) AS recipient FROM chat WHERE to_user IS NULL
  UNION ALL SELECT id, type, message, to_user FROM chat WHERE to_user IN (SELECT user_id FROM online)
  UNION ALL SELECT id, type, message, user_id FROM chat WHERE to_user IS NOT NULL AND to_user <> user_id AND user_id IN (SELECT user_id FROM online)),
lang AS (SELECT a.*, coalesce(p.language, 'DEFAULT') AS language FROM aud a LEFT JOIN prefs p ON p.user_id = a.recipient WHERE recipient IS NOT NULL
  UNION ALL SELECT *, 'DEFAULT' FROM aud WHERE recipient IS NULL
  UNION ALL SELECT *, 'DE' FROM aud WHERE recipient IS NULL AND type = 'CHAT_MESSAGE')
SELECT id, recipient, language, type = 'CHAT_MESSAGE' AND language = 'DE' AS translated,
       CASE WHEN type = 'CHAT_MESSAGE' AND language = 'DE' THEN 'de: ' || message ELSE message END AS message FROM lang""",
)
def chat_delivery(spark, folder):
    out = C.deliver(messages(spark, folder), online(spark, folder), preferences(spark, folder))
    return out.select("id", "recipient", "language", "translated", "message")


@query(
    "chat_buffer",
    f"""WITH {t.CHAT} SELECT room, id, CAST(row_number() OVER (PARTITION BY room ORDER BY seq DESC) AS INT) AS position
FROM chat WHERE type = 'CHAT_MESSAGE' QUALIFY position <= {CHAT_BUFFER}""",
)
def chat_buffer(spark, folder):
    chat = t.chat(spark, folder).where("type = 'CHAT_MESSAGE'")
    return last_n(chat, ["room"], ["seq"], CHAT_BUFFER).select("room", "id", "position")


@query(
    "point_buffer",
    "SELECT event_id, epoch_us(ts) // 1000 AS ts, value FROM events ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC LIMIT 150",
)
def point_buffer(spark, folder):
    points = t.table(spark, folder, "events").select("event_id", t.millis("ts").alias("ts"), "value")
    return points.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(150)


FANOUT = """fan AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'RECOMMENDATION' WHEN 'purchase' THEN 'SHOPPING_CART' WHEN 'view' THEN 'PRODUCT_UPDATE'
       ELSE 'ONLINE_USERS' END AS event_type, CAST(user_id AS VARCHAR) AS to_user, CAST(user_id AS VARCHAR) AS key FROM events)"""


def fanout(spark, folder):
    kind = F.col("event_type")
    return t.table(spark, folder, "events").select(
        "event_id",
        F.when(kind == "click", "RECOMMENDATION").when(kind == "purchase", "SHOPPING_CART").when(kind == "view", "PRODUCT_UPDATE")
        .otherwise("ONLINE_USERS").alias("event_type"),
        F.col("user_id").cast("string").alias("to_user"),
        F.col("user_id").cast("string").alias("key"),
    )


def connections(spark, folder):
    key = F.col("c_custkey")
    return t.table(spark, folder, "customer").select(
        F.concat(F.lit("conn-"), key.cast("string")).alias("connection_id"),
        key.cast("string").alias("user_id"),
        key.cast("string").alias("session_id"),
    )


@query(
    "event_fanout",
    "WITH " + FANOUT + """,
c AS (SELECT 'conn-' || c_custkey AS connection_id, CAST(c_custkey AS VARCHAR) AS user_id, CAST(c_custkey AS VARCHAR) AS session_id FROM customer)
SELECT event_id, 'user' AS target, connection_id FROM fan JOIN c ON c.user_id = to_user WHERE event_type = 'RECOMMENDATION'
UNION ALL SELECT event_id, 'session', connection_id FROM fan JOIN c ON c.session_id = key WHERE event_type = 'SHOPPING_CART'
UNION ALL SELECT event_id, 'all', NULL FROM fan WHERE event_type = 'PRODUCT_UPDATE'""",
)
def event_fanout(spark, folder):
    targeted = C.event_targets(fanout(spark, folder))
    return C.to_connections(targeted, connections(spark, folder)).select("event_id", "target", "connection_id")


@query(
    "recommendation_routing",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN 'user' WHEN event_type = 'click' THEN 'session' ELSE 'all' END AS target,
       CASE WHEN event_type = 'view' THEN 'u' || user_id WHEN event_type = 'click' THEN 's' || user_id END AS target_id FROM events""",
)
def recommendation_routing(spark, folder):
    user = F.col("user_id").cast("string")
    recs = t.table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "view", F.concat(F.lit("u"), user)).alias("user_id"),
        F.when(F.col("event_type").isin("view", "click"), F.concat(F.lit("s"), user)).alias("session_id"),
    )
    return C.recommendation_targets(recs).select("event_id", "target", "target_id")


@query(
    "assistant_routing",
    """SELECT conv_id || '-' || turn AS id, c.connection_id FROM conversations
LEFT JOIN (SELECT o_orderkey // 3 AS s, max('conn-' || o_orderkey) AS connection_id FROM orders GROUP BY 1) c ON c.s = conv_id
WHERE role = 'assistant'""",
)
def assistant_routing(spark, folder):
    responses = t.chat(spark, folder).where(F.col("user_id").startswith("assistant")).select("id", F.col("room").alias("session_id"))
    conns = t.table(spark, folder, "orders").groupBy(F.expr("o_orderkey div 3").alias("session_id")).agg(
        F.max(F.concat(F.lit("conn-"), F.col("o_orderkey").cast("string"))).alias("connection_id")
    )
    return C.response_connections(responses, conns).select("id", "connection_id")


@query(
    "enriched_chat",
    "WITH " + t.CHAT + " SELECT sha256(user_id || '|' || seq || '|' || message) AS id, room, seq, 2 AS slots FROM chat",
)
def enriched_chat(spark, folder):
    from shelfline.functions.records import enrich_chat

    chat = t.chat(spark, folder).withColumnRenamed("seq", "timestamp").drop("id")
    out = enrich_chat(chat, F.array(F.lit("DE"), F.lit("DEFAULT"), F.lit("FR")))
    return out.select("id", "room", F.col("timestamp").alias("seq"), F.size("translations").alias("slots"))
