"""Parsers and validators on the edge cases of the message contract."""

import json

import pytest

from shelfline.functions import records as R


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


def product(**over):
    base = {"productId": "p1", "name": "N", "price": 9.5, "inventory": 3, "tags": ["a"], "rating": 4.5, "reviewCount": 2}
    return {**base, **over}


def test_products_of_objects_and_arrays(spark):
    text = json.dumps([product(), None, product(productId="p2", inventory="7", price="1.25", rating=None)])
    out = R.parse_products(values(spark, text, " \t " + json.dumps(product(productId="p3", inventory=2.7)) + "\n", "  ", None))
    got = {r.productId: r for r in out.valid.collect()}
    assert sorted(got) == ["p1", "p2", "p3"]
    assert (got["p2"].inventory, got["p2"].price, got["p2"].rating) == (7, 1.25, 0.0)
    assert got["p3"].inventory == 2 and got["p1"].tags == ["a"] and got["p1"].brand is None
    assert out.dead.count() == 0


@pytest.mark.parametrize(
    "text, reason",
    [
        ("nope", "not JSON"),
        (json.dumps([product(), product(extra=1)]), "unknown field or unreadable value"),
        (json.dumps(product(inventory="many")), "unknown field or unreadable value"),
        ('{"productId": ', "malformed JSON"),
        ('{"productId": "a", "tags": "x"}', "unknown field or unreadable value"),
        ('{"productId": "a", "tags": [["x"]]}', "unknown field or unreadable value"),
        ('{"productId": {"id": 1}}', "unknown field or unreadable value"),
        (json.dumps([json.dumps({"productId": "a"})]), "unknown field or unreadable value"),
        ('[{"productId": "a"}', "malformed JSON"),
    ],
)
def test_rejected_products(spark, text, reason):
    out = R.parse_products(values(spark, text))
    assert out.valid.count() == 0
    assert [(r.value, r.reject_reason) for r in out.dead.collect()] == [(text, reason)]


def test_missing_numbers_are_zero(spark):
    row = R.parse_products(values(spark, '{"productId":"p","price":null}')).valid.first()
    assert (row.price, row.inventory, row.name) == (0.0, 0, None)


def test_order_items(spark):
    out = R.parse_order_items(
        values(
            spark,
            '{"orderId":"o1","productId":"p1","quantity":2,"timestamp":5}',
            '{"orderId":null,"productId":"p1","quantity":"3"}',
            '{"orderId":"o3","productId":"p1","quantity":2.7,"timestamp":"8"}',
            '{"orderId":"o4","productId":"p1","quantity":0}',
            '{"orderId":"o5","productId":"p1","quantity":-1}',
            '{"orderId":"o6","productId":"p1"}',
            '{"orderId":"","productId":"p1","quantity":1}',
            '{"orderId":"o8","quantity":1}',
            "garbage",
        )
    )
    got = sorted((r.orderId, r.quantity, r.timestamp) for r in out.valid.collect())
    assert got == [("null", 3, 0), ("o1", 2, 5), ("o3", 2, 8)]
    reasons = sorted(r.reject_reason for r in out.dead.collect())
    assert reasons == ["malformed JSON", "no orderId", "no productId"] + ["quantity not positive"] * 3


def change(op="c", table="order_items", **after):
    row = {"order_item_id": 1, "order_id": "o1", "product_id": "p1", "quantity": 2, **after}
    return json.dumps({"op": op, "ts_ms": 9, "source": {"table": table}, "after": row})


def test_change_records(spark):
    df = values(spark, change(), change("u"), change(table="orders"), "x", '{"op":"c","source":{"table":"order_items"}}')
    rows = R.cdc_order_items(df).collect()
    assert [tuple(r) for r in rows] == [("o1", "p1", 2, 9, 1)]
    assert [(r.orderId, r.eventType) for r in R.cdc_orders(df).collect()] == [("o1", "ORDER_PLACED")]


EVENT = "productId STRING, productName STRING, eventType STRING, previousInventory INT, currentInventory INT, previousPrice DOUBLE, currentPrice DOUBLE, timestamp LONG, changeReason STRING, alertLevel STRING"


def test_event_rules_and_derived_fields(spark):
    rows = [
        ("p", "n", "INVENTORY_DECREASED", 5, 3, 1.0, 1.0, 1, None, None),
        ("p", " ", "OUT_OF_STOCK", 5, 3, None, None, 0, None, None),
        ("p", "n", "LOW_STOCK_ALERT", None, 3, None, None, 1, None, " "),
        ("p", "n", "PRICE_CHANGED", None, -1, None, None, 1, None, "critical"),
        ("p", "n", "SORT_CHANGE", None, None, None, None, 1, None, None),
    ]
    out = R.derived_fields(R.validate_events(spark.createDataFrame(rows, EVENT))).collect()
    assert [len(r.violations) for r in out] == [0, 3, 0, 2, 1]
    assert out[2].alertLevel == "WARNING"
    assert (out[0].inventoryChange, out[0].priceChange, out[2].inventoryChange) == (-2, 0.0, 0)
    assert [r.critical for r in out] == [False, True, False, True, False]


def test_alert_rules(spark):
    df = spark.createDataFrame(
        [("LOW_STOCK", "p", "m", None, 1), ("LOW_STOCK", "", "m", "INFO", 0)],
        "alertType STRING, productId STRING, message STRING, severity STRING, timestamp LONG",
    )
    good, bad = R.validate_alerts(df).collect()
    assert (good.severity, good.violations) == ("MEDIUM", [])
    assert bad.violations == ["missing:productId", "not-positive:timestamp"]


def test_partial_products_skip_nulls_and_additions(spark):
    df = values(
        spark,
        '{"eventType":"PRODUCT_ADDED","productId":"a","currentInventory":1}',
        '{"eventType":"STALE_INVENTORY","productId":"b","currentInventory":4,"currentPrice":null}',
        "bad",
    )
    assert [tuple(r) for r in R.partial_products(df).collect()] == [("b", 4, None)]


def test_tracked_events(spark):
    df = values(
        spark,
        '{"eventType":"PRODUCT_VIEW","productId":"p","metadata":{"a":"1"}}',
        '{"eventType":"SORT_CHANGE"}',
        "x",
    )
    out = R.parse_tracked(df)
    assert out.valid.count() == 1 and out.dead.count() == 2
    from pyspark.sql import functions as F

    full = R.enrich_tracked(out.valid, F.lit("s1"), F.lit(None).cast("string"), F.lit(7).cast("long"), {"a": F.lit("2"), "ua": F.lit("x")})
    row = full.first()
    assert (row.sessionId, row.userId, row.timestamp) == ("s1", None, 7)
    assert row.metadata == {"a": "1", "ua": "x"} and len(row.eventId) == 64


def test_envelopes(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("s", "u", 3)], "session STRING, user STRING, ts LONG")
    out = R.envelope(df, "SHOPPING_CART", F.struct("ts"), F.col("session"), F.col("user"), F.col("ts"))
    row = out.first()
    assert (row.key, row.toUserId, row.eventType, row.payload) == ("s", "u", "SHOPPING_CART", '{"ts":3}')
    with pytest.raises(ValueError):
        R.envelope(df, "BASKET", F.struct("ts"), F.col("session"), F.col("user"), F.col("ts"))
    marked = R.by_envelope_type(values(spark, '{"eventType":"CHAT_MESSAGE"}', '{"eventType":"BASKET"}')).collect()
    assert [r.reject_reason for r in marked] == [None, "unknown event type"]
    body = json.loads(df.select(R.ui_update(F.struct("user"), F.col("ts")).alias("v")).first().v)
    assert body == {"eventType": "INVENTORY_UPDATE", "payload": {"user": "u"}, "timestamp": 3}


def test_topic_inspection(spark):
    a = values(spark, '{"productId":"p"}', '{"productId":"q"}')
    b = values(spark, '{"productId":"p","x":1}')
    assert [r.topic for r in R.inspect_topics({"a": a, "b": b}, "p").orderBy("topic").collect()] == ["a", "b"]


def test_geo_lines(spark):
    df = values(spark, '{"type":"Feature","geometry":{"coordinates":[13.4,52.5]}},', "]")
    assert [tuple(r) for r in R.geo_features(df).collect()] == [(52.5, 13.4)]


def test_assistant_and_chat(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [("s", "u", "hi", 1), ("s", "u", "  ", 2), (" ", "u", "x", 3), ("s", "u", None, 4)],
        "session_id STRING, user_id STRING, text STRING, timestamp LONG",
    )
    for c in ("basket", "product", "context"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    assert [(r.type, r.timestamp) for r in R.assistant_messages(df).collect()] == [("USER_MESSAGE", 1), ("INIT", 4)]
    out = R.assistant_responses(values(spark, '{"sessionId":"s","text":"t"}'), F.lit(9).cast("long")).first()
    assert out.timestamp == 9 and out.messageId and out.products is None
    chat = spark.createDataFrame([("u", 1, "m")], "user_id STRING, timestamp LONG, message STRING")
    row = R.enrich_chat(chat, F.array(F.lit("DE"), F.lit("DEFAULT"), F.lit("DE"))).first()
    assert row.translations == {"DE": None}


def test_product_rules_are_in_the_plan_once(spark):
    """Neither a filter on valid records nor one on their fields repeats the check of a record."""
    texts = spark.createDataFrame([('{"productId": "p", "name": "n", "price": 1, "inventory": 2}',)], "value string")
    valid = R.parse_products(texts).valid.where("name <> '' and inventory >= 0").select("productId")
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("schema_of_variant") <= 2
