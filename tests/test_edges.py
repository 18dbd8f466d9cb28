"""Settings, sources, sinks and the batch jobs around them."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfline import schemas as S
from shelfline.config import JobConfig
from shelfline.plans import jobs
from shelfline.session import SLICE_ROWS, setting, shared_dir
from shelfline.sinks import relational as rel_out
from shelfline.sinks import topics as out
from shelfline.sources import files, hybrid, relational, topics

PRODUCTS = [
    {"productId": "p1", "name": "One", "price": 9.99, "inventory": 8, "tags": ["a"]},
    {"productId": "p2", "name": "Two", "price": 5.0, "inventory": 0},
    {"productId": "p3", "name": "Three", "price": 5.0, "inventory": 20},
]


def test_config_precedence_and_checks():
    env = {"KAFKA_BOOTSTRAP_SERVERS": "b:1", "PARALLELISM": "4", "JOB_NAME": "env"}
    config = JobConfig.from_args(["--job-name", "arg", "--checkpoint-interval", "5000"], env)
    assert (config.bootstrap_servers, config.parallelism, config.job_name, config.checkpoint_interval_ms) == ("b:1", 4, "arg", 5000)
    assert config.trigger() == {"processingTime": "5000 milliseconds"} and config.validate() is config
    for bad in (["--nope", "1"], ["--job-name"]):
        with pytest.raises(ValueError):
            JobConfig.from_args(bad, {})
    for field in ({"PARALLELISM": "200"}, {"PARALLELISM": "0"}, {"CHECKPOINT_INTERVAL_MS": "0"}, {"KAFKA_GROUP_ID": " "}):
        with pytest.raises(ValueError):
            JobConfig.from_env(field).validate()


def test_security_only_with_user_and_password():
    assert JobConfig.from_env({"KAFKA_USER": "u"}).security() == {}
    config = JobConfig.from_env({"KAFKA_USER": "u", "KAFKA_PASSWORD": "secret"})
    assert config.security()["kafka.sasl.mechanism"] == "SCRAM-SHA-256"
    assert "secret" not in repr(config)
    assert topics.options(config, "products")["startingOffsets"] == "latest"
    assert topics.options(config, "products", "earliest")["kafka.security.protocol"] == "SASL_PLAINTEXT"
    assert out.options(config, "t")["topic"] == "t"


def test_jdbc_options():
    got = relational.jdbc_options("jdbc:x", "orders", "id", 1, 100, 4)
    assert got["numPartitions"] == "4" and got["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        relational.jdbc_options("jdbc:x", "orders", "id", 9, 1, 4)
    assert rel_out.jdbc_options("jdbc:x", "t", "u", "p")["user"] == "u"


def test_broker_rows(spark):
    raw = spark.createDataFrame([(b"v", 1, 5), (b"w", 0, 6)], "value BINARY, partition INT, offset LONG").withColumn("timestamp", F.timestamp_millis(F.lit(7)))
    got = topics.text_rows(raw).orderBy("seq").collect()
    assert [(r.value, r.ts) for r in got] == [("w", 7), ("v", 7)] and got[0].seq == 6
    typed = topics.typed(spark.createDataFrame([('{"orderId":"o","quantity":2}',)], "value STRING"), S.ORDER_ITEM).first()
    assert (typed.orderId, typed.quantity) == ("o", 2)


def test_file_sources(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps(PRODUCTS, indent=1))
    (tmp_path / "p.jsonl").write_text("\n".join(map(json.dumps, PRODUCTS)))
    assert files.whole_files(spark, str(tmp_path / "p.json")).count() == 1
    array = files.product_array(spark, str(tmp_path / "p.json"))
    lines = files.product_lines(spark, str(tmp_path / "p.jsonl"))
    assert [r.productId for r in array.orderBy("productId").collect()] == ["p1", "p2", "p3"]
    assert array.exceptAll(lines).count() == 0
    assert files.or_empty(spark, str(tmp_path / "none.json")).count() == 0
    geo = '{\n"type": "FeatureCollection",\n"name": "x",\n"features": [\n{"type": "Feature", "geometry": {"coordinates": [1.0, 2.0]}},\n]}'
    (tmp_path / "g.json").write_text(geo)
    assert files.feature_lines(spark, str(tmp_path / "g.json")).count() == 1


def test_hybrid_stages_keep_their_order(spark):
    a, b = spark.createDataFrame([("a",)], "value STRING"), spark.createDataFrame([("b", 5)], "value STRING, ts LONG")
    got = hybrid.hybrid([a, a], b).orderBy("phase", "ts").collect()
    assert [(r.value, r.phase, r.ts, r.seq) for r in got] == [("a", 0, 0, 0), ("a", 1, 0, 0), ("b", 2, 5, 0)]
    with pytest.raises(ValueError):
        hybrid.hybrid([])


def texts(spark, data, ts=None):
    if ts is None:
        return spark.createDataFrame([(json.dumps(data),)], "value STRING")
    return spark.createDataFrame([(json.dumps(d), ts + i, i) for i, d in enumerate(data)], "value STRING, ts LONG, seq LONG")


def test_inventory_job(spark):
    updates = texts(spark, [{**PRODUCTS[2], "inventory": 5}, {**PRODUCTS[2], "name": " "}, {"productId": "x", "bad": 1}], 10)
    orders = texts(spark, [{"orderId": "o", "productId": "p1", "quantity": 3}, {"orderId": "o", "productId": "zz", "quantity": 3}, {"orderId": "o"}], 20)
    got = jobs.inventory(texts(spark, PRODUCTS), updates, orders)
    kinds = sorted((r.product_id, r.event_type, r.current_inventory) for r in got.events.collect())
    assert kinds == [
        ("p1", "INVENTORY_DECREASED", 5), ("p1", "PRODUCT_ADDED", 8), ("p2", "PRODUCT_ADDED", 0),
        ("p3", "INVENTORY_DECREASED", 5), ("p3", "PRODUCT_ADDED", 20),
    ]
    alerts = sorted((r.product_id, r.alert_type, r.severity) for r in got.alerts.collect())
    assert alerts == [("p1", "LOW_STOCK", "CRITICAL"), ("p1", "LOW_STOCK", "WARNING"), ("p2", "OUT_OF_STOCK", "CRITICAL"), ("p3", "LOW_STOCK", "CRITICAL")]
    assert (got.dead_products.count(), got.dead_orders.count()) == (1, 1)
    body = json.loads(next(r.value for r in out.event_messages(got.events).collect() if "Deducted" in r.value))
    assert (body["inventoryChange"], body["critical"], body["timestamp"]) == (-3, False, 20)
    ui = json.loads(out.ui_messages(got.events).first().value)
    assert ui["eventType"] == "INVENTORY_UPDATE" and "productId" in ui["payload"]
    view = jobs.product_view(
        got.products.withColumn("phase", F.lit(0)).drop("phase"),
        out.event_messages(got.events).select("value", F.lit(99).cast("long").alias("ts"), F.get_json_object("value", "$.timestamp").cast("long").alias("seq")),
    )
    assert {r.product_id: r.inventory for r in view.collect()}["p1"] == 5


def test_change_capture_job(spark):
    change = {"op": "c", "ts_ms": 4, "source": {"table": "order_items"}, "after": {"order_item_id": 7, "order_id": "o", "product_id": "p", "quantity": 2}}
    row = jobs.order_events(texts(spark, change)).first()
    assert row.key == "p" and json.loads(row.value) == {"orderId": "o", "productId": "p", "quantity": 2, "timestamp": 4, "order_item_id": 7}


def test_catalogue_rows_and_order_tables(spark):
    from shelfline.functions.records import parse_products

    head, stock = rel_out.catalogue_rows(parse_products(texts(spark, PRODUCTS)).valid)
    row = stock.orderBy("product_id").first()
    assert (row.on_hand, row.reserved, row.available, row.reorder_point, row.reorder_quantity) == (8, 0, 8, 10, 20)
    assert str(head.orderBy("product_id").first().price) == "9.99"
    orders = spark.createDataFrame([("o1", "guest", 0, "CONFIRMED", 5.0, 0.4, 5.99, 11.39), ("o2", "u", 0, "REJECTED", None, None, None, None)],
                                   "order_id STRING, user_id STRING, ts LONG, status STRING, subtotal DOUBLE, tax DOUBLE, shipping DOUBLE, total_amount DOUBLE")
    items = spark.createDataFrame([("o1", "p", 2, 250, 0, 500), ("o2", "p", 1, 1, 0, 1)], "order_id STRING, product_id STRING, quantity INT, price_cents LONG, discount_cents LONG, line_total_cents LONG")
    head, lines = rel_out.order_tables(orders, items)
    assert [(r.order_id, r.customer_id, str(r.total_amount)) for r in head.collect()] == [("o1", "guest", "11.39")]
    assert [(r.order_id, str(r.unit_price), str(r.line_total)) for r in lines.collect()] == [("o1", "2.50", "5.00")]
    stamped = rel_out.stamp_update(spark.createDataFrame([(1, None)], "id INT, last_updated TIMESTAMP"))
    assert stamped.first().last_updated is not None


def test_event_batches(spark):
    df = spark.createDataFrame([([("e1", "s", "u", "PAGE_VIEW", 1), ("e2", "s", "u", "PAGE_VIEW", 2)],)],
                               "events ARRAY<STRUCT<eventId: STRING, sessionId: STRING, userId: STRING, eventType: STRING, timestamp: LONG>>")
    got = [json.loads(r.value) for r in out.event_batch_messages(df).collect()]
    assert [json.loads(g["payload"])["eventId"] for g in got] == ["e1", "e2"] and {g["key"] for g in got} == {"s"}


def test_session_settings(spark):
    assert setting(spark, SLICE_ROWS) == 4_000_000
    assert shared_dir(spark) == shared_dir(spark)
