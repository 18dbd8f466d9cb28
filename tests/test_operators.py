"""Operators on small hand-worked inputs, and every windowed operator with and without slicing."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfline.operators import baskets, carts, catalog, changes, chat, metrics, routing, running, timers, views
from shelfline.operators.keyed import last_n, latest, order_by_key
from shelfline.session import shared_dir

PRODUCTS = "product_id STRING, ts LONG, seq LONG, inventory INT, price DOUBLE, name STRING"
HOUR = 3_600_000


def frame(spark, data, schema=PRODUCTS):
    return spark.createDataFrame(data, schema)


def tracker_rows():
    steps = [
        ("LAPTOP", 10, 999.99), ("MOUSE", 50, 29.99), ("LAPTOP", 8, 999.99), ("LAPTOP", 15, 999.99),
        ("LAPTOP", 15, 899.99), ("MOUSE", 45, 29.99), ("KEYBOARD", 30, 79.99),
    ]
    return [(pid, i, i, inv, price, pid) for i, (pid, inv, price) in enumerate(steps)]


def test_change_tracker_fixture(spark):
    out = changes.track_changes(frame(spark, tracker_rows())).orderBy("ts").collect()
    assert [(r.product_id, r.change_type, r.delta) for r in out] == [
        ("LAPTOP", "NEW_PRODUCT", None), ("MOUSE", "NEW_PRODUCT", None), ("LAPTOP", "SALE", -2),
        ("LAPTOP", "RESTOCK", 7), ("LAPTOP", "PRICE_CHANGE", None), ("MOUSE", "SALE", -5), ("KEYBOARD", "NEW_PRODUCT", None),
    ]
    sales = running.sales_total(frame(spark, tracker_rows())).orderBy("ts").collect()
    assert [(r.product_id, r.total_cents) for r in sales] == [("LAPTOP", 199_998), ("MOUSE", 14_995)]
    alerts = changes.product_alerts(frame(spark, tracker_rows())).orderBy("ts").collect()
    assert [(r.alert_type, r.severity) for r in alerts] == [("LOW_STOCK", "WARNING"), ("PRICE_DROP", "INFO")]


def test_single_events_emit_one_main_event(spark):
    data = [("a", 0, 0, 10, 5.0, "A"), ("a", 1, 1, 10, 5.0, "A"), ("a", 2, 2, 10, 4.0, "A"), ("a", 3, 3, 0, 9.0, "A"), ("a", 4, 4, 3, 9.0, "A")]
    out = changes.single_events(frame(spark, data)).orderBy("ts", "event_type").collect()
    assert [(r.ts, r.event_type) for r in out] == [
        (0, "LOW_STOCK_ALERT"), (0, "PRODUCT_ADDED"), (1, "LOW_STOCK_ALERT"), (1, "PRODUCT_UPDATED"), (2, "LOW_STOCK_ALERT"),
        (2, "PRICE_CHANGED"), (2, "SALE_STARTED"), (3, "OUT_OF_STOCK"), (4, "BACK_IN_STOCK"), (4, "LOW_STOCK_ALERT"),
    ]
    assert [r.alert_level for r in out if r.ts == 4 and r.alert_level] == ["CRITICAL"]


def test_price_trend_fixture(spark):
    down = [("d", i, i, 1, p, "D") for i, p in enumerate([999.99, 949.99, 899.99])]
    up = [("u", i, i, 1, p, "U") for i, p in enumerate([899.99, 949.99, 999.99])]
    long = [("l", i, i, 1, float(i), "L") for i in range(11)]
    out = {(r.product_id, r.ts): r for r in running.price_trend(frame(spark, down + up + long)).collect()}
    assert (out["d", 2].trend, out["u", 2].trend, out["d", 1].trend) == ("DECREASING", "INCREASING", "STABLE")
    assert out["l", 10].price_history == [float(i) for i in range(1, 11)]


def test_stale_rules(spark):
    data = [("a", 0, 0, 5, 1.0, "A"), ("a", HOUR, 1, 4, 1.0, "A"), ("a", 2 * HOUR + 1, 2, 3, 1.0, "A")]
    out = timers.stale(frame(spark, data), 4 * HOUR + 2).orderBy("ts").collect()
    # A row exactly at the timer resets it; the gaps of 1 h + 1 ms and 2 h + 1 ms do not.
    assert [(r.stale_ts, r.severity) for r in out] == [(2 * HOUR, "MEDIUM"), (3 * HOUR + 1, "HIGH")]
    event = timers.stale_events(timers.stale(frame(spark, data), 4 * HOUR).withColumnRenamed("name", "product_name").withColumnRenamed("inventory", "current_inventory")).first()
    assert event.change_reason == "No updates for 1.0 hours"


def test_session_boundaries(spark):
    gap = 30 * 60_000
    data = [("u", 0, 0), ("u", 5 * 60_000, 1), ("u", 5 * 60_000 + gap, 2)]
    out = timers.session_timeouts(frame(spark, data, "user_id STRING, ts LONG, seq LONG")).orderBy("session_no").collect()
    assert [(r.item_count, r.duration_ms) for r in out] == [(2, 35 * 60_000), (1, gap)]


def test_router_fixture(spark):
    items = [
        ("KEYBOARD", 8, 79.99, 4.3), ("MONITOR", 5, 399.99, 4.4), ("TABLET", 3, 89.0, 4.5), ("HEADSET", 0, 59.99, 4.7),
        ("WEBCAM", 0, 129.0, 4.6), ("CHARGER", 0, 29.99, 4.8), ("CABLE", 100, 9.99, 4.6), ("ADAPTER", 60, 19.99, 4.9),
        ("LAPTOP", 20, 999.0, 4.9), ("MOUSE", 50, 29.0, 4.0),
    ]
    df = frame(spark, items, "product_id STRING, inventory INT, price DOUBLE, rating DOUBLE")
    routed = routing.inventory_routes(df)
    ids = lambda tag: sorted(r.product_id for r in routing.slice_of(routed, tag).collect())
    assert len(ids("main")) == 10
    assert ids("LOW_STOCK") == ["KEYBOARD", "MONITOR", "TABLET"]
    assert ids("OUT_OF_STOCK") == ["CHARGER", "HEADSET", "WEBCAM"]
    assert ids("PRICE_DROP") == ["ADAPTER", "CABLE", "CHARGER", "HEADSET"]
    percents = [r.discount_percent for r in routing.slice_of(routed, "PRICE_DROP").collect()]
    assert all(abs(p - 13.04) < 0.01 for p in percents)


def test_errors_and_category_routes(spark):
    df = frame(spark, [("a", -5, 1.0, "Home"), ("b", 1, 0.0, "Toys"), ("c", 1, 2.0, None)], "product_id STRING, inventory INT, price DOUBLE, category STRING")
    out = {r.product_id: r for r in routing.split_errors(df).collect()}
    assert (out["a"].error_type, out["b"].error_type, out["c"].error_type) == ("INVALID_INVENTORY", "INVALID_PRICE", None)
    assert out["a"].error_message == "Inventory cannot be negative: -5"
    tags = [r.output for r in routing.category_routes(df, {"Home": "category-home"}).orderBy("product_id").collect()]
    assert tags == ["category-home", "unknown", "unknown"]
    assert routing.union_all(df, df).count() == 6


def cart_log(spark):
    schema = "cart_id STRING, ts LONG, seq LONG, action STRING, product_id STRING, quantity INT, price_cents LONG"
    log = [
        ("c", 1, 1, "UPDATE_QUANTITY", "p", 9, None), ("c", 2, 2, "ADD", "p", 2, 100), ("c", 3, 3, "ADD", "p", 1, 90),
        ("c", 4, 4, "UPDATE_QUANTITY", "p", 5, None), ("c", 5, 5, "ADD", "q", 1, 50), ("c", 6, 6, "REMOVE", "q", None, None),
        ("d", 1, 7, "ADD", "p", 1, 10), ("d", 2, 8, "CLEAR", None, None, None), ("d", 3, 9, "ADD", "r", 4, 25),
    ]
    return frame(spark, log, schema)


def test_cart_modes(spark):
    got = lambda mode: rows(carts.fold_cart(cart_log(spark), mode))  # noqa: E731  columns: cart, cents, lines, price, product, quantity
    assert got("append") == [("c", 590, 2, 100, "p", 6), ("d", 100, 1, 25, "r", 4)]
    assert got("upsert") == [("c", 500, 1, 100, "p", 5), ("d", 100, 1, 25, "r", 4)]
    with pytest.raises(ValueError):
        carts.fold_cart(cart_log(spark), "merge")


def test_checkout_ends_a_cart(spark):
    log = [
        ("c", 0, 0, "CHECKOUT", None, None, None), ("c", 1, 1, "ADD", "p", 2, 100), ("c", 2, 2, "CHECKOUT", None, None, None),
        ("c", 3, 3, "CHECKOUT", None, None, None), ("c", 4, 4, "ADD", "p", 1, 30), ("c", 5, 5, "REMOVE", "p", None, None),
        ("c", 6, 6, "CHECKOUT", None, None, None), ("c", 7, 7, "CHECKOUT", None, None, None), ("c", 8, 8, "ADD", "q", 1, 7),
        ("c", 9, 9, "CHECKOUT", None, None, None),
    ]
    out = carts.checkouts(frame(spark, log, cart_log(spark).schema)).orderBy("ts").collect()
    assert [(r.ts, r.reject_reason, r.total_cents) for r in out] == [
        (0, "Cart not found.", None), (2, None, 200), (3, "Cart not found.", None), (6, "Cart is empty", None), (7, "Cart is empty", None), (9, None, 7)]


def test_browse_without_a_bound_keeps_all_prices(spark):
    view = frame(spark, [("a", 100.0), ("b", 7000.0), ("c", None)], "product_id STRING, price DOUBLE").withColumn("category", F.lit("x"))
    ids = lambda df: [r.product_id for r in df.collect()]
    assert ids(catalog.browse(view)) == ["a", "b", "c"]
    assert ids(catalog.browse(view, price=(None, 500))) == ["a"] and ids(catalog.browse(view, price=(500, None))) == ["b"]


def test_tied_rows_are_ordered_alike_with_and_without_slices(spark, both_ways):
    tied = frame(spark, [("k", i // 40, i) for i in range(200)], "product_id STRING, ts LONG, v LONG")

    def firsts():
        keyed = order_by_key(tied, ["product_id"], ["ts"], before=1)
        return keyed.finish(keyed.df.withColumn("ahead", F.lag("v").over(keyed.window())))

    plain, cut = both_ways(firsts)
    assert plain == cut


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_checkout_arithmetic_and_rejects(spark):
    lines = carts.fold_cart(cart_log(spark), "upsert")
    requests = frame(spark, [("c", None), ("x", "u"), (" ", "u"), (None, "u")], "session_id STRING, user_id STRING")
    out = carts.checkout(requests, lines).collect()
    good = next(r for r in out if r.status == "CONFIRMED")
    assert (str(good.subtotal), str(good.tax), str(good.shipping), str(good.total_amount), good.user_id) == ("5.00", "0.40", "5.99", "11.39", "guest")
    assert sorted(r.reject_reason for r in out if r.reject_reason) == ["Cart not found.", "Session ID is missing.", "Session ID is missing."]
    emptied = frame(spark, [("c", 1, 1, "ADD", "p", 1, 5), ("c", 2, 2, "CLEAR", None, None, None)], cart_log(spark).schema)
    out = carts.checkout(requests, carts.fold_cart(emptied, "upsert"), emptied).collect()
    assert sorted(r.reject_reason for r in out) == ["Cart is empty", "Cart not found.", "Session ID is missing.", "Session ID is missing."]
    rich = frame(spark, [("c", 5001)], "cart_id STRING, total_cents LONG")
    assert str(carts.estimate(rich).first().shipping) == "0.00"


def test_stock_cap(spark):
    schema = "cart_id STRING, product_id STRING, ts LONG, seq LONG, quantity INT"
    adds = frame(spark, [("c", "p", i, i, 2) for i in range(4)] + [("c", "none", 9, 9, 1)], schema)
    stock = frame(spark, [("p", 5)], "product_id STRING, inventory INT")
    out = carts.capped_adds(adds, stock).orderBy("ts").collect()
    assert [(r.product_id, r.final_quantity) for r in out] == [("p", 2), ("p", 4), ("p", 5), ("none", 0)]


def test_partial_merge(spark):
    full = frame(spark, [("a", 1, 1, 5, 1.0, "A"), ("a", 4, 4, 9, 2.0, "A2"), ("b", 2, 2, 3, 1.0, "B")])
    partial = frame(spark, [("a", 3, 3, 0, None, None), ("a", 5, 5, 7, None, None), ("b", 1, 1, 0, 9.0, None), ("x", 1, 1, 1, 1.0, None)])
    out = {r.product_id: (r.inventory, r.price, r.name) for r in views.merge_partial(full, partial).collect()}
    assert out == {"a": (7, 2.0, "A2"), "b": (3, 1.0, "B")}


def test_chat_routing_fixture(spark):
    schema = "id STRING, user_id STRING, to_user STRING, event_type STRING, type STRING, message STRING, translations MAP<STRING,STRING>"
    none = None
    messages = [
        ("m1", "SomeSender", "user2", "CHAT_MESSAGE", "CHAT_MESSAGE", "hi", {"DE": "hallo"}),
        ("m2", "user1", "SomeReceiver", "CHAT_MESSAGE", "CHAT_MESSAGE", "yo", none),
        ("m3", "SomeSender", "SomeReceiver", "CHAT_MESSAGE", "CHAT_MESSAGE", "no", none),
        ("m4", "user1", None, "CHAT_MESSAGE", "USER_JOINED", "joined", {"DE": "x"}),
        ("m5", "user1", None, "CHAT_MESSAGE", "CHAT_MESSAGE", "all", {"DE": "alle"}),
        ("m6", "user1", "user1", "CHAT_MESSAGE", "CHAT_MESSAGE", "me", none),
    ]
    df = frame(spark, messages, schema)
    online = frame(spark, [("user1",), ("user2",)], "user_id STRING")
    prefs = frame(spark, [("user2", "DE")], "user_id STRING, language STRING")
    out = chat.deliver(df, online, prefs)
    got = sorted((r.id, r.recipient or "*", r.language, r.message, r.translated) for r in out.collect())
    assert got == [
        ("m1", "user2", "DE", "hallo", True), ("m2", "user1", "DEFAULT", "yo", False), ("m4", "*", "DEFAULT", "joined", False),
        ("m5", "*", "DE", "alle", True), ("m5", "*", "DEFAULT", "all", False), ("m6", "user1", "DEFAULT", "me", False),
    ]


def test_presence_and_preferences(spark):
    log = [("user1", 1, 1, "USER_JOINED"), ("user2", 2, 2, "USER_JOINED"), ("user2", 3, 3, "USER_LEFT")]
    out = metrics.online_users(frame(spark, log, "user_id STRING, ts LONG, seq LONG, type STRING"))
    assert [r.user_id for r in out.collect()] == ["user1"]
    settings = [("a", 1, 1, "DE"), ("a", 2, 2, "DEFAULT"), ("b", 1, 1, "FR")]
    out = views.preferred_language(frame(spark, settings, "user_id STRING, ts LONG, seq LONG, language STRING"))
    assert [(r.user_id, r.language) for r in out.collect()] == [("b", "FR")]


def test_fanout_targets(spark):
    schema = "event_type STRING, to_user STRING, key STRING"
    df = frame(spark, [("RECOMMENDATION", "u", "s"), ("SHOPPING_CART", "u", "s"), ("PRODUCT_UPDATE", None, None), ("ORDER_UPDATE", "u", "s")], schema)
    conns = frame(spark, [("c1", "u", "s"), ("c2", "u", "t")], "connection_id STRING, user_id STRING, session_id STRING")
    out = chat.to_connections(chat.event_targets(df), conns)
    assert sorted((r.event_type, r.connection_id or "*") for r in out.collect()) == [
        ("PRODUCT_UPDATE", "*"), ("RECOMMENDATION", "c1"), ("RECOMMENDATION", "c2"), ("SHOPPING_CART", "c1"),
    ]


def test_catalogue_reads(spark):
    schema = "product_id INT, name STRING, description STRING, brand STRING, category STRING, tags ARRAY<STRING>, price DOUBLE, rating DOUBLE, review_count INT, ts LONG"
    view = frame(spark, [
        (1, "Red Lamp", "lights", "B", "Home", ["Deal"], 10.0, 4.5, 5, 1), (2, "Desk", None, "Lampo", "Home", [], 99.0, 3.0, 9, 3),
        (3, "Phone", "smart", "C", "Tech", ["lamp"], 6000.0, 4.0, None, 2),
    ], schema)
    ids = lambda df: [r.product_id for r in df.collect()]
    assert ids(catalog.list_products(view, search="LAMP")) == [1]
    assert ids(catalog.list_products(view, search="lamp", include_tags=True)) == [1, 3]
    assert ids(catalog.list_products(view, category="home", limit=1)) == [1]
    assert sorted(ids(catalog.search_products(view, "lamp"))) == [1, 3]
    assert ids(catalog.browse(view, text="lamp", sort="price-high")) == [3, 2, 1]
    assert [ids(catalog.browse(view, price=(0, 9000), sort=s)) for s in ("price-low", "rating", "newest", "popular", "featured")] == [
        [1, 2, 3], [1, 3, 2], [2, 3, 1], [2, 1, 3], [1, 2, 3]]
    assert (ids(catalog.trending(view, 1)), ids(catalog.featured(view)), ids(catalog.featured_by_score(view, 2))) == ([2], [1, 3], [2, 1])
    with pytest.raises(ValueError):
        catalog.browse(view, sort="best")


def test_warehouses(spark):
    schema = "product_id STRING, site STRING, ts LONG, seq LONG, inventory INT"
    data = [("p", "x", 0, 0, 8), ("p", "y", 1, 1, 4), ("p", "x", 2, 2, 1), ("p", "y", 3 * HOUR, 3, 20)]
    out = running.warehouse_totals(frame(spark, data, schema)).orderBy("ts").collect()
    assert [(r.total_inventory, r.low_total) for r in out] == [(8, True), (12, False), (5, True), (21, False)]
    due = running.reorder_due(frame(spark, data, schema), 2 * HOUR, 9 * HOUR).collect()
    assert [(r.low_since, r.low_until) for r in due] == [(2, 3 * HOUR)]


def test_balances_and_fraud(spark):
    schema = "account_id STRING, ts LONG, seq LONG, type STRING, amount LONG"
    out = running.balances(frame(spark, [("a", 0, 0, "in", 100), ("a", 1, 1, "out", -300), ("a", 2, 2, "out", -900)], schema)).orderBy("ts").collect()
    assert [(r.previous_balance, r.new_balance, r.type_count, r.overdraft, r.fraud_alert) for r in out] == [
        (0, 100, 1, False, False), (100, -200, 1, True, False), (-200, -1100, 2, True, True)]


def test_basket_rules(spark):
    lines = [(b, i) for b, items in enumerate(["ab", "abc", "a", "bc", "ab"]) for i in items]
    out = baskets.pair_rules(frame(spark, lines, "basket INT, item STRING"), "basket", "item", 0.4)
    got = {(r.antecedent, r.consequent): round(r.confidence, 3) for r in out.collect()}
    assert got == {("a", "b"): 0.75, ("b", "a"): 0.75, ("b", "c"): 0.5, ("c", "b"): 1.0}


def test_abandonment(spark):
    schema = "user_id STRING, ts LONG, seq LONG, event_type STRING"
    data = [("u", 0, 0, "ADD_TO_CART"), ("u", 50, 1, "ORDER_PLACED"), ("u", 60, 2, "ADD_TO_CART"), ("v", 0, 3, "ADD_TO_CART"), ("v", 500, 4, "ORDER_PLACED")]
    out = timers.abandoned(frame(spark, data, schema), 100)
    assert sorted((r.user_id, r.ts) for r in out.collect()) == [("u", 60), ("v", 0)]


def test_salted_totals_and_recent_points(spark):
    data = [("k", i % 7, 1) for i in range(50)]
    row = metrics.salted_totals(frame(spark, data, "k STRING, d INT, v INT"), ["k"], "v", "d").first()
    assert (row.n, row.total, row.distinct_values) == (50, 50, 7)
    pts = frame(spark, [(1,), (31_001,), (31_000 + 30_000,)], "ts LONG")
    assert sorted(r.ts for r in catalog.recent_points(pts).collect()) == [31_001, 61_000]


# ---- Slicing never changes a result ----------------------------------------------------------------


def busy(spark, n=150, seed=11):
    """One product with most of the rows, two with few."""
    rng = random.Random(seed)
    data, ts = [], 0
    for i in range(n):
        ts += rng.choice([1, 60_000, 2 * HOUR])
        data.append((rng.choice("aaaaaabc"), ts, i, rng.randrange(12), rng.choice([1.0, 1.2, 2.0, 3.0]), "N"))
    return frame(spark, data), ts


def activity(spark, n=120):
    rng = random.Random(2)
    kinds = ["PRODUCT_VIEW", "RECOMMENDATION_CLICKED", "ORDER_PLACED"]
    data = [(rng.choice("uuuv"), i * rng.choice([1000, 900_000]) + i, i, rng.choice(kinds), rng.choice("xyz"), rng.randint(-9, 9)) for i in range(n)]
    return frame(spark, data, "user_id STRING, ts LONG, seq LONG, event_type STRING, product_id STRING, amount LONG")


def actions(spark, n=120):
    rng = random.Random(6)
    kinds = ["ADD"] * 6 + ["REMOVE", "UPDATE_QUANTITY", "CLEAR"]
    data = [(rng.choice("cccd"), i, i, rng.choice(kinds), rng.choice("pq"), rng.randint(1, 4), rng.randint(1, 90)) for i in range(n)]
    return frame(spark, data, "cart_id STRING, ts LONG, seq LONG, action STRING, product_id STRING, quantity INT, price_cents LONG")


CASES = {
    "changes": lambda s: changes.track_changes(busy(s)[0]),
    "ttl": lambda s: changes.track_changes(busy(s)[0], ttl_ms=HOUR),
    "single": lambda s: changes.single_events(busy(s)[0]),
    "trend": lambda s: running.price_trend(busy(s)[0]).withColumn("price_history", F.col("price_history").cast("string")),
    "sales": lambda s: running.sales_total(busy(s)[0]),
    "categories": lambda s: running.category_sales(busy(s)[0].withColumn("categories", F.array(F.lit("m"), "name"))),
    "stats": lambda s: running.running_stats(busy(s)[0], ["product_id"], "inventory"),
    "anomalies": lambda s: running.anomalies(busy(s)[0], "product_id", "inventory", n=10, k=1.0),
    "stale": lambda s: timers.stale(busy(s)[0], 10**9),
    "snapshots": lambda s: timers.snapshots(busy(s)[0], 2 * 10**8, 10 * HOUR),
    "sessions": lambda s: timers.session_timeouts(activity(s)),
    "abandoned": lambda s: timers.abandoned(activity(s), 10**6, start="PRODUCT_VIEW"),
    "balances": lambda s: running.balances(activity(s), "user_id", "amount", "event_type"),
    "recent": lambda s: metrics.seen_in_last(activity(s), 5_000_000),
    "features": lambda s: metrics.session_features(activity(s), 10**6),
    "cart totals": lambda s: carts.cart_totals(actions(s)),
    "cart append": lambda s: carts.fold_cart(actions(s), "append"),
    "cart upsert": lambda s: carts.fold_cart(actions(s), "upsert"),
    "warehouses": lambda s: running.warehouse_totals(busy(s)[0].withColumn("site", F.col("seq") % 3)),
    "reorder": lambda s: running.reorder_due(busy(s)[0].withColumn("site", F.col("seq") % 2), HOUR, 10**9),
    "global": lambda s: running.running_global(busy(s)[0].withColumn("v", F.col("inventory").cast("long")), "v", ("ts", "seq"), F.floor(F.col("ts") / (24 * HOUR))),
}


@pytest.mark.parametrize("case", CASES)
def test_slicing_changes_no_result(spark, both_ways, case):
    plain, cut = both_ways(lambda: CASES[case](spark))
    assert plain == cut and plain


def test_last_n_and_latest_with_salts(spark):
    df, _ = busy(spark)
    top = last_n(df, ["product_id"], ["ts", "seq"], 3, salts=5)
    newest = {r.product_id: r.seq for r in latest(df, ["product_id"], ["ts", "seq"]).collect()}
    got = {(r.product_id, r.position): r.seq for r in top.collect()}
    assert {k: got[k, 1] for k in newest} == newest
    assert max(p for _, p in got) == 3
