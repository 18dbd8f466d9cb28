"""The closed-form ledger against a plain replay of the rules, and its slicing."""

import random

import pytest
from conftest import DATA, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.operators import ledger as L
from shelfline.operators.keyed import order_by_key
from shelfline.plans import tables as t

SCHEMA = "product_id STRING, ts LONG, seq LONG, kind STRING, order_id STRING, qty INT, inventory INT, price DOUBLE, name STRING"


def product(pid, ts, inventory, price, seq=0):
    return (pid, ts, seq, "PRODUCT", None, 0, inventory, price, pid.title())


def order(pid, ts, qty, order_id="o", seq=0):
    return (pid, ts, seq, "ORDER", order_id, qty, None, None, None)


def replay(log):
    """The rules, row by row."""
    state, out = {}, []
    for pid, ts, seq, kind, _, qty, inventory, price, _ in sorted(log, key=lambda r: (r[0], r[1], r[2])):
        known = state.get(pid)
        if kind == "PRODUCT":
            out.append((pid, ts, seq, known and known[0], inventory, known and known[1], price))
            state[pid] = (inventory, price)
        elif known:
            left = max(0, known[0] - qty)
            out.append((pid, ts, seq, known[0], left, known[1], known[1]))
            state[pid] = (left, known[1])
    return sorted(out, key=str)


def as_rows(df):
    cols = ["product_id", "ts", "seq", "previous_inventory", "current_inventory", "previous_price", "current_price"]
    return sorted([tuple(r) for r in df.select(*cols).collect()], key=str)


logs = st.lists(
    st.one_of(
        st.tuples(st.just("P"), st.sampled_from("ab"), st.integers(0, 30), st.sampled_from([1.0, 2.5, 9.99])),
        st.tuples(st.just("O"), st.sampled_from("ab"), st.integers(1, 20), st.none()),
    ),
    min_size=1,
    max_size=60,
)


def build(steps):
    return [
        product(pid, i, n, price, seq=i) if kind == "P" else order(pid, i, n, seq=i)
        for i, (kind, pid, n, price) in enumerate(steps)
    ]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(logs)
def test_random_logs_match_the_replay(spark, steps):
    log = build(steps)
    assert as_rows(L.ledger(spark.createDataFrame(log, SCHEMA))) == replay(log)


def test_sliced_hot_product_matches_the_replay(spark, sliced):
    rng = random.Random(5)
    steps = [
        ("P", "a", rng.randrange(30), 1.5) if rng.random() < 0.08 else ("O", rng.choice("aaab"), rng.randint(1, 4), None)
        for _ in range(300)
    ]
    log = build(steps)
    df = spark.createDataFrame(log, SCHEMA)
    assert order_by_key(df, ["product_id"], ["ts", "seq"]).sliced
    assert as_rows(L.ledger(df)) == replay(log)


def test_slicing_changes_no_result(spark, both_ways):
    plain, cut = both_ways(lambda: L.ledger(t.ledger_rows(spark, DATA), t.LINE_ORDER))
    assert plain == cut and len(plain) > 5000


def test_deduction_and_its_slicing(spark, both_ways):
    stock = spark.createDataFrame([("a", "A", 10, 2.0)], "product_id STRING, name STRING, inventory INT, price DOUBLE")
    log = [order("a", 1, 4, "o1"), order("a", 2, 9, "o2"), order("a", 3, 1, "o3"), order("z", 1, 1, "o4")]
    got = {r.order_id: r for r in L.deduct(stock, spark.createDataFrame(log, SCHEMA)).collect()}
    assert (got["o1"].event_type, got["o1"].current_inventory) == ("INVENTORY_DECREASED", 6)
    assert got["o2"].change_reason == "Order o2: Insufficient inventory (ordered: 9, available: 6)"
    assert (got["o3"].previous_inventory, got["o3"].event_type) == (0, "OUT_OF_STOCK")
    assert got["o4"].product_name == "Unknown Product"
    many = [order("a", i, 1 + i % 3, f"o{i}") for i in range(60)]
    plain, cut = both_ways(lambda: L.deduct(stock, spark.createDataFrame(many, SCHEMA)))
    assert plain == cut


def test_orders_and_product_rules(spark):
    log = [
        order("laptop", 0, 1, "early"),
        product("laptop", 1, 17, 999.99),
        order("laptop", 2, 2, "o1"),
        order("laptop", 3, 5, "o2"),
        order("laptop", 4, 50, "o3"),
        order("laptop", 5, 1, "o4"),
        product("laptop", 6, 10, 899.99),
    ]
    df = spark.createDataFrame(log, SCHEMA)
    entries = L.ledger(df)
    events = [(r.ts, r.event_type, r.previous_inventory, r.current_inventory, r.change_reason)
              for r in L.ledger_events(entries).orderBy("ts", "event_type").collect()]
    assert events == [
        (1, "PRODUCT_ADDED", 0, 17, "New product added to catalog"),
        (2, "INVENTORY_DECREASED", 17, 15, "Deducted 2 for order o1"),
        (3, "INVENTORY_DECREASED", 15, 10, "Deducted 5 for order o2"),
        (4, "INVENTORY_DECREASED", 10, 0, "Deducted 50 for order o3"),
        (5, "INVENTORY_DECREASED", 0, 0, "Deducted 1 for order o4"),
        (6, "BACK_IN_STOCK", 0, 10, "Product restocked with 10 units"),
        (6, "PRICE_CHANGED", 0, 10, "Price decreased by $100.00 (10.0%)"),
    ]
    alerts = [(r.ts, r.alert_type, r.severity) for r in L.ledger_alerts(entries).orderBy("ts").collect()]
    # 10 left alerts on an order row and not on a catalogue row; every order at zero alerts again.
    assert alerts == [
        (3, "LOW_STOCK", "WARNING"),
        (4, "OUT_OF_STOCK", "CRITICAL"),
        (5, "OUT_OF_STOCK", "CRITICAL"),
        (6, "PRICE_DROP", "INFO"),
    ]
    assert [r.order_id for r in L.orders_before_product(df).collect()] == ["early"]


def test_composition_fixture(spark):
    start = [("LAPTOP", 10, 1299.99), ("MOUSE", 50, 29.99), ("DESK", 30, 199.99)]
    log = [product(pid, 0, inv, price) for pid, inv, price in start]
    log += [product("LAPTOP", 1, 8, 1299.99), product("LAPTOP", 2, 8, 999.99), product("MOUSE", 1, 5, 29.99)]
    entries = L.ledger(spark.createDataFrame(log, SCHEMA))
    kinds = sorted(r.event_type for r in L.ledger_events(entries).collect())
    assert kinds == ["INVENTORY_DECREASED"] * 2 + ["PRICE_CHANGED"] + ["PRODUCT_ADDED"] * 3
    alerts = sorted((r.alert_type, r.product_id, r.severity) for r in L.ledger_alerts(entries).collect())
    assert alerts == [
        ("LOW_STOCK", "LAPTOP", "WARNING"), ("LOW_STOCK", "MOUSE", "CRITICAL"), ("PRICE_DROP", "LAPTOP", "INFO"),
    ]


def test_zero_previous_price_has_no_drop_alert(spark):
    log = [product("a", 0, 20, 0.0), product("a", 1, 20, 5.0)]
    entries = L.ledger(spark.createDataFrame(log, SCHEMA))
    assert [r.event_type for r in L.ledger_events(entries).where("ts = 1").collect()] == ["PRICE_CHANGED"]
    assert L.ledger_alerts(entries).count() == 0


def test_plan_has_one_exchange(spark):
    df = L.ledger(t.ledger_rows(spark, DATA), t.LINE_ORDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_messages_are_written_and_read_once_per_event(spark):
    """Every event was made into JSON for each of its two topics, and read with two more parses; odd texts and nulls come out the same."""
    from shelfline.functions.records import ui_update, ui_update_text
    from shelfline.plans.routes import topic_messages

    plan = topic_messages(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "get_json_object" not in plan
    df = spark.createDataFrame([('a "q" \\ ä\n', 1.5, 7), (None, None, None), ("x", None, -3)], "name string, price double, ts long")
    body = F.struct("name", "price")
    got = df.select(ui_update(body, F.col("ts")).alias("a"), ui_update_text(F.to_json(body), F.col("ts")).alias("b")).collect()
    assert len(got) == 3 and all(r.a == r.b for r in got)
    texts = df.select(L.number_text(F.col("ts")).alias("a"), F.format_string("%d", "ts").alias("b")).collect()
    assert all(r.a == r.b for r in texts)
