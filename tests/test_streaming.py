"""Streaming forms against the batch operators on the same rows, for one and for many input files."""

import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from shelfline import schemas as S
from shelfline.operators import ledger as L
from shelfline.operators import running, timers
from shelfline.plans import jobs
from shelfline.sinks import topics as out
from shelfline.streaming import stateful as st
from shelfline.streaming.micro_batches import StateTable, ledger_sink, ledger_step, view_sink

LEDGER = "product_id STRING, ts LONG, seq LONG, kind STRING, order_id STRING, qty INT, inventory INT, price DOUBLE, name STRING"
HOUR = 3_600_000


def log(n=120, seed=3):
    rng = random.Random(seed)
    rows, ts = [], 0
    for i in range(n):
        ts += rng.choice([1000, 60_000, HOUR // 2, 2 * HOUR])
        pid = rng.choice("ab")
        if rng.random() < 0.25:
            rows.append((pid, ts, i, "PRODUCT", None, 0, rng.randrange(25), rng.choice([5.0, 7.5]), pid.upper()))
        else:
            rows.append((pid, ts, i, "ORDER", f"o{i}", rng.randint(1, 5), None, None, None))
    return rows


def write_files(spark, rows, schema, folder, files):
    size = -(-len(rows) // files)
    for i in range(files):
        part = rows[i * size : (i + 1) * size]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def read_stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, df, tmp_path, mode="update"):
    """Run to the end and return every emitted row."""
    sink = str(tmp_path / "out")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .foreachBatch(keep)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(sink).drop("batch")


def run_until(spark, df, tmp_path, rows, seconds=60):
    """Run until `rows` rows are out: a processing-time query always has another batch to run."""
    query = df.writeStream.outputMode("update").format("memory").queryName("until").option(
        "checkpointLocation", str(tmp_path / "checkpoint")
    ).trigger(processingTime="0 seconds").start()
    try:
        for _ in range(seconds):
            if spark.table("until").count() >= rows or not query.isActive:
                break
            time.sleep(1)
    finally:
        query.stop()
    return spark.table("until")


def found(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


COLS = ("product_id", "ts", "seq", "previous_inventory", "current_inventory", "previous_price", "current_price", "product_name")


@pytest.mark.parametrize("files", [1, 4])
def test_ledger_with_timers_equals_batch(spark, tmp_path, files):
    rows = log()
    # A far row moves the watermark past every open timer; a last one lets them fire.
    end = rows[-1][1] + 10 * HOUR
    tail = [("z", end, 900, "PRODUCT", None, 0, 1, 1.0, "Z"), ("z", end + 1, 901, "PRODUCT", None, 0, 1, 1.0, "Z")]
    folder = write_files(spark, rows, LEDGER, tmp_path / "in", files)
    write_files(spark, tail[:1], LEDGER, tmp_path / "in", 1)
    write_files(spark, tail[1:], LEDGER, tmp_path / "in", 1)
    stream = st.with_event_time(read_stream(spark, folder, LEDGER), "0 seconds")
    got = run(spark, st.stream_ledger(stream), tmp_path).where("product_id <> 'z'")
    batch = L.ledger(spark.createDataFrame(rows, LEDGER))
    assert found(got.where("kind <> 'STALE'"), *COLS) == found(batch, *COLS)
    expected = timers.stale_events(timers.stale(batch, end)).select("product_id", "ts", "current_inventory")
    stale = got.where("kind = 'STALE'").select("product_id", "ts", "current_inventory")
    assert found(stale, *stale.columns) == found(expected, *stale.columns)


def test_bootstrap_is_initial_state(spark, tmp_path):
    from shelfline.sources.hybrid import initial_state

    catalogue = spark.createDataFrame([("a", "A", 9, 2.0)], "productId STRING, name STRING, inventory INT, price DOUBLE")
    rows = [("a", 10, 0, "ORDER", "o", 4, None, None, None), ("b", 11, 1, "ORDER", "o", 1, None, None, None)]
    folder = write_files(spark, rows, LEDGER, tmp_path / "in", 1)
    stream = st.with_event_time(read_stream(spark, folder, LEDGER), "0 seconds")
    got = run(spark, st.stream_ledger(stream, initial=initial_state(catalogue)), tmp_path)
    assert found(got, "product_id", "previous_inventory", "current_inventory") == [("a", 9, 5)]


@pytest.mark.parametrize("files", [1, 5])
def test_micro_batch_ledger_equals_batch(spark, tmp_path, files):
    rows = log(150, 8)
    folder = write_files(spark, rows, LEDGER, tmp_path / "in", files)
    sinks = {n: out.folder_sink(str(tmp_path / n)) for n in (S.TOPIC_INVENTORY_EVENTS, S.TOPIC_UI_FANOUT, S.TOPIC_INVENTORY_ALERTS)}
    query = jobs.start_inventory(read_stream(spark, folder, LEDGER), sinks, name=f"inventory-{uuid.uuid4().hex}")
    query.awaitTermination()
    entries = L.ledger(spark.createDataFrame(rows, LEDGER))
    for topic, expected in (
        (S.TOPIC_INVENTORY_EVENTS, out.event_messages(L.ledger_events(entries))),
        (S.TOPIC_INVENTORY_ALERTS, out.alert_messages(L.ledger_alerts(entries))),
        (S.TOPIC_UI_FANOUT, out.ui_messages(L.ledger_events(entries))),
    ):
        got = spark.read.parquet(str(tmp_path / topic))
        assert found(got, "key", "value") == found(expected, "key", "value"), topic


def test_state_table_survives_retries_and_compaction(spark, tmp_path):
    rows = log(50, 21)
    state = StateTable(str(tmp_path / "state"), full_every=2)
    seen = []
    for i in range(5):
        batch = spark.createDataFrame(rows[i * 10 : (i + 1) * 10], LEDGER)
        for attempt in range(2):  # every batch runs twice, as after a failure
            entries, now = ledger_step(batch, state.before(spark, i))
            kept = found(entries, *COLS)
            state.write(spark, i, now)
        seen += kept
    assert sorted(seen, key=str) == found(L.ledger(spark.createDataFrame(rows, LEDGER)), *COLS)


def test_first_micro_batch_has_one_exchange_and_no_join(spark, tmp_path):
    batch = spark.createDataFrame(log(50, 4), LEDGER)
    entries, _ = ledger_step(batch, StateTable(str(tmp_path / "state")).before(spark, 0), ("ts", "seq", "order_id"))
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Union" not in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("files", [1, 5])
def test_micro_batches_read_again_give_the_same_ledger(spark, tmp_path, files):
    """Rows that are read from their source each time, in an order of several columns: nothing but the ledger is kept, and it equals the batch form."""
    rows, kept = log(150, 8), []
    folder = write_files(spark, rows, LEDGER, tmp_path / "in", files)

    def outputs(events, alerts, batch_id):
        kept.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        events.write.mode("overwrite").parquet(str(tmp_path / f"events/batch={batch_id}"))

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    handle = ledger_sink(StateTable(str(tmp_path / "state"), full_every=2), outputs, ("ts", "seq", "order_id"), reread=True)
    stream = read_stream(spark, folder, LEDGER).writeStream.foreachBatch(handle).option("checkpointLocation", str(tmp_path / "cp"))
    stream.trigger(availableNow=True).start().awaitTermination()
    want = L.ledger_events(L.ledger(spark.createDataFrame(rows, LEDGER), ("ts", "seq", "order_id")))
    cols = ("product_id", "ts", "seq", "event_type", "previous_inventory", "current_inventory")
    assert found(spark.read.parquet(str(tmp_path / "events")), *cols) == found(want, *cols)
    assert len(kept) == files and max(kept) <= before + 1


def test_view_is_published_whole_after_every_batch(spark, tmp_path):
    schema = "product_id STRING, inventory INT, ts LONG"
    folder = tmp_path / "in"
    for row in [("a", 1, 1), ("b", 5, 2), ("a", 3, 3)]:
        write_files(spark, [row], schema, folder, 1)
    state = StateTable(str(tmp_path / "state"), schema, full_every=2)
    handle = view_sink(state, ["ts"], out.folder_sink(str(tmp_path / "view")))
    query = (
        read_stream(spark, str(folder), schema).writeStream.foreachBatch(handle)
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    views = spark.read.parquet(str(tmp_path / "view"))
    assert found(views, "batch", "product_id", "inventory") == [(0, "a", 1), (1, "a", 1), (1, "b", 5), (2, "a", 3), (2, "b", 5)]


def test_snapshots_equal_batch(spark, tmp_path):
    schema = "product_id STRING, ts LONG, seq LONG, inventory INT"
    # Event time 0 would be behind the first watermark.
    at = 1_000_000
    rows = [("a", at, 0, 5), ("a", at + 700_000, 1, 3), ("a", at + 2_000_000, 2, 9), ("b", at + 400_000, 3, 1)]
    end = at + 5_000_000
    folder = write_files(spark, rows, schema, tmp_path / "in", 1)
    for i in range(2):
        write_files(spark, [("z", end, 9 + i, 0)], schema, tmp_path / "in", 1)
    got = run(spark, st.stream_snapshots(st.with_event_time(read_stream(spark, folder, schema), "0 seconds")), tmp_path)
    batch = timers.snapshots(spark.createDataFrame(rows, schema), end)
    cols = ("product_id", "snapshot_ts", "inventory")
    # A timer fires with the first batch after it is due, and re-arms from there: ticks already
    # passed by a row of the key are all there, later ones come one batch at a time.
    by_rows = "product_id = 'a' AND snapshot_ts < 3000000"
    assert found(got.where(by_rows), *cols) == found(batch.where(by_rows), *cols)
    assert set(found(got.where("product_id <> 'z'"), *cols)) <= set(found(batch, *cols))
    assert got.where("product_id = 'b'").count() > 0


def test_sessions_equal_batch(spark, tmp_path):
    schema = "user_id STRING, ts LONG, seq LONG, product_id STRING"
    rng = random.Random(4)
    rows, ts = [], 0
    for i in range(60):
        ts += rng.choice([60_000, 600_000, 2_000_000])
        rows.append((rng.choice("uv"), ts, i, f"p{i}"))
    tail = [("z", ts + 10 * HOUR, 900, "p"), ("z", ts + 10 * HOUR + 1, 901, "p")]
    folder = write_files(spark, rows, schema, tmp_path / "in", 3)
    for row in tail:
        write_files(spark, [row], schema, tmp_path / "in", 1)
    got = run(spark, st.stream_sessions(st.with_event_time(read_stream(spark, folder, schema), "0 seconds")), tmp_path)
    cols = ("user_id", "session_start", "timeout_ts", "item_count", "duration_ms")
    batch = timers.session_timeouts(spark.createDataFrame(rows, schema))
    assert found(got.where("user_id <> 'z'"), *cols) == found(batch, *cols)
    assert all(r.item_count == len(r["items"]) for r in got.collect())


def test_carts_follow_the_log(spark, tmp_path):
    schema = "cart_id STRING, ts LONG, seq LONG, action STRING, product_id STRING, quantity INT, price_cents LONG"
    rows = [
        ("c", 1, 1, "ADD", "p", 2, 100), ("c", 2, 2, "ADD", "q", 1, 50), ("c", 3, 3, "ADD", "p", 1, 90),
        ("c", 4, 4, "REMOVE", "p", None, None), ("c", 5, 5, "ADD", "p", 3, 10),
    ]
    folder = write_files(spark, rows, schema, tmp_path / "in", 2)
    got = run_until(spark, st.stream_carts(read_stream(spark, folder, schema)), tmp_path, 5)
    from shelfline.operators.carts import cart_totals

    cols = ("cart_id", "ts", "item_count", "total_cents")
    assert found(got, *cols) == found(cart_totals(spark.createDataFrame(rows, schema)), *cols)


def test_orphans_wait_for_their_product(spark, tmp_path):
    rows = [
        ("a", 1, 0, "ORDER", "o1", 2, None, None, None), ("b", 2, 1, "ORDER", "o2", 1, None, None, None),
        ("a", 5, 2, "PRODUCT", None, 0, 9, 1.0, "A"), ("a", 6, 3, "ORDER", "o3", 1, None, None, None),
        ("z", 3 * HOUR, 8, "PRODUCT", None, 0, 9, 1.0, "Z"), ("z", 3 * HOUR + 1, 9, "PRODUCT", None, 0, 9, 1.0, "Z"),
    ]
    folder = tmp_path / "in"
    for row in rows:
        write_files(spark, [row], LEDGER, folder, 1)
    got = run(spark, st.stream_orphans(st.with_event_time(read_stream(spark, str(folder), LEDGER), "0 seconds")), tmp_path)
    got = got.where("product_id <> 'z'")
    assert found(got, "product_id", "kind", "order_id", "expired") == sorted(
        [("a", "PRODUCT", None, False), ("a", "ORDER", "o1", False), ("a", "ORDER", "o3", False), ("b", "ORDER", "o2", True)],
        key=str,
    )
    ledger = L.ledger(got.where("NOT expired").withColumn("seq", F.col("seq") + F.when(F.col("kind") == "ORDER", 10).otherwise(0)))
    assert found(ledger, "order_id", "current_inventory") == sorted([(None, 9), ("o1", 7), ("o3", 6)], key=str)


def test_buffers_and_category_map(spark, tmp_path):
    schema = "room STRING, ts LONG, seq LONG, id STRING"
    rows = [("r", i, i, f"m{i}") for i in range(6)]
    folder = write_files(spark, rows, schema, tmp_path / "a", 3)
    got = run(spark, st.stream_last_n(read_stream(spark, folder, schema), 4), tmp_path / "x")
    assert max((tuple(r.ids) for r in got.collect()), key=lambda ids: ids[-1]) == ("m2", "m3", "m4", "m5")

    schema = "product_id STRING, ts LONG, seq LONG, inventory INT, price DOUBLE, categories ARRAY<STRING>"
    cats = ["Electronics", "Computers", "Gaming"]
    rows = [("LAPTOP", 1, 1, 10, 1.0, cats), ("LAPTOP", 2, 2, 8, 1.0, cats), ("LAPTOP", 3, 3, 5, 1.0, cats[:1])]
    folder = write_files(spark, rows, schema, tmp_path / "b", 2)
    got = run(spark, st.stream_category_sales(read_stream(spark, folder, schema)), tmp_path / "y").orderBy("seq").collect()
    assert got[0].category_sales == dict.fromkeys(cats, 2)
    assert got[1].category_sales == {"Electronics": 5, "Computers": 2, "Gaming": 2}
    batch = running.category_sales(spark.createDataFrame(rows, schema)).where("seq = 3").collect()
    assert [(r.category, r.category_units) for r in batch] == [("Electronics", 5)]


def test_builtin_windows_dedup_and_abandonment(spark, tmp_path):
    schema = "event_id LONG, user_id STRING, category STRING, ts LONG"
    rows = [(1, "u", "c", 1), (1, "u", "c", 1), (2, "u", "c", 60_000), (3, "v", "d", 400_000), (9, "z", "z", 100 * HOUR)]
    folder = write_files(spark, rows, schema, tmp_path / "in", 2)
    base = st.with_event_time(read_stream(spark, folder, schema), "1 minute")
    got = run(spark, st.tumbling_counts(st.deduplicate(base), ["category"]), tmp_path / "t", "append")
    assert found(got, "category", "n") == [("c", 2), ("d", 1)]
    base = st.with_event_time(read_stream(spark, folder, schema), "1 minute")
    got = run(spark, st.session_counts(st.deduplicate(base), ["user_id"]), tmp_path / "s", "append")
    assert found(got, "user_id", "n") == [("u", 2), ("v", 1)]

    def side(name, data):
        path = write_files(spark, data, "user_id STRING, ts LONG", tmp_path / name, 2)
        return st.with_event_time(read_stream(spark, path, "user_id STRING, ts LONG"), "1 minute")

    adds = side("adds", [("u", 1), ("v", 1), ("z", 50 * HOUR), ("z", 100 * HOUR)])
    orders = side("orders", [("u", 1000), ("v", 2 * HOUR), ("y", 50 * HOUR), ("y", 100 * HOUR)])
    got = run(spark, st.abandoned_stream(adds, orders), tmp_path / "ab", "append")
    assert ("v",) in found(got, "user_id") and ("u",) not in found(got, "user_id")


def test_fan_out_writes_each_route_from_one_batch(spark, tmp_path):
    schema = "product_id STRING, n INT"
    folder = write_files(spark, [("a", 1), ("b", 12)], schema, tmp_path / "in", 1)
    routes = {
        "all": (lambda df: df, out.folder_sink(str(tmp_path / "all"))),
        "low": (lambda df: df.where("n < 10"), out.folder_sink(str(tmp_path / "low"))),
    }
    query = (
        read_stream(spark, folder, schema).writeStream.foreachBatch(out.fan_out(routes))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "all")).count() == 2
    assert found(spark.read.parquet(str(tmp_path / "low")), "product_id") == [("a",)]


def test_late_rows_go_to_a_channel_of_their_own(spark, tmp_path):
    """Against a running maximum per file; rows without a time are on time, and nothing is lost or doubled by a repeated batch."""
    schema = "k STRING, ts LONG, n INT"
    files = [[("a", 1000, 1), ("b", 9000, 2)], [("a", 2000, 3), ("b", 7999, 4), ("b", 8000, 5), (None, 20_000, 6)], [("a", None, 7), ("a", 18_999, 8), ("b", 19_000, 9)]]
    folder = str(tmp_path / "in")
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    on, late = (out.folder_sink(str(tmp_path / name)) for name in ("on", "late"))
    split = out.late_split(on, late)

    def twice(batch, batch_id):
        split(batch, batch_id)
        split(batch, batch_id)

    query = st.by_lateness(read_stream(spark, folder, schema), "k", "1 second").writeStream.outputMode("update")
    query.option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(twice).trigger(availableNow=True).start().awaitTermination()
    top, want = 0, []
    for rows in files:
        mark = max(0, top - 1000)
        want += [(n, mark) for _, ts, n in rows if ts is not None and ts < mark]
        top = max([top, *(ts for _, ts, _ in rows if ts is not None)])
    assert sorted((r.n, r.watermark_ms) for r in spark.read.parquet(str(tmp_path / "late")).collect()) == want == [(3, 8000), (4, 8000), (8, 19000)]
    kept = spark.read.parquet(str(tmp_path / "on"))
    assert kept.columns[:3] == ["k", "ts", "n"] and sorted(r.n for r in kept.collect()) == [1, 2, 5, 6, 7, 9]


def test_metrics_are_handed_on_in_full_batches(spark, tmp_path):
    from shelfline.streaming import metrics

    folder = write_files(spark, [(i, "xy"[i % 2]) for i in range(12)], "i INT, event_type STRING", tmp_path / "in", 4)
    written = metrics.table_writer(spark, str(tmp_path / "metrics"))
    listener = metrics.RunMetrics(written, every=3)
    spark.streams.addListener(listener)
    try:
        df = metrics.type_counts(read_stream(spark, folder, "i INT, event_type STRING"), ["x", "y"]).groupBy("event_type").count()
        query = df.writeStream.queryName("counts").outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
        query = query.foreachBatch(lambda batch, i: batch.collect()).trigger(availableNow=True).start()
        query.awaitTermination()
        assert listener.rows(query) == []
    finally:
        spark.streams.removeListener(listener)
    got = spark.read.schema(metrics.METRICS).json(str(tmp_path / "metrics")).where("input_rows > 0").orderBy("batch").collect()
    assert [(r.query, r.batch, r.input_rows, r.state_rows) for r in got] == [("counts", k, 3, 2) for k in range(4)]
    assert sum(int(r.observed["types.x"]) for r in got) == 6


def test_replay_has_every_row_once(spark):
    """Slices of equal values, rows without a value, and no rows at all."""
    from shelfline.plans import streams

    rows = spark.createDataFrame([(None, -1), *((5, i) for i in range(20)), *((i, 100 + i) for i in range(30))], "ts LONG, n INT")
    for df in (rows, rows.limit(0)):
        got = streams.emitted(streams.replayed(df).groupBy("n").count(), "update")
        assert sorted(r.n for r in got.collect()) == sorted(r.n for r in df.collect())
        assert {r["count"] for r in got.collect()} <= {1}


def test_keys_of_a_bucket_share_one_state_and_one_timer(spark, tmp_path, monkeypatch):
    """A state per key makes several calls of the state store for each of them: 60 keys had 60 values and as many timers."""
    monkeypatch.setattr(st, "BUCKETS", 4, raising=False)
    schema = "user_id STRING, ts LONG, seq LONG, product_id STRING"
    rows = [(f"u{k}", 1000 + k, k, "p") for k in range(60)]
    folder = write_files(spark, rows, schema, tmp_path / "in", 1)
    stream = st.stream_sessions(st.with_event_time(read_stream(spark, folder, schema), "0 seconds"))
    writer = stream.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(lambda b, i: b.collect())
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    state = query.recentProgress[0]["stateOperators"][0]
    assert 0 < state["numRowsTotal"] <= 3 * 4  # a value, a timer and its entry by time


def test_keys_that_share_a_bucket_keep_their_own_timers_and_long_lists(spark, tmp_path, monkeypatch):
    """All keys in one bucket, lists of several chunks: sessions and orphans as in batch, every timer due at its own time."""
    from shelfline.streaming import processors as P

    monkeypatch.setattr(st, "BUCKETS", 1)
    monkeypatch.setattr(P, "CHUNK_ITEMS", 3)
    schema = "user_id STRING, ts LONG, seq LONG, product_id STRING"
    rng = random.Random(5)
    rows, ts = [], 0
    for i in range(150):
        ts += rng.choice([60_000, 200_000, 900_000])
        rows.append((rng.choice("uvwx"), ts, i, f"p{i}"))
    folder = write_files(spark, rows, schema, tmp_path / "in", 4)
    for k in range(2):
        write_files(spark, [("z", ts + 10 * HOUR + k, 900 + k, "p")], schema, tmp_path / "in", 1)
    got = run(spark, st.stream_sessions(st.with_event_time(read_stream(spark, folder, schema), "0 seconds")), tmp_path).where("user_id <> 'z'")
    cols = ("user_id", "session_start", "timeout_ts", "item_count", "duration_ms")
    assert found(got, *cols) == found(timers.session_timeouts(spark.createDataFrame(rows, schema)), *cols)
    assert sorted(p for r in got.collect() for p in r["items"]) == sorted(r[3] for r in rows)
    assert max(r.item_count for r in got.collect()) > 6

    orders = [(p, 10 + i, i, "ORDER", f"{p}{i}", 1, None, None, None) for i in range(8) for p in "ab"]
    product = [("a", 100, 50, "PRODUCT", None, 0, 9, 1.0, "A")]
    folder = str(tmp_path / "orphans")
    for part in (orders, product, [("z", 3 * HOUR, 90, "PRODUCT", None, 0, 9, 1.0, "Z")], [("z", 3 * HOUR + 1, 91, "PRODUCT", None, 0, 9, 1.0, "Z")]):
        write_files(spark, part, LEDGER, folder, 1)
    (tmp_path / "o").mkdir()
    got = run(spark, st.stream_orphans(st.with_event_time(read_stream(spark, folder, LEDGER), "0 seconds")), tmp_path / "o").where("kind = 'ORDER'")
    assert found(got, "order_id", "expired") == sorted(((r[4], r[0] == "b") for r in orders), key=str)


class Chunks(dict):
    """Map state by itself."""

    updateValue, getValue, removeKey = dict.__setitem__, dict.__getitem__, dict.__delitem__


def packed_batches(seed, at_most=15):
    """Micro-batches of ledger rows in any order, with equal times, as Arrow tables."""
    import pyarrow as pa

    rng, ts, seq = random.Random(seed), 0, 0
    kinds = {"STRING": pa.string(), "LONG": pa.int64(), "INT": pa.int32(), "DOUBLE": pa.float64()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in LEDGER.split(", ")])
    for _ in range(6):
        rows = []
        for _ in range(rng.randrange(1, at_most)):
            ts, seq, pid = ts + rng.choice([0, 0, 1, 10, 30, 80]), seq + 1, rng.choice("abcde")
            if rng.random() < 0.2:
                rows.append((pid, ts, seq, "PRODUCT", None, 0, rng.randrange(12), rng.choice([5.0, None]), pid.upper()))
            else:
                rows.append((pid, ts, seq, "ORDER", f"o{seq}", rng.randint(0, 5), None, None, None))
        rng.shuffle(rows)
        yield sorted(rows, key=lambda r: r[1:3]), pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)


@pytest.mark.parametrize("seed", range(20))
def test_ledger_of_a_packed_batch_equals_row_by_row(seed):
    """Stock, price and quiet gaps of whole Arrow tables against one row after the other."""
    from shelfline.streaming import processors as P

    ledger, own, known, end = P.LedgerProcessor(50), None, {}, 0
    own = ledger.empty()
    for rows, table in packed_batches(seed):
        want = []
        for pid, ts, seq, kind, _, qty, inventory, price, _ in rows:
            was = known.get(pid)
            if was and not was[3] and ts - was[2] > 50:
                want.append((pid, was[2] + 50, None, "STALE", None, was[0], None, None))
            if kind == "PRODUCT" or was:
                now = (inventory, price) if kind == "PRODUCT" else (max(0, was[0] - qty), was[1])
                known[pid] = (*now, ts, False)
                want.append((pid, ts, seq, kind, was[0] if was else None, now[0], was[1] if was else None, now[1]))
        out, own = ledger.fold(own, table)
        cols = ("product_id", "ts", "seq", "kind", "previous_inventory", "current_inventory", "previous_price", "current_price")
        got = [tuple(r[c] for c in cols) for t in out for r in t.to_pylist()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert ledger.due(own) == min((v[2] + 50 for v in known.values() if not v[3]), default=None)
        end += 90
        out, own = ledger.fire(own, end)
        gone = {k: v for k, v in known.items() if not v[3] and v[2] + 50 <= end}
        assert sorted((r["product_id"], r["ts"], r["current_inventory"]) for t in out for r in t.to_pylist()) == sorted((k, v[2] + 50, v[0]) for k, v in gone.items())
        known |= {k: (*v[:3], True) for k, v in gone.items()}


@pytest.mark.parametrize("seed", range(20))
def test_orphans_of_a_packed_batch_equal_row_by_row(seed, monkeypatch):
    """Orders held, released and given up of whole Arrow tables against one row after the other; lists of several chunks."""
    from shelfline.streaming import processors as P

    monkeypatch.setattr(P, "CHUNK_ITEMS", 2 + seed % 3)
    orphans, known, waits, end = P.OrphanProcessor(60), set(), {}, 0
    orphans.chunks, own = Chunks(), orphans.empty()
    given = lambda out: sorted((r["product_id"], r["ts"], r["seq"], r["kind"], r["expired"]) for t in out for r in t.to_pylist())
    for rows, table in packed_batches(seed):
        want = []
        for pid, ts, seq, kind, *_ in rows:
            if kind != "PRODUCT" and pid not in known:
                waits.setdefault(pid, []).append((ts, seq))
                continue
            want.append((pid, ts, seq, kind, False))
            want += [(pid, max(ts, at), k, "ORDER", False) for at, k in waits.pop(pid, [])]
            known.add(pid)
        out, own = orphans.fold(own, table)
        assert given(out) == sorted(want)
        assert orphans.due(own) == min((v[0][0] + 60 for v in waits.values()), default=None)
        end += 70
        out, own = orphans.fire(own, end)
        gone = [k for k, v in waits.items() if v[0][0] + 60 <= end]
        assert given(out) == sorted((k, at, seq, "ORDER", True) for k in gone for at, seq in waits.pop(k))
    assert bool(orphans.chunks) == bool(own[2])


def test_rows_are_packed_before_the_shuffle_and_late_ones_stay_out(spark, tmp_path):
    """A bucket's rows come to the state as a table, and a row that the watermark had passed gives nothing."""
    first, later = [("a", 1000, 1, "PRODUCT", None, 0, 9, 1.0, "A")], [("a", 90 * HOUR, 2, "ORDER", "o", 1, None, None, None)]
    late = [("a", 2000, 3, "ORDER", "o", 5, None, None, None), ("a", 91 * HOUR, 4, "ORDER", "o", 1, None, None, None)]
    folder = str(tmp_path / "in")
    for k, rows in enumerate((first, later, [("a", 90 * HOUR + 1, 5, "ORDER", "o", 1, None, None, None)], late)):
        spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(folder)
    stream = st.stream_ledger(st.with_event_time(read_stream(spark, folder, LEDGER), "0 seconds"), timeout_ms=1000 * HOUR)
    text = stream._jdf.queryExecution().analyzed().toString()
    assert text.count("MapInArrow") == 2
    got = run(spark, stream, tmp_path).select("seq", "current_inventory").collect()
    assert sorted(map(tuple, got)) == [(1, 9), (2, 8), (4, 6), (5, 7)]
