"""Change logs and values as of a time, row by row."""

import random

from conftest import rows
from pyspark.sql import functions as F

from shelfline.functions import records as R
from shelfline.operators import versions as V

LOG = "k long, ts long, lsn long, op string, row struct<k: long, v: string, n: int>"


def replay(log, base=()):
    """The table after all records, in order of (ts, lsn); deletions and larger rows last."""
    table = {r[0]: r for r in base}
    for k, _, _, op, row in sorted(log, key=lambda r: (r[1], r[2], r[3] == "d", str(r[4]))):
        if op == "d":
            table.pop(k, None)
        else:
            table[k] = row
    return sorted(table.values())


def random_log(n, keys, seed):
    rng = random.Random(seed)
    log = []
    for _ in range(n):
        k, op = rng.choice(keys), rng.choice(["c", "u", "u", "d", "r"])
        log.append((k, rng.randrange(50), rng.randrange(3), op, None if op == "d" else (k, rng.choice("abc"), rng.randrange(9))))
    log += rng.sample(log, n // 3)
    rng.shuffle(log)
    return log


def test_changes_in_any_order(spark):
    """Out of order, repeated, deleted and inserted again, with a hot key, over a base table."""
    log = random_log(400, [1, 1, 1, 1, 2, 3, 4, 5], 1)
    base = [(3, "base", 1), (77, "base", 2)]
    df, table = spark.createDataFrame(log, LOG), spark.createDataFrame(base, "k long, v string, n int")
    got = sorted(map(tuple, V.apply_changes(df, ["k"], ["ts", "lsn"]).collect()))
    assert got == replay(log)
    got = sorted(map(tuple, V.apply_changes(df, ["k"], ["ts", "lsn"], table).collect()))
    assert got == replay(log, base)
    early = [r for r in log if r[1] < 20]
    got = sorted(map(tuple, V.apply_changes(df, ["k"], ["ts", "lsn"], table, F.col("ts") < 20).collect()))
    assert got == replay(early, base)
    assert V.apply_changes(df.limit(0), ["k"], ["ts", "lsn"]).count() == 0
    assert sorted(map(tuple, V.apply_changes(df.limit(0), ["k"], ["ts", "lsn"], table).collect())) == sorted(base)


def test_change_log_texts(spark):
    """Tombstones, other tables, broken text and records without a key."""
    texts = [
        ('{"k": 1}', '{"op": "c", "ts_ms": 5, "source": {"table": "t", "lsn": 9}, "after": {"k": 1, "v": "a"}}', 1),
        ('{"k": 1}', '{"op": "u", "ts_ms": 6, "source": {"table": "t"}, "after": {"k": 1, "v": "b"}}', 1),
        ('{"k": 2}', '{"op": "d", "ts_ms": 7, "source": {"table": "t"}, "before": {"k": 2, "v": "x"}}', 1),
        ('{"k": 3}', None, 8),
        ('{"k": 4}', '{"op": "c", "ts_ms": 5, "source": {"table": "other"}, "after": {"k": 4, "v": "a"}}', 1),
        ('{"k": 5}', "{broken", 1),
        (None, None, 9),
        ('{"k": 6}', '{"op": "t", "ts_ms": 5, "source": {"table": "t"}}', 1),
    ]
    df = spark.createDataFrame(texts, "key string, value string, timestamp long")
    got = [(r.k, r.ts, r.lsn, r.op, r.row and tuple(r.row)) for r in R.change_log(df, "t", "k: BIGINT, v: STRING", "k").collect()]
    assert got == [(1, 5, 9, "c", (1, "a")), (1, 6, 0, "u", (1, "b")), (2, 7, 0, "d", None), (3, 8, 0, "d", None)]


def held(key, ts, versions):
    """The last version of a key at or before a time; of equal times the larger values."""
    known = [v for v in versions if v[0] == key and v[1] is not None and ts is not None and v[1] <= ts]
    return max(known, key=lambda v: (v[1], v[2] is not None, v[2]), default=(None, None, None))[2]


def test_as_of_equals_brute_force(spark, both_ways):
    """With ties, null keys and times, rows before any version, and a hot key, in one piece and in slices."""
    rng = random.Random(2)
    keys = [1, 1, 1, 1, 2, 3, None]
    asked = [(i, rng.choice(keys), rng.choice([*range(40), None])) for i in range(150)]
    versions = [(rng.choice(keys), rng.choice([*range(5, 45), None]), rng.choice([None, 1, 2, 3])) for _ in range(80)]
    df = spark.createDataFrame(asked, "id long, k long, ts long")
    log = spark.createDataFrame(versions, "k long, ts long, price int")
    plain, cut = both_ways(lambda: V.as_of(df, log, ["k"], ["price"]))
    want = sorted(((i, k, held(k, ts, versions), ts) for i, k, ts in asked), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert plain == cut == want
    assert V.as_of(df.limit(0), log, ["k"], ["price"]).count() == 0
    assert [r.price for r in V.as_of(df, log.limit(0), ["k"], ["price"]).collect()] == [None] * len(asked)


def test_as_of_is_one_shuffle(spark):
    """Rows and versions meet in one exchange and one sort, and each side is read once."""
    df = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("ts"), F.col("id").alias("price"))
    plan = V.as_of(df.drop("price"), df, ["k"], ["price"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_rules_hold_from_their_time_on(spark):
    rules = [
        ("a", 1, 10, True, 5.0, None, "x"),
        ("a", 1, 20, True, 50.0, None, "x"),
        ("a", 1, 30, False, None, None, None),
        ("a", 2, 15, True, None, 8.0, "y"),
        ("b", 1, 0, True, None, None, "z"),
    ]
    log = spark.createDataFrame(rules, "cat string, rule_id int, ts long, active boolean, at_least double, below double, output string")
    asked = [(i, "a", ts, v) for i, (ts, v) in enumerate([(5, 9.0), (10, 9.0), (19, 6.0), (20, 9.0), (20, 60.0), (30, 60.0), (16, 7.0)])]
    df = spark.createDataFrame([*asked, (50, "b", 1, 0.0), (51, "c", 99, 1.0), (52, None, 99, 1.0)], "id long, cat string, ts long, value double")
    got = sorted((r.id, r.output) for r in V.rules_as_of(df, log, "cat", "value").collect())
    assert got == [(1, "x"), (2, "x"), (2, "y"), (4, "x"), (6, "x"), (6, "y"), (50, "z")]
    assert rows(V.rules_as_of(df, log.limit(0), "cat", "value")) == []


def sorts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Sort [")


def test_chained_steps_share_a_sort(spark):
    """Steps in the same order of the same key find the rows sorted; all of them once in one shuffle."""
    from shelfline.operators import ledger, metrics, running, timers

    rows = spark.createDataFrame([], "product_id long, ts long, seq long, kind string, qty int, inventory int, price double, name string, order_id string")
    assert sorts(running.sales_total(rows)) == 1
    assert sorts(timers.stale(ledger.ledger(rows, chain=True), 100)) == 1
    levels = spark.createDataFrame([], "product_id long, site string, inventory int, ts long, seq long")
    assert sorts(running.reorder_due(levels, 10, 100)) == 2
    tx = spark.createDataFrame([], "account_id long, ts long, seq long, type string, amount long")
    assert sorts(running.balances(tx, kinds=("in", "out"))) == 1
    events = spark.createDataFrame([], "user_id long, ts long, seq long, event_type string")
    assert sorts(metrics.session_features(events, 10)) <= 2


def test_counts_of_given_kinds_equal_those_by_window(spark, both_ways):
    from shelfline.operators import running

    rng = random.Random(3)
    tx = spark.createDataFrame([(rng.randrange(3), k // 2, k, rng.choice("abc"), rng.randrange(-9, 9)) for k in range(200)], "account_id long, ts long, seq long, type string, amount long")
    named = both_ways(lambda: running.balances(tx, kinds=("a", "b", "c")))
    assert named[0] == named[1] == rows(running.balances(tx))
