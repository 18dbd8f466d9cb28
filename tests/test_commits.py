"""Outputs with a commit point, and orders merged into relational tables."""

import threading

import duckdb
from conftest import rows

from shelfline.sinks import commits, relational

SCHEMA = "k string, n int"


def frame(spark, *found):
    return spark.createDataFrame(list(found), SCHEMA)


def test_only_committed_batches_are_read(spark, tmp_path):
    out = str(tmp_path)
    assert commits.committed(spark, out).count() == 0 and commits.uncommitted(spark, out) == []
    sink = commits.committed_sink(out)
    sink(frame(spark, ("a", 1), ("b", 2)), 0)
    frame(spark, ("lost", 9)).write.parquet(f"{out}/data/1-{'0' * 32}")
    assert rows(commits.committed(spark, out)) == [(0, "a", 1), (0, "b", 2)]
    assert commits.uncommitted(spark, out) == [f"{out}/data/1-{'0' * 32}"]
    sink(frame(spark, ("c", 3)), 1)
    sink(frame(spark, ("other", 4)), 1)  # a batch that is repeated counts once
    sink(frame(spark), 2)
    assert rows(commits.committed(spark, out)) == [(0, "a", 1), (0, "b", 2), (1, "c", 3)]
    assert rows(commits.committed(spark, out, since=1)) == [(1, "c", 3)]
    assert rows(commits.committed(spark, out, until=0)) == [(0, "a", 1), (0, "b", 2)]


def test_partitioned_output(spark, tmp_path):
    commits.committed_sink(str(tmp_path), ("k",))(frame(spark, ("a", 1), ("b", 2), (None, 3)), 5)
    assert rows(commits.committed(spark, str(tmp_path)).select("batch", "k", "n")) == [(5, "a", 1), (5, "b", 2), (5, None, 3)]


def test_one_of_two_writers_wins(spark, tmp_path):
    sink, out = commits.committed_sink(str(tmp_path)), str(tmp_path)
    writers = [threading.Thread(target=sink, args=(frame(spark, (name, 1)), 0)) for name in "xyz"]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert commits.committed(spark, out).count() == 1 and commits.uncommitted(spark, out) == []
    # A writer that has passed the first check meets a name that is taken.
    assert commits._publish(spark, out, f"{0:020d}.json", "{}") is False
    assert commits.committed(spark, out).count() == 1


def test_orders_are_merged_by_the_statements_of_the_sink(spark):
    """The statements run in the SQL engine of the tests; a batch that is repeated changes nothing, a later one sets rows anew."""
    db = duckdb.connect()
    do = lambda text: db.execute(text).fetchall()
    do("CREATE TABLE orders (order_id VARCHAR, customer_id VARCHAR, order_date TIMESTAMP, status VARCHAR, subtotal DECIMAL(12,2), tax DECIMAL(12,2), shipping DECIMAL(12,2), total_amount DECIMAL(12,2))")
    do("CREATE TABLE order_items (order_id VARCHAR, product_id VARCHAR, quantity INT, unit_price DECIMAL(10,2), discount DECIMAL(10,2), line_total DECIMAL(10,2))")
    calls = []

    def write(df, mode, **options):
        found = df.toPandas()
        found["order_id"] = found["order_id"].astype(str)
        db.register("found", found)
        do(f"CREATE OR REPLACE TABLE {options['dbtable']} AS SELECT * FROM found")

    def run(options, statements):
        calls.append(list(statements))
        for text in ("BEGIN", *statements, "COMMIT"):
            do(text)

    def batch(*found):
        return spark.createDataFrame([(i, "u", 1000, s, 1.0, 0.1, 2.0, total) for i, s, total in found], "order_id string, user_id string, ts long, status string, subtotal double, tax double, shipping double, total_amount double")

    def items_of(orders):
        return orders.selectExpr("order_id", "'p' AS product_id", "CAST(total_amount AS INT) AS quantity", "150L AS price_cents", "0L AS discount_cents", "150L AS line_total_cents")

    sink = relational.order_sink({"dbtable": "orders"}, {"dbtable": "order_items"}, items_of, run, write)
    first = batch(("o1", "CONFIRMED", 3.1), ("o2", "REJECTED", 5.0), ("o3", "CONFIRMED", 4.0))
    for _ in range(2):
        sink(first, 0)
        assert do("SELECT order_id, CAST(total_amount AS DOUBLE) FROM orders ORDER BY 1") == [("o1", 3.1), ("o3", 4.0)]
    sink(batch(("o1", "CONFIRMED", 7.0)), 1)
    assert do("SELECT order_id, quantity FROM order_items ORDER BY 1") == [("o1", 7), ("o3", 4)]
    assert do("SELECT count(*) FROM orders") == [(2,)]
    assert {t[0] for t in do("SHOW TABLES")} - {"found"} == {"order_items", "orders"}
    assert all(len(c) == 4 for c in calls)
