"""Whole jobs over JSON texts and streams of the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfline.operators import ledger as L
from shelfline.plans import jobs
from shelfline.plans import tables as t
from shelfline.plans.inventory import LEDGER
from shelfline.plans.registry import query
from shelfline.session import shared_dir
from shelfline.streaming import stateful as st
from shelfline.streaming.micro_batches import StateTable, ledger_sink, write_slices

SEQ = "(l_orderkey * 8 + l_linenumber) * 100000 + l_suppkey"


def texts(spark, folder):
    """Bootstrap texts from the catalogue, update and order texts from the lines."""
    part = t.table(spark, folder, "part")
    product = lambda key, name, price, stock: F.to_json(
        F.struct(
            key.cast("string").alias("productId"), name.alias("name"), price.alias("price"), stock.alias("inventory")
        )
    )
    bootstrap = part.select(
        product(F.col("p_partkey"), F.col("p_name"), F.col("p_retailprice"), F.col("p_size")).alias("value")
    )
    lines = t.table(spark, folder, "lineitem")
    units = F.col("l_quantity").cast("int")
    stamp = [t.millis("l_shipdate").alias("ts"), F.expr(SEQ).alias("seq")]
    updates = lines.where("l_returnflag = 'R'").select(
        product(F.col("l_partkey"), F.lit("update"), F.col("l_extendedprice") / F.col("l_quantity"), units).alias("value"), *stamp
    )
    orders = lines.where("l_returnflag <> 'R'").select(
        F.to_json(
            F.struct(
                F.col("l_orderkey").cast("string").alias("orderId"), F.col("l_partkey").cast("string").alias("productId"),
                units.alias("quantity"),
            )
        ).alias("value"),
        *stamp,
    )
    return bootstrap, updates, orders


@query(
    "inventory_job",
    f"""WITH r AS (
  SELECT p_partkey AS product_id, 0 AS phase, 0::BIGINT AS ts, 0::BIGINT AS seq, 'PRODUCT' AS kind, 0 AS qty, p_size AS inventory,
         p_retailprice AS price FROM part
  UNION ALL SELECT l_partkey, 1, epoch_ms(l_shipdate), {SEQ}, CASE WHEN l_returnflag = 'R' THEN 'PRODUCT' ELSE 'ORDER' END,
         CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS INT) END, CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INT) END,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice / l_quantity END FROM lineitem),
e AS (SELECT *, count(*) FILTER (WHERE kind = 'PRODUCT') OVER (PARTITION BY product_id ORDER BY phase, ts, seq ROWS UNBOUNDED PRECEDING) AS epoch FROM r),
f AS (SELECT *, first_value(inventory) OVER w AS base, first_value(price) OVER w AS cur_price, sum(qty) OVER w AS cum FROM e WHERE epoch > 0
      WINDOW w AS (PARTITION BY product_id, epoch ORDER BY phase, ts, seq ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, CAST(greatest(0, base - cum) AS INT) AS cur FROM f),
l AS (SELECT *, CASE WHEN kind = 'ORDER' THEN CAST(greatest(0, base - (cum - qty)) AS INT) ELSE lag(cur) OVER p END AS prev,
             CASE WHEN kind = 'ORDER' THEN cur_price ELSE lag(cur_price) OVER p END AS prev_price
      FROM s WINDOW p AS (PARTITION BY product_id ORDER BY phase, ts, seq))
SELECT CAST(product_id AS VARCHAR) AS product_id, phase, ts, seq, 'PRODUCT_ADDED' AS event_type, 0 AS previous_inventory, cur AS current_inventory FROM l
WHERE kind = 'PRODUCT' AND prev IS NULL
UNION ALL SELECT CAST(product_id AS VARCHAR), phase, ts, seq, CASE WHEN cur = 0 THEN 'OUT_OF_STOCK' WHEN prev = 0 THEN 'BACK_IN_STOCK'
  WHEN cur < prev THEN 'INVENTORY_DECREASED' ELSE 'INVENTORY_INCREASED' END, prev, cur FROM l WHERE kind = 'PRODUCT' AND prev <> cur
UNION ALL SELECT CAST(product_id AS VARCHAR), phase, ts, seq, 'PRICE_CHANGED', prev, cur FROM l WHERE kind = 'PRODUCT' AND abs(prev_price - cur_price) > 0.01
UNION ALL SELECT CAST(product_id AS VARCHAR), phase, ts, seq, 'INVENTORY_DECREASED', prev, cur FROM l WHERE kind = 'ORDER'""",
)
def inventory_job(spark, folder):
    out = jobs.inventory(*texts(spark, folder))
    return out.events.select(
        "product_id", "phase", "ts", "seq", "event_type", "previous_inventory", "current_inventory"
    )


@query(
    "read_model_job",
    LEDGER + f""",
said AS (SELECT * FROM ledger WHERE kind = 'ORDER' OR (previous_inventory IS NOT NULL AND (previous_inventory <> current_inventory OR abs(current_price - previous_price) > 0.01))),
last AS (SELECT * FROM said QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY {", ".join(c + " DESC" for c in t.LINE_ORDER)}) = 1)
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, coalesce(current_inventory, p_size) AS inventory,
       coalesce(current_price, p_retailprice) AS price FROM part LEFT JOIN last ON product_id = p_partkey""",
)
def read_model_job(spark, folder):
    """The catalogue with the events of the ledger merged in, as texts from the events topic."""
    full = t.table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("productId"), F.col("p_name").alias("name"), F.col("p_size").alias("inventory"),
        F.col("p_retailprice").alias("price"), F.lit(0).cast("long").alias("ts"),
        F.struct(*(F.lit(None).cast(c).alias(n) for n, c in zip(t.LINE_ORDER[1:], ("long", "int", "long", "double")))).alias("seq"),
    )
    events = L.ledger_events(L.ledger(t.ledger_rows(spark, folder), t.LINE_ORDER)).select(
        "ts",
        F.struct(*t.LINE_ORDER[1:]).alias("seq"),
        F.to_json(
            F.struct(
                F.col("event_type").alias("eventType"), F.col("product_id").cast("string").alias("productId"),
                F.col("current_inventory").alias("currentInventory"), F.col("current_price").alias("currentPrice"),
            )
        ).alias("value"),
    )
    return jobs.product_view(full, events).select("product_id", "name", "inventory", "price")


def stream_table(spark, folder, name):
    """One of the given tables as a stream of its files; the pattern serves a single file and a folder."""
    return spark.readStream.schema(t.table(spark, folder, name).schema).parquet(f"{folder}/{name}.parquet*")


def new_root(spark) -> str:
    return f"{shared_dir(spark)}/queries/{uuid.uuid4().hex}"


@query(
    "stream_inventory_events",
    LEDGER + """
SELECT product_id, ts, order_id, line_no, 'PRODUCT_ADDED' AS event_type, 0 AS previous_inventory, current_inventory FROM ledger
WHERE kind = 'PRODUCT' AND previous_inventory IS NULL
UNION ALL SELECT product_id, ts, order_id, line_no, CASE WHEN current_inventory = 0 THEN 'OUT_OF_STOCK' WHEN previous_inventory = 0 THEN 'BACK_IN_STOCK'
  WHEN current_inventory < previous_inventory THEN 'INVENTORY_DECREASED' ELSE 'INVENTORY_INCREASED' END, previous_inventory, current_inventory
FROM ledger WHERE kind = 'PRODUCT' AND previous_inventory <> current_inventory
UNION ALL SELECT product_id, ts, order_id, line_no, 'PRICE_CHANGED', previous_inventory, current_inventory FROM ledger
WHERE kind = 'PRODUCT' AND abs(previous_price - current_price) > 0.01
UNION ALL SELECT product_id, ts, order_id, line_no, 'INVENTORY_DECREASED', previous_inventory, current_inventory FROM ledger WHERE kind = 'ORDER'""",
)
def stream_inventory_events(spark, folder):
    """The ledger on a stream of the lines, micro-batch by micro-batch, with stored state."""
    root = new_root(spark)
    rows = t.as_ledger_rows(stream_table(spark, folder, "lineitem"))
    state = StateTable(f"{root}/state", "product_id BIGINT, inventory INT, price DOUBLE, name STRING, ts BIGINT")

    def outputs(events, alerts, batch_id):
        write_slices(root, {"events": events, "alerts": alerts}, batch_id)

    handle = ledger_sink(state, outputs, t.LINE_ORDER, reread=True)
    stream = rows.writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(handle)
    stream.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/events").select(
        "product_id", "ts", "order_id", "line_no", "event_type", "previous_inventory", "current_inventory"
    )


@query("stream_event_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_event_counts(spark, folder):
    """Counters over a stream in which every event comes twice, as after a retry."""
    root = new_root(spark)
    events = stream_table(spark, folder, "events").select("event_id", "event_type", t.millis("ts").alias("ts"))
    twice = events.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    unique = st.deduplicate(st.with_event_time(twice, "1 day"), ["event_id"])

    def keep(batch, batch_id):
        # Append-only counts per batch: replays overwrite their own, readers add them up.
        batch.groupBy("event_type").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{root}/counts/batch={batch_id}")

    stream = unique.writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(keep)
    stream.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/counts").groupBy("event_type").agg(F.sum("n").alias("n"))
