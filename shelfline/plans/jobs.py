"""The three end-to-end jobs: inventory with orders, change capture to order events, read model."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline import schemas as S
from shelfline.functions import records as R
from shelfline.operators import ledger as L
from shelfline.operators import views as V
from shelfline.session import shared_dir
from shelfline.sinks import topics as out
from shelfline.sources.hybrid import hybrid
from shelfline.streaming.micro_batches import StateTable, ledger_sink


class InventoryOutputs(NamedTuple):
    products: DataFrame
    events: DataFrame
    alerts: DataFrame
    dead_products: DataFrame
    dead_orders: DataFrame


ORDER = ("phase", "ts", "seq")


def product_rows(products: DataFrame) -> DataFrame:
    """Parsed products as catalogue rows of the ledger.

    Products the event rules reject (no id or name, negative stock or price) do not get there.
    """
    wanted = [c for c in ("phase", "ts", "seq") if c in products.columns]
    good = (F.trim("productId") != "") & (F.trim("name") != "") & (F.col("inventory") >= 0) & (F.col("price") >= 0)
    return products.where(good).select(
        F.col("productId").alias("product_id"), *wanted, "inventory", "price", "name"
    )


def order_rows(orders: DataFrame) -> DataFrame:
    wanted = [c for c in ("phase", "ts", "seq") if c in orders.columns]
    return orders.select(
        F.col("productId").alias("product_id"), *wanted, F.col("orderId").alias("order_id"), F.col("quantity").alias("qty")
    )


def inventory(bootstrap: DataFrame, updates: DataFrame, orders: DataFrame) -> InventoryOutputs:
    """Catalogue file and update texts, then order texts, to products, events and alerts.

    Texts carry `ts` and `seq`; the bootstrap comes before everything else.
    """
    products = R.parse_products(hybrid([bootstrap], updates))
    items = R.parse_order_items(orders.withColumn("phase", F.lit(1)))
    rows = L.tag_streams(product_rows(products.valid), order_rows(items.valid))
    entries = L.ledger(rows, ORDER)
    return InventoryOutputs(
        products.valid, L.ledger_events(entries), L.ledger_alerts(entries), products.dead, items.dead
    )


def ledger_stream(updates: DataFrame, orders: DataFrame) -> DataFrame:
    """Update and order texts of two streams as one tagged stream of ledger rows."""
    products = product_rows(R.parse_products(updates).valid)
    items = order_rows(R.parse_order_items(orders).valid)
    return L.tag_streams(products, items)


def start_inventory(rows: DataFrame, sinks: dict[str, out.Sink], name: str = "inventory", **trigger) -> StreamingQuery:
    """Run the ledger on a stream of tagged rows, with its state and checkpoint in the shared folder."""
    root = f"{shared_dir(rows.sparkSession)}/{name}"
    handle = ledger_sink(StateTable(f"{root}/state"), out.inventory_outputs(sinks))
    writer = rows.writeStream.queryName(name).option("checkpointLocation", f"{root}/checkpoint").foreachBatch(handle)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def order_events(changes: DataFrame) -> DataFrame:
    """Change records to order-event messages; no shuffle. Repeats of a line keep its id for dedup."""
    return out.order_messages(R.cdc_order_items(changes))


def product_view(products: DataFrame, inventory_events: DataFrame) -> DataFrame:
    """The read model: full products with the partial updates of inventory-event texts merged in."""
    full = products.select(F.col("productId").alias("product_id"), *[c for c in products.columns if c != "productId"])
    return V.merge_partial(full, R.partial_products(inventory_events))


def topic_sinks(config) -> dict[str, out.Sink]:
    names = (S.TOPIC_INVENTORY_EVENTS, S.TOPIC_UI_FANOUT, S.TOPIC_INVENTORY_ALERTS)
    return {n: out.topic_sink(config, n) for n in names}
