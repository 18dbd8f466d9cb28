"""Change detection on catalogue updates: what differs from the product's previous row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.keyed import order_by_key
from shelfline.operators.ledger import (
    KEY,
    ledger_alerts,
    ledger_events,
    stock_change,
    stock_change_reason,
)

ORDER = ("ts", "seq")


def with_previous(
    products: DataFrame,
    cols: Sequence[str] = ("inventory", "price", "ts"),
    order: Sequence[str] = ORDER,
    ttl_ms: int | None = None,
    chain: bool = False,
) -> DataFrame:
    """Add `previous_<col>` from the product's previous row.

    With `ttl_ms`, a previous row that is older than that counts as absent, as expired state does.
    """
    keyed = order_by_key(products, [KEY], order, before=1)
    spec = keyed.window()
    wanted = list(dict.fromkeys([*cols, *(["ts"] if ttl_ms is not None else [])]))
    df = keyed.df.select("*", *(F.lag(c).over(spec).alias(f"previous_{c}") for c in wanted))
    if ttl_ms is not None:
        alive = F.col("ts") - F.col("previous_ts") <= ttl_ms
        for c in wanted:
            df = df.withColumn(f"_kept_{c}", F.when(alive, F.col(f"previous_{c}")))
        for c in wanted:
            df = df.drop(f"previous_{c}").withColumnRenamed(f"_kept_{c}", f"previous_{c}")
    return keyed.finish(df, chain)


def track_changes(products: DataFrame, order: Sequence[str] = ORDER, ttl_ms: int | None = None) -> DataFrame:
    """NEW_PRODUCT, SALE, RESTOCK and PRICE_CHANGE rows: none, one or two per update."""
    df = with_previous(products, order=order, ttl_ms=ttl_ms)
    prev, cur = F.col("previous_inventory"), F.col("inventory")
    new = F.col("previous_ts").isNull()
    nothing = F.lit(None)

    def change(kind, prev_inv, cur_inv, delta, prev_price, cur_price, since) -> Column:
        return F.struct(
            kind.alias("change_type"),
            prev_inv.cast("int").alias("previous_inventory"),
            cur_inv.cast("int").alias("current_inventory"),
            delta.cast("int").alias("delta"),
            prev_price.cast("double").alias("previous_price"),
            cur_price.cast("double").alias("current_price"),
            since.cast("long").alias("ms_since_last"),
        )

    since = F.col("ts") - F.col("previous_ts")
    candidates = [
        F.when(new, change(F.lit("NEW_PRODUCT"), F.lit(0), cur, nothing, nothing, nothing, nothing)),
        F.when(
            ~new & (prev != cur),
            change(F.when(cur > prev, "RESTOCK").otherwise("SALE"), prev, cur, cur - prev, nothing, nothing, since),
        ),
        F.when(
            ~new & (F.abs(F.col("price") - F.col("previous_price")) > 0.01),
            change(F.lit("PRICE_CHANGE"), nothing, nothing, nothing, F.col("previous_price"), F.col("price"), nothing),
        ),
    ]
    exploded = df.select(KEY, *order, F.explode(F.array(*candidates)).alias("c"))
    return exploded.where(F.col("c").isNotNull()).select(KEY, *order, "c.*")


def product_entries(products: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Catalogue updates in the shape of ledger rows (no orders in between)."""
    df = with_previous(products, ("inventory", "price"), order)
    return df.select(
        KEY,
        *order,
        *([] if "order_id" in order else [F.lit(None).cast("string").alias("order_id")]),
        F.lit("PRODUCT").alias("kind"),
        F.lit(0).alias("qty"),
        F.col("name").alias("product_name"),
        "previous_inventory",
        F.col("inventory").alias("current_inventory"),
        "previous_price",
        F.col("price").alias("current_price"),
    )


def product_events(products: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Inventory events of a catalogue stream without orders."""
    return ledger_events(product_entries(products, order))


def product_alerts(products: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """The three alert outputs of a catalogue stream without orders, united."""
    return ledger_alerts(product_entries(products, order))


def single_events(products: DataFrame, order: Sequence[str] = ORDER, low_upto: int = 10) -> DataFrame:
    """First form of the state machine: exactly one main event per update, then its alerts.

    A stock change wins over a price change; no change at all is PRODUCT_UPDATED. LOW_STOCK_ALERT
    follows every update with 1..`low_upto` units, SALE_STARTED a price event 10 % or more down.
    """
    df = with_previous(products, order=order)
    prev, cur = F.col("previous_inventory"), F.col("inventory")
    old, price = F.col("previous_price"), F.col("price")
    new = F.col("previous_ts").isNull()
    stock = stock_change(prev, cur)
    step = price - old
    repriced = F.abs(step) > 0.01
    main = (
        F.when(new, "PRODUCT_ADDED").when(stock.isNotNull(), stock).when(repriced, "PRICE_CHANGED").otherwise("PRODUCT_UPDATED")
    )
    reason = (
        F.when(new, F.lit("New product added to catalog"))
        .when(stock.isNotNull(), stock_change_reason(stock, prev, cur))
        .when(
            repriced,
            F.format_string("Price %s by $%.2f", F.when(step > 0, "increased").otherwise("decreased"), F.abs(step)),
        )
        .otherwise("Product metadata updated")
    )
    discount = F.try_divide(old - price, old) * 100

    def event(kind, why, level, before, old_price, new_price, initial, since) -> Column:
        return F.struct(
            kind.alias("event_type"),
            why.alias("change_reason"),
            level.cast("string").alias("alert_level"),
            before.cast("int").alias("previous_inventory"),
            old_price.cast("double").alias("previous_price"),
            new_price.cast("double").alias("current_price"),
            initial.cast("boolean").alias("is_initial_load"),
            since.cast("long").alias("ms_since_last"),
        )

    nothing = F.lit(None)
    candidates = [
        event(
            main, reason, nothing, F.coalesce(prev, F.lit(0)), F.coalesce(old, F.lit(0.0)), price, new,
            F.col("ts") - F.col("previous_ts"),
        ),
        F.when(
            (cur > 0) & (cur <= low_upto),
            event(
                F.lit("LOW_STOCK_ALERT"),
                F.format_string("Low stock warning: only %d items remaining", cur),
                F.when(cur <= 5, "CRITICAL").otherwise("WARNING"),
                nothing, nothing, nothing, nothing, nothing,
            ),
        ),
        F.when(
            ~new & (main == "PRICE_CHANGED") & (price < old) & (discount >= 10),
            event(
                F.lit("SALE_STARTED"),
                F.format_string("%.0f%% OFF - Price dropped from $%.2f to $%.2f", discount, old, price),
                nothing, nothing, nothing, nothing, nothing, nothing,
            ),
        ),
    ]
    kept = [KEY, *order, "name", F.col("inventory").alias("current_inventory")]
    exploded = df.select(*kept, F.explode(F.array(*candidates)).alias("e")).where(F.col("e").isNotNull())
    return exploded.select(KEY, *order, "name", "current_inventory", "e.*")


def once(rows: DataFrame, ids: list[str], order: list[str]) -> DataFrame:
    """Each record once however often it was delivered: of the rows with equal `ids` the last by `order`, and their number `deliveries`."""
    rest = [c for c in rows.columns if c not in ids]
    found = rows.groupBy(*ids).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"), F.count("*").alias("deliveries"))
    return found.select(*ids, "_row.*", "deliveries")
