"""Carts folded from their action log, checkout and order arithmetic. Money is in cents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.keyed import order_by_key, running
from shelfline.schemas import EMPTY_CART, FREE_SHIPPING_OVER, MISSING_SESSION, NO_CART, SHIPPING, TAX_RATE

ORDER = ("ts", "seq")
LINE = ("cart_id", "product_id")


def fold_cart(actions: DataFrame, mode: str = "append", order: Sequence[str] = ORDER) -> DataFrame:
    """The lines left in every cart: `cart_id, product_id, quantity, price_cents, line_cents, lines`; the price is the first line's.

    `append`: every ADD is a line of its own, UPDATE_QUANTITY changes the first of them.
    `upsert`: an ADD of a product already there only sets its quantity; the old price stays.
    REMOVE drops the product's lines, CLEAR all lines, and actions on absent lines do nothing.
    """
    if mode not in ("append", "upsert"):
        raise ValueError(f"unknown cart mode {mode!r}")
    at = F.struct(*order)
    is_add = F.col("action") == "ADD"
    live = _since_reset(actions, order).where(F.col("action").isin("ADD", "UPDATE_QUANTITY"))
    sets = F.lit(True) if mode == "upsert" else ~is_add
    amount = F.col("price_cents") * F.col("quantity")
    folded = (
        live.groupBy(*LINE)
        .agg(
            F.min(F.when(is_add, at)).alias("_first"),
            F.min_by("price_cents", F.when(is_add, at)).alias("_price"),
            F.min_by("quantity", F.when(is_add, at)).alias("_first_quantity"),
            F.sum(F.when(is_add, F.col("quantity"))).alias("_quantity"),
            F.sum(F.when(is_add, amount)).alias("_cents"),
            F.count_if(is_add).alias("lines"),
            F.max(F.when(sets, at)).alias("_last"),
            F.max_by("quantity", F.when(sets, at)).alias("_last_quantity"),
        )
        .where(F.col("_first").isNotNull())
        # A quantity set before there was a line had no line to change.
        .withColumn("_set", F.when(F.col("_last") > F.col("_first"), F.col("_last_quantity")))
    )
    first = F.coalesce("_set", "_first_quantity")
    if mode == "upsert":
        return folded.select(
            *LINE,
            first.cast("long").alias("quantity"),
            F.col("_price").alias("price_cents"),
            (first * F.col("_price")).alias("line_cents"),
            F.lit(1).cast("long").alias("lines"),
        )
    change = first - F.col("_first_quantity")
    return folded.select(
        *LINE,
        (F.col("_quantity") + change).alias("quantity"),
        F.col("_price").alias("price_cents"),
        (F.col("_cents") + change * F.col("_price")).alias("line_cents"),
        "lines",
    )


def _since_reset(actions: DataFrame, order: Sequence[str]) -> DataFrame:
    """Actions with no later CLEAR of their cart and no later REMOVE of their product.

    Read backwards these are the rows ahead of the first reset; one shuffle on the cart serves both
    tests and the grouping after them.
    """
    back = [f"_back_{c}" for c in order]
    reversed_ = actions.select("*", *((-F.col(c)).alias(b) for c, b in zip(order, back)))
    keyed = order_by_key(reversed_, ["cart_id"], back)
    one = F.lit(1)
    df = running(keyed, keyed.df, {"_clears": ("count", F.when(F.col("action") == "CLEAR", one))})
    df = running(
        keyed, df, {"_removes": ("count", F.when(F.col("action") == "REMOVE", one))}, within=["product_id"]
    )
    fresh = (F.coalesce("_clears", F.lit(0)) == 0) & (F.coalesce("_removes", F.lit(0)) == 0)
    return keyed.finish(df.where(fresh)).drop("_clears", "_removes", *back)


def cart_summary(lines: DataFrame) -> DataFrame:
    """Item count and total of every cart."""
    return lines.groupBy("cart_id").agg(
        F.sum("quantity").alias("item_count"),
        F.sum("line_cents").alias("total_cents"),
        F.sum("lines").alias("lines"),
    )


def cart_totals(actions: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Item count and total of the cart after every ADD and REMOVE.

    A REMOVE takes off what its product gained since the REMOVE before it: the running amount now
    less the running amount then.
    """
    log = actions.where(F.col("action").isin("ADD", "REMOVE"))
    keyed = order_by_key(log, ["cart_id"], order)
    is_add = F.col("action") == "ADD"
    cents = F.when(is_add, F.col("price_cents") * F.col("quantity")).otherwise(F.lit(0)).cast("long")
    units = F.when(is_add, F.col("quantity")).otherwise(F.lit(0)).cast("long")
    product = ["product_id"]
    # Dealt by cart, the windows over (cart, product) and those over the cart need no second shuffle.
    rows = keyed.df if keyed.sliced else keyed.df.repartition("cart_id")
    df = running(keyed, rows, {"_cents": ("sum", cents), "_units": ("sum", units)}, within=product)
    df = running(
        keyed,
        df,
        {
            "_gone_cents": ("max", F.when(~is_add, F.col("_cents"))),
            "_gone_units": ("max", F.when(~is_add, F.col("_units"))),
        },
        within=product,
        strict=True,
    )
    zero = F.lit(0)
    d_cents = F.when(is_add, cents).otherwise(F.coalesce("_gone_cents", zero) - F.col("_cents"))
    d_units = F.when(is_add, units).otherwise(F.coalesce("_gone_units", zero) - F.col("_units"))
    df = running(keyed, df, {"total_cents": ("sum", d_cents), "item_count": ("sum", d_units)})
    return keyed.finish(df).drop("_cents", "_units", "_gone_cents", "_gone_units")


def capped_adds(adds: DataFrame, stock: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Quantity in the cart after each add, never above the stock; adds at the cap are dropped."""
    keyed = order_by_key(adds, list(LINE), order)
    df = running(keyed, keyed.df, {"_wanted": ("sum", F.col("quantity").cast("long"))})
    joined = keyed.finish(df).join(stock.select("product_id", "inventory"), "product_id", "left")
    available = F.coalesce("inventory", F.lit(0)).cast("long")
    held = F.least(F.col("_wanted") - F.col("quantity"), available)
    new = F.least("_wanted", available)
    first = F.col("_wanted") == F.col("quantity")
    return (
        joined.withColumn("held", held)
        .withColumn("final_quantity", new)
        .where(first | (F.col("final_quantity") > F.col("held")))
        .drop("_wanted", "inventory", "held")
    )


def shipping_fee(subtotal: Column, free_over: float | None = None) -> Column:
    """The flat fee; free above `free_over` where that is given (the basket page's estimate)."""
    fee = F.lit(SHIPPING).cast("decimal(10,2)")
    if free_over is None:
        return fee
    return F.when(subtotal > F.lit(free_over), F.lit(0).cast("decimal(10,2)")).otherwise(fee)


def price_order(df: DataFrame, subtotal_cents: str = "total_cents", tax: str = TAX_RATE, free_over: float | None = None) -> DataFrame:
    """Add subtotal, tax, shipping and total as decimals."""
    money = "decimal(12,2)"
    subtotal = (F.col(subtotal_cents).cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast(money)
    df = df.withColumn("subtotal", subtotal)
    df = df.withColumn("tax", (F.col("subtotal") * F.lit(tax).cast("decimal(4,2)")).cast(money))
    df = df.withColumn("shipping", shipping_fee(F.col("subtotal"), free_over))
    return df.withColumn("total_amount", (F.col("subtotal") + F.col("tax") + F.col("shipping")).cast(money))


def estimate(summary: DataFrame) -> DataFrame:
    """The basket page's estimate, with free shipping above the limit."""
    return price_order(summary, free_over=FREE_SHIPPING_OVER)


def checkout(requests: DataFrame, lines: DataFrame, actions: DataFrame | None = None, tax: str = TAX_RATE) -> DataFrame:
    """Checkout requests (`session_id`, `user_id`) priced from their carts' `lines`; rejects say why.

    A cart exists once it has had an action, also when it has no line left; `actions` tells which carts do. Without it only carts
    with lines are known. The request's `status` is CONFIRMED or REJECTED.
    """
    carts = cart_summary(lines).withColumnRenamed("cart_id", "session_id").withColumn("_cart", F.lit(True))
    joined = requests.join(carts, "session_id", "left")
    if actions is not None:
        used = actions.select(F.col("cart_id").alias("session_id")).distinct().withColumn("_used", F.lit(True))
        joined = joined.join(used, "session_id", "left").withColumn("_cart", F.coalesce("_cart", "_used")).drop("_used")
    blank = F.col("session_id").isNull() | (F.trim(F.col("session_id").cast("string")) == "")
    reason = (
        F.when(blank, MISSING_SESSION).when(F.col("_cart").isNull(), NO_CART).when(F.coalesce("lines", F.lit(0)) == 0, EMPTY_CART)
    )
    priced = price_order(joined.withColumn("reject_reason", reason), tax=tax)
    ok = F.col("reject_reason").isNull()
    return priced.select(
        *[c for c in requests.columns if c != "user_id"],
        F.coalesce(F.col("user_id").cast("string"), F.lit("guest")).alias("user_id"),
        F.when(ok, "CONFIRMED").otherwise("REJECTED").alias("status"),
        "reject_reason",
        *(F.when(ok, F.col(c)).alias(c) for c in ("item_count", "subtotal", "tax", "shipping", "total_amount")),
    )


def checkouts(log: DataFrame, mode: str = "upsert", order: Sequence[str] = ORDER) -> DataFrame:
    """The CHECKOUT actions of an action log, each with the cart as it is then: `cart_id, *order, reject_reason, item_count, total_cents, lines`.

    A checkout that succeeds ends the cart: the next action starts a new one. A rejected one leaves the cart as it is, and an
    empty cart stays empty, so what a checkout sees are the actions since the checkout before it.
    """
    is_checkout = F.col("action") == "CHECKOUT"
    keyed = order_by_key(log, ["cart_id"], order)
    cut = keyed.finish(running(keyed, keyed.df, {"_epoch": ("count", F.when(is_checkout, 1))}, strict=True))
    cut = cut.withColumn("_epoch", F.coalesce("_epoch", F.lit(0))).withColumn("_cart", F.struct("cart_id", "_epoch"))
    actions = cut.where(~is_checkout).drop("cart_id").withColumnRenamed("_cart", "cart_id")
    carts = cart_summary(fold_cart(actions, mode, order)).select(F.col("cart_id").alias("_cart"), "item_count", "total_cents", "lines")
    acted = actions.select(F.col("cart_id").alias("_cart")).distinct().withColumn("_acted", F.lit(True))
    seen = cut.where(is_checkout).join(carts, "_cart", "left").join(acted, "_cart", "left")
    before = order_by_key(seen, ["cart_id"], order)
    epoch = F.col("_epoch")
    # A cart exists if it has had an action since the last checkout that succeeded.
    last = running(before, before.df, {"_sold": ("max", F.when(F.col("lines") > 0, epoch))}, strict=True)
    last = before.finish(running(before, last, {"_used": ("max", F.when(F.col("_acted"), epoch))}))
    exists = F.coalesce("_used", F.lit(-1)) > F.coalesce("_sold", F.lit(-1))
    reason = F.when(~exists, NO_CART).when(F.coalesce("lines", F.lit(0)) == 0, EMPTY_CART)
    return last.select("cart_id", *order, reason.alias("reject_reason"), "item_count", "total_cents", "lines")


def order_lines(lines: DataFrame) -> DataFrame:
    """Relational order lines of cart lines: line total from price and quantity, no discount."""
    return lines.select(
        "*", (F.col("price_cents") * F.col("quantity")).alias("line_total_cents"), F.lit(0).alias("discount_cents")
    )


def item_events(orders: DataFrame, items: str = "items") -> DataFrame:
    """One order-item event per cart line of the orders that do not go through change capture."""
    return orders.where(~F.col("use_cdc")).select(
        "order_id", F.explode(items).alias("_i"), F.col("ts").alias("timestamp")
    ).select("order_id", F.col("_i.product_id").alias("product_id"), F.col("_i.quantity").alias("quantity"), "timestamp")


def available(on_hand: Column, reserved: Column) -> Column:
    """Stock that can still be sold; 0 when either figure is missing."""
    return F.coalesce(on_hand - reserved, F.lit(0))


def basket_context(lines: DataFrame) -> DataFrame:
    """Basket size and value for the assistant: the sum of prices, quantities left out."""
    return lines.groupBy("cart_id").agg(
        F.count("*").alias("basket_size"), F.sum("price_cents").alias("basket_value_cents")
    )
