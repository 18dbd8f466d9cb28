"""Stock per product under two interleaved inputs: catalogue rows set it, order rows lower it.

Between two catalogue rows orders only subtract, so the stock after a row is
`max(0, stock set last - quantity ordered since)`. That is a running sum and a carried value:
window expressions in one shuffle and one sort, no loop over rows.

Input rows: `product_id`, `kind` ('PRODUCT' or 'ORDER'), `qty` (orders), `inventory`, `price`,
`name` (catalogue rows), and the order columns. Negative inventories and quantities below one must
have been rejected by the parsers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.operators.keyed import HALO, SLICE, Keyed, order_by_key
from shelfline.schemas import LOW_STOCK_BELOW, ORDER_LOW_STOCK_UPTO

KEY = "product_id"


def is_product() -> Column:
    return F.col("kind") == "PRODUCT"


def tag_streams(products: DataFrame, orders: DataFrame) -> DataFrame:
    """One stream from two, tagged by `kind`: the co-group of catalogue rows and order rows."""
    return products.withColumn("kind", F.lit("PRODUCT")).unionByName(
        orders.withColumn("kind", F.lit("ORDER")), allowMissingColumns=True
    )


def ledger(rows: DataFrame, order: Sequence[str] = ("ts", "seq"), chain: bool = False) -> DataFrame:
    """Every row of a known product with the stock and price before and after it; `chain` as in `Keyed.finish`.

    Orders that come before the first catalogue row of their product are left out; see
    `orders_before_product`.
    """
    keyed = order_by_key(rows, [KEY], order)
    if keyed.sliced:
        keyed = _with_opening_stock(keyed)
    out = _replay(keyed)
    return keyed.finish(out.where(F.col("base").isNotNull()), chain).drop("base", "ordered")


def orders_before_product(rows: DataFrame, order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """Order rows whose product was not known yet."""
    first = (
        rows.where(is_product())
        .groupBy(KEY)
        .agg(F.min(F.struct(*order)).alias("_known_from"))
    )
    orders = rows.where(~is_product())
    return (
        orders.join(first, KEY, "left")
        .where(F.col("_known_from").isNull() | (F.struct(*order) < F.col("_known_from")))
        .drop("_known_from")
    )


def _at_least_zero(stock: Column) -> Column:
    """`stock` clamped at zero; null stays null, which `greatest` alone would turn into zero."""
    return F.when(stock.isNotNull(), F.greatest(F.lit(0), stock)).cast("int")


def _replay(keyed: Keyed) -> DataFrame:
    spec = keyed.window()
    so_far = spec.rowsBetween(Window.unboundedPreceding, 0)
    qty = F.coalesce(F.col("qty"), F.lit(0)).cast("long")
    df = keyed.df.withColumn("ordered", F.sum(F.when(~is_product(), qty).otherwise(0)).over(so_far))

    def last_set(value: Column) -> Column:
        return F.last(F.when(is_product(), value), ignorenulls=True).over(so_far)

    # Plain columns, not one struct: Spark keeps their running values in place. A missing price is 0,
    # as the parsers have it; a missing name comes back as null.
    df = df.select(
        "*",
        last_set(F.coalesce(F.col("inventory").cast("long"), F.lit(0))).alias("base"),
        last_set(F.coalesce(F.col("price"), F.lit(0.0))).alias("current_price"),
        last_set(F.coalesce(F.col("name"), F.lit(""))).alias("_name"),
        last_set(F.col("ordered")).alias("_ordered_then"),
    )
    since = F.col("ordered") - F.col("_ordered_then")
    df = df.select(
        "*",
        _at_least_zero(F.col("base") - since).alias("current_inventory"),
        _at_least_zero(F.col("base") - since + qty).alias("_before_order"),
        F.nullif("_name", F.lit("")).alias("product_name"),
    ).drop("_name", "_ordered_then")
    df = df.select(
        "*",
        F.lag("current_inventory").over(spec).alias("_lag_inventory"),
        F.lag("current_price").over(spec).alias("_lag_price"),
    )
    return df.select(
        "*",
        F.when(is_product(), F.col("_lag_inventory")).otherwise(F.col("_before_order")).alias("previous_inventory"),
        F.when(is_product(), F.col("_lag_price")).otherwise(F.col("current_price")).alias("previous_price"),
    ).drop("_before_order", "_lag_inventory", "_lag_price")


def _with_opening_stock(keyed: Keyed) -> Keyed:
    """Give every slice of a hot product its opening stock as a catalogue row ahead of its rows.

    A slice acts on the stock as two ledger rows would: an order for all it sold before its first
    catalogue row, then a catalogue row with its closing stock. Replaying those two rows per slice
    gives the closing stock of each slice.
    """
    order = keyed.order
    inside = _replay(keyed.with_df(keyed.df.where(F.col(SLICE).isNotNull())))
    end = F.struct("current_inventory", "current_price", "product_name")
    per_slice = inside.groupBy(KEY, SLICE).agg(
        F.sum(F.when(F.col("base").isNull(), F.col("qty")).otherwise(0)).alias("qty"),
        F.max_by(F.when(F.col("base").isNotNull(), end), F.struct(*order)).alias("end"),
    )
    summary = per_slice.select(
        KEY,
        SLICE,
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("step"), F.lit("ORDER").alias("kind"), F.col("qty").alias("qty"),
                         F.lit(None).cast("int").alias("inventory"), F.lit(None).cast("double").alias("price"),
                         F.lit(None).cast("string").alias("name")),
                F.struct(F.lit(1).alias("step"), F.lit("PRODUCT").alias("kind"), F.lit(0).cast("long").alias("qty"),
                         F.col("end.current_inventory").alias("inventory"),
                         F.col("end.current_price").cast("double").alias("price"),
                         F.col("end.product_name").alias("name")),
            )
        ).alias("r"),
    ).select(KEY, SLICE, "r.*").where((F.col("kind") == "ORDER") | F.col("inventory").isNotNull())
    closing = (
        _replay(Keyed(summary, (KEY,), (SLICE, "step")))
        .groupBy(KEY, SLICE)
        .agg(F.max_by(F.struct("base", "current_inventory", "current_price", "product_name"), "step").alias("s"))
        .where(F.col("s.base").isNotNull())
        .select(
            KEY,
            (F.col(SLICE) + 1).alias(SLICE),
            F.lit(True).alias(HALO),
            F.lit("PRODUCT").alias("kind"),
            F.col("s.current_inventory").alias("inventory"),
            F.col("s.current_price").alias("price"),
            F.col("s.product_name").alias("name"),
        )
    )
    # Halo rows have null order columns and so sort ahead of every row of their slice.
    opened = keyed.df.unionByName(closing, allowMissingColumns=True)
    return keyed.with_df(opened)


# ---------------------------------------------------------------------------------------------
# Events and alerts of the two-input state machine
# ---------------------------------------------------------------------------------------------

def first_seen() -> Column:
    return is_product() & F.col("previous_inventory").isNull()


def price_step() -> Column:
    return F.col("current_price") - F.col("previous_price")


def price_changed() -> Column:
    return is_product() & F.col("previous_price").isNotNull() & (F.abs(price_step()) > 0.01)


def price_percent() -> Column:
    """Change in percent; null (hence no price-drop alert) when the previous price is zero."""
    return F.try_divide(price_step(), F.col("previous_price")) * 100


def whole_cents(price: str) -> Column:
    return F.round(F.col(price) * 100).cast("long")


def dollars(cents: Column) -> Column:
    """Whole cents as text, made of integers: formatting doubles differs between engines in the last digit."""
    return F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def _cents_step() -> Column:
    return F.abs(whole_cents("current_price") - whole_cents("previous_price"))


def _percent_text() -> Column:
    """The change in percent to one digit, without a sign; null when the previous price has no cents."""
    base = whole_cents("previous_price")
    tenths = F.floor(F.try_divide(_cents_step() * 2000 + base, base * 2))
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def stock_change(before: Column, after: Column) -> Column:
    """Name of a stock change on a catalogue row; null when nothing changed."""
    return (
        F.when(before == after, F.lit(None).cast("string"))
        .when(after == 0, "OUT_OF_STOCK")
        .when(before == 0, "BACK_IN_STOCK")
        .when(after < before, "INVENTORY_DECREASED")
        .otherwise("INVENTORY_INCREASED")
    )


def number_text(n: Column) -> Column:
    """A whole number in a text, as `%d` writes it, null too: `format_string` reads its format anew for every row."""
    return F.coalesce(n.cast("string"), F.lit("null"))


def stock_change_reason(change: Column, before: Column, after: Column) -> Column:
    # The texts of the message contract, here and in the events and alerts below.
    return (
        F.when(change == "OUT_OF_STOCK", F.lit("Product is now out of stock"))
        .when(change == "BACK_IN_STOCK", F.concat(F.lit("Product restocked with "), number_text(after), F.lit(" units")))
        .when(change == "INVENTORY_DECREASED", F.concat(number_text(before - after), F.lit(" units sold/removed")))
        .when(change == "INVENTORY_INCREASED", F.concat(number_text(after - before), F.lit(" units added to inventory")))
    )


def ledger_events(entries: DataFrame) -> DataFrame:
    """0 to 2 inventory events per ledger row."""
    return _emit(entries, _event_candidates(), drop=["previous_inventory", "previous_price"])


def _event_candidates() -> list[Column]:
    before, after = F.col("previous_inventory"), F.col("current_inventory")
    change = stock_change(before, after)

    def event(kind: Column, reason: Column, prev_inv: Column = before, prev_price: Column | None = None):
        return F.struct(
            kind.alias("event_type"),
            reason.alias("change_reason"),
            prev_inv.alias("previous_inventory"),
            (F.col("previous_price") if prev_price is None else prev_price).alias("previous_price"),
        )

    added = F.when(
        first_seen(),
        event(F.lit("PRODUCT_ADDED"), F.lit("New product added to catalog"), F.lit(0), F.lit(0.0)),
    )
    stock = F.when(
        is_product() & before.isNotNull() & change.isNotNull(),
        event(change, stock_change_reason(change, before, after)),
    )
    price = F.when(
        price_changed(),
        event(
            F.lit("PRICE_CHANGED"),
            F.concat(
                F.lit("Price "), F.when(price_step() > 0, "increased").otherwise("decreased"), F.lit(" by $"), dollars(_cents_step()),
                F.coalesce(F.concat(F.lit(" ("), _percent_text(), F.lit("%)")), F.lit("")),
            ),
        ),
    )
    order = F.when(
        ~is_product(),
        event(
            F.lit("INVENTORY_DECREASED"),
            F.concat(F.lit("Deducted "), F.col("qty").cast("string"), F.lit(" for order "), F.col("order_id").cast("string")),
        ),
    )
    return [added, stock, price, order]


def ledger_alerts(
    entries: DataFrame,
    low_below: int = LOW_STOCK_BELOW,
    order_low_upto: int = ORDER_LOW_STOCK_UPTO,
) -> DataFrame:
    """Low-stock, out-of-stock and price-drop alerts per ledger row.

    Catalogue rows alert below `low_below`, order rows up to and including `order_low_upto`.
    """
    return _emit(entries, _alert_candidates(low_below, order_low_upto))


def _alert_candidates(low_below: int, order_low_upto: int) -> list[Column]:
    before, after = F.col("previous_inventory"), F.col("current_inventory")
    catalogue_moved = is_product() & (before.isNull() | (before != after))
    out = F.when((catalogue_moved | ~is_product()) & (after == 0), out_of_stock_alert())
    low = F.when(
        (after > 0) & ((catalogue_moved & (after < low_below)) | (~is_product() & (after <= order_low_upto))),
        low_stock_alert(after),
    )
    drop = F.when(price_changed() & (price_percent() <= -10.0), price_drop_alert())
    return [out, low, drop]


def ledger_outputs(entries: DataFrame, low_below: int = LOW_STOCK_BELOW, order_low_upto: int = ORDER_LOW_STOCK_UPTO) -> DataFrame:
    """Events and alerts in one pass over the ledger rows: `event` or `alert` is set, with the fields of the single forms.

    Row for row the same as `ledger_events` and `ledger_alerts`, for sinks that want both.
    """
    event_type = "struct<event_type:string,change_reason:string,previous_inventory:int,previous_price:double>"
    alert_type = "struct<alert_type:string,severity:string,message:string>"
    none = F.lit(None)

    def tagged(c: Column, is_event: bool) -> Column:
        event, alert = (c, none) if is_event else (none, c)
        return F.when(c.isNotNull(), F.struct(event.cast(event_type).alias("event"), alert.cast(alert_type).alias("alert")))

    both = [tagged(c, True) for c in _event_candidates()] + [tagged(c, False) for c in _alert_candidates(low_below, order_low_upto)]
    return _emit(entries, both)


def out_of_stock_alert() -> Column:
    return F.struct(
        F.lit("OUT_OF_STOCK").alias("alert_type"),
        F.lit("CRITICAL").alias("severity"),
        F.lit("Product is out of stock").alias("message"),
    )


def low_stock_alert(stock: Column) -> Column:
    return F.struct(
        F.lit("LOW_STOCK").alias("alert_type"),
        F.when(stock <= 5, "CRITICAL").otherwise("WARNING").alias("severity"),
        F.concat(F.lit("Low stock: only "), number_text(stock), F.lit(" items remaining")).alias("message"),
    )


def price_drop_alert() -> Column:
    return F.struct(
        F.lit("PRICE_DROP").alias("alert_type"),
        F.lit("INFO").alias("severity"),
        F.concat(
            F.lit("Price dropped "), _percent_text(), F.lit("% from $"), dollars(whole_cents("previous_price")), F.lit(" to $"), dollars(whole_cents("current_price")),
        ).alias("message"),
    )


def _emit(entries: DataFrame, candidates: Sequence[Column], drop: Sequence[str] = ()) -> DataFrame:
    """One row per non-null candidate struct, in one pass over the rows."""
    kept = [c for c in entries.columns if c not in drop]
    exploded = entries.select(*kept, F.explode(F.array(*candidates)).alias("_e"))
    return exploded.where(F.col("_e").isNotNull()).select(*kept, "_e.*")


# ---------------------------------------------------------------------------------------------
# Order deductions against a fixed opening stock
# ---------------------------------------------------------------------------------------------


def deduct(initial: DataFrame, orders: DataFrame, order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """Order rows against an opening stock table (`product_id`, `name`, `inventory`, `price`).

    Unknown products give a row with 0 before and after; an order for more than is left sells what
    is there and is flagged `OUT_OF_STOCK`, as is one that sells exactly the rest.
    """
    from shelfline.operators.keyed import running

    keyed = order_by_key(orders, [KEY], order)
    sums = keyed.finish(running(keyed, keyed.df, {"_taken": ("sum", F.col("qty").cast("long"))}))
    stock = initial.select(
        KEY,
        F.col("name").alias("product_name"),
        F.col("inventory").alias("_base"),
        F.col("price").alias("current_price"),
    )
    left = F.col("_base") - F.col("_taken")
    before = F.greatest(F.lit(0), left + F.col("qty")).cast("int")
    known = F.col("_base").isNotNull()
    short = F.col("qty") > before
    text = F.col("order_id").cast("string")
    return sums.join(stock, KEY, "left").select(
        KEY,
        *order,
        *[c for c in ["order_id"] if c not in order],
        "qty",
        F.when(known, F.col("product_name")).otherwise("Unknown Product").alias("product_name"),
        F.when(known & (left <= 0), "OUT_OF_STOCK").otherwise("INVENTORY_DECREASED").alias("event_type"),
        F.when(known, before).otherwise(0).alias("previous_inventory"),
        F.when(known, F.greatest(F.lit(0), left).cast("int")).otherwise(0).alias("current_inventory"),
        "current_price",
        F.when(~known, F.format_string("Order %s: Product not found in inventory", text))
        .when(short, F.format_string("Order %s: Insufficient inventory (ordered: %d, available: %d)", text, F.col("qty"), before))
        .otherwise(F.format_string("Order %s: %d units sold", text, F.col("qty")))
        .alias("change_reason"),
    )
