"""Running state per key: totals, trends, histories, balances, anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.operators.changes import ORDER, with_previous
from shelfline.operators.keyed import last_n, latest, order_by_key, running
from shelfline.operators.ledger import KEY
from shelfline.schemas import PRICE_HISTORY, READINGS_HISTORY


def cents(price: Column) -> Column:
    """Money as whole cents, so that running sums do not depend on the order of additions."""
    return F.round(price * 100).cast("long")


def drops(products: DataFrame, order: Sequence[str] = ORDER, chain: bool = False) -> DataFrame:
    """Updates that lowered the stock, with the `units_sold`; `chain` as in `Keyed.finish`."""
    df = with_previous(products, ("inventory",), order, chain=chain)
    sold = F.col("previous_inventory") - F.col("inventory")
    return df.withColumn("units_sold", sold).where(F.col("units_sold") > 0)


def sales_total(products: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Per sale the amount at the current price and the product's running total, in cents."""
    sales = drops(products, order, chain=True).withColumn("sale_cents", F.col("units_sold") * cents(F.col("price")))
    keyed = order_by_key(sales, [KEY], order)
    out = running(keyed, keyed.df, {"total_cents": ("sum", F.col("sale_cents"))})
    return keyed.finish(out)


def price_trend(products: DataFrame, n: int = PRICE_HISTORY, order: Sequence[str] = ORDER) -> DataFrame:
    """The last `n` prices and the direction of the last three, one row per update."""
    keyed = order_by_key(products, [KEY], order, before=max(n - 1, 2))
    spec = keyed.window()
    df = keyed.df.select(
        "*",
        F.collect_list("price").over(spec.rowsBetween(-(n - 1), 0)).alias("price_history"),
        F.lag("price", 1).over(spec).alias("_p2"),
        F.lag("price", 2).over(spec).alias("_p1"),
    )
    price = F.col("price")
    trend = (
        F.when((price > F.col("_p2")) & (F.col("_p2") > F.col("_p1")), "INCREASING")
        .when((price < F.col("_p2")) & (F.col("_p2") < F.col("_p1")), "DECREASING")
        .otherwise("STABLE")
    )
    return keyed.finish(df.withColumn("trend", trend)).drop("_p1", "_p2")


def category_sales(products: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Running units sold per (product, category) for products in several `categories`."""
    sales = drops(products, order, chain=True).withColumn("category", F.explode(F.array_distinct("categories"))).drop("categories")
    keyed = order_by_key(sales, [KEY, "category"], order)
    return keyed.finish(running(keyed, keyed.df, {"category_units": ("sum", F.col("units_sold").cast("long"))}))


def running_stats(rows: DataFrame, keys: Sequence[str], value: str, order: Sequence[str] = ORDER) -> DataFrame:
    """Running sum, count, minimum, maximum and average of `value` per key.

    The average is sum over count, so partial states merge.
    """
    keyed = order_by_key(rows, keys, order)
    v = F.col(value)
    out = running(
        keyed,
        keyed.df,
        {
            "running_sum": ("sum", v),
            "running_count": ("count", v),
            "running_min": ("min", v),
            "running_max": ("max", v),
        },
    )
    return keyed.finish(out.withColumn("running_avg", F.try_divide(F.col("running_sum"), F.col("running_count"))))


def anomalies(
    readings: DataFrame,
    key: str = "device_id",
    value: str = "reading",
    n: int = READINGS_HISTORY,
    k: float = 3.0,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Readings more than `k` spreads away from the all-time mean.

    The mean runs over all readings so far, the spread over the last `n` around that mean; both
    include the current reading. `value` is an integer column (for instance cents).
    """
    keyed = order_by_key(readings, [key], order, before=n - 1)
    x = F.col(value).cast("long")
    frame = keyed.window().rowsBetween(-(n - 1), 0)
    recent = keyed.df.select(
        "*",
        F.sum(x).over(frame).alias("_s1"),
        F.sum(x.cast("decimal(38,0)") * x).over(frame).cast("double").alias("_s2"),
        F.count(x).over(frame).alias("_n"),
    )
    out = running(keyed, recent, {"_sum": ("sum", x), "_count": ("count", x)})
    out = out.withColumn("average", F.col("_sum") / F.col("_count"))
    variance = (
        F.col("_s2") / F.col("_n")
        - F.col("average") * 2.0 * (F.col("_s1") / F.col("_n"))
        + F.col("average") * F.col("average")
    )
    out = out.withColumn("std_dev", F.sqrt(F.greatest(F.lit(0.0), variance)))
    flagged = out.where(F.abs(x - F.col("average")) > F.col("std_dev") * k)
    return keyed.finish(flagged.withColumn("severity", F.lit("HIGH"))).drop("_s1", "_s2", "_n", "_sum", "_count")


def balances(
    transactions: DataFrame,
    account: str = "account_id",
    amount: str = "amount",
    kind: str = "type",
    fraud_below: int = -1000,
    order: Sequence[str] = ORDER,
    kinds: Sequence[str] = (),
) -> DataFrame:
    """Running balance per account, count per transaction type, overdraft and fraud flags.

    With the `kinds` that occur all counts run along with the balance in one sort; types outside of them have none then.
    """
    keyed = order_by_key(transactions, [account], order)
    counts = {f"_n{k}": ("count", F.when(F.col(kind) == name, F.col(amount))) for k, name in enumerate(kinds)}
    df = running(keyed, keyed.df, {"new_balance": ("sum", F.col(amount)), **counts})
    if kinds:
        own = F.coalesce(*(F.when(F.col(kind) == name, F.col(f"_n{k}")) for k, name in enumerate(kinds)))
        df = df.withColumn("type_count", own).drop(*counts)
    else:
        df = running(keyed.with_df(df), df, {"type_count": ("count", F.col(amount))}, within=[kind])
    return keyed.finish(
        df.withColumn("previous_balance", F.col("new_balance") - F.col(amount))
        .withColumn("overdraft", F.col("new_balance") < 0)
        .withColumn("fraud_alert", F.col("new_balance") < fraud_below)
    )


def last_distinct(rows: DataFrame, keys: Sequence[str], member: str, n: int, order: Sequence[str] = ORDER) -> DataFrame:
    """The last `n` different members per key (last visitors of a product)."""
    return last_n(latest(rows.select(*keys, member, *order), [*keys, member], order), keys, [*order, member], n)


def inventory_value(products: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Value of the stock per category, from the latest row per product."""
    now = latest(products.select(KEY, "category", "inventory", "price", *order), [KEY], order)
    return now.groupBy("category").agg(
        F.sum(F.col("inventory") * cents(F.col("price"))).alias("value_cents"),
        F.count("*").alias("products"),
    )


def warehouse_totals(levels: DataFrame, low: int = 10, order: Sequence[str] = ORDER, chain: bool = False) -> DataFrame:
    """Stock over all sites after every site update, with an alert flag when below `low`; `chain` as in `Keyed.finish`.

    Each row of `levels` sets one site's stock; the change against that site's previous row is
    what the product's total moves by.
    """
    keyed = order_by_key(levels, [KEY, "site"], order, before=1)
    moved = keyed.df.withColumn(
        "_delta", F.col("inventory") - F.coalesce(F.lag("inventory").over(keyed.window()), F.lit(0))
    )
    per_product = order_by_key(keyed.finish(moved, chain=True), [KEY], order)
    out = running(per_product, per_product.df, {"total_inventory": ("sum", F.col("_delta").cast("long"))})
    return per_product.finish(out.withColumn("low_total", F.col("total_inventory") < low), chain).drop("_delta")


def reorder_due(levels: DataFrame, low_for_ms: int, horizon: int, low: int = 10, order: Sequence[str] = ORDER) -> DataFrame:
    """Intervals in which a product's total stayed below `low` for at least `low_for_ms`."""
    totals = warehouse_totals(levels, low, order, chain=True)
    keyed = order_by_key(totals, [KEY], order, before=1)
    flips = keyed.finish(
        keyed.df.withColumn("_was", F.coalesce(F.lag("low_total").over(keyed.window()), F.lit(False))), chain=True
    ).where(F.col("low_total") != F.col("_was"))
    keyed = order_by_key(flips, [KEY], order, after=1)
    ended = keyed.df.withColumn("low_until", F.lead("ts").over(keyed.window()))
    return (
        keyed.finish(ended)
        .where(F.col("low_total"))
        .select(KEY, F.col("ts").alias("low_since"), F.coalesce("low_until", F.lit(horizon)).alias("low_until"))
        .where(F.col("low_until") - F.col("low_since") >= low_for_ms)
        .withColumn("reorder_at", F.col("low_since") + low_for_ms)
    )


def running_global(rows: DataFrame, value: str, order: Sequence[str], bucket: Column) -> DataFrame:
    """Running count, total and average of one whole stream, without one task seeing all of it.

    `bucket` is a column that never decreases in `order` (the day, for instance). Rows run within
    their bucket; bucket totals, one row each, are carried over. Hot buckets are sliced.
    """
    keyed = order_by_key(rows.withColumn("_bucket", bucket), ["_bucket"], order)
    v = F.col(value)
    inside = keyed.finish(running(keyed, keyed.df, {"_n": ("count", v), "_s": ("sum", v)}))
    spec = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (
        rows.groupBy(bucket.alias("_bucket"))
        .agg(F.count(v).alias("_bn"), F.sum(v).alias("_bs"))
        .select(
            "_bucket",
            F.coalesce(F.sum("_bn").over(spec), F.lit(0)).alias("_cn"),
            F.coalesce(F.sum("_bs").over(spec), F.lit(0)).alias("_cs"),
        )
    )
    return (
        inside.join(ahead, "_bucket")
        .withColumn("running_count", F.col("_n") + F.col("_cn"))
        .withColumn("running_total", F.col("_s") + F.col("_cs"))
        .withColumn("running_average", F.col("running_total") / F.col("running_count"))
        .drop("_bucket", "_n", "_s", "_cn", "_cs")
    )
