"""One pass over the rows, several named outputs."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.session import stored

OUTPUT = "output"
MAIN = "main"


def route(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Every row once per output it belongs to, tagged in `output`: one scan however many outputs."""
    tags = F.array(*(F.when(cond, F.lit(tag)) for tag, cond in rules.items()))
    return df.withColumn(OUTPUT, F.explode(tags)).where(F.col(OUTPUT).isNotNull())


def slice_of(routed: DataFrame, tag: str) -> DataFrame:
    """One output of `route`."""
    return routed.where(F.col(OUTPUT) == tag).drop(OUTPUT)


def union_all(*dfs: DataFrame) -> DataFrame:
    """All rows of all inputs; duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def inventory_routes(products: DataFrame, low_below: int = 10) -> DataFrame:
    """All products to `main`; out-of-stock, low-stock and price-drop alerts beside it.

    The price drop is a simulated 15 % mark-up on well rated products below 100.
    """
    stock, price, rating = F.col("inventory"), F.col("price"), F.col("rating")
    before = price * 1.15
    percent = F.try_divide(before - price, before) * 100
    dropped = (rating > 4.5) & (price < 100) & (percent > 10)
    routed = route(
        products,
        {
            MAIN: F.lit(True),
            "OUT_OF_STOCK": stock == 0,
            "LOW_STOCK": (stock != 0) & (stock < low_below),
            "PRICE_DROP": dropped,
        },
    )
    is_drop = F.col(OUTPUT) == "PRICE_DROP"
    return (
        routed.withColumn(
            "threshold",
            F.when(F.col(OUTPUT) == "OUT_OF_STOCK", 0).when(F.col(OUTPUT) == "LOW_STOCK", low_below),
        )
        .withColumn("original_price", F.when(is_drop, before))
        .withColumn("discount_percent", F.when(is_drop, percent))
    )


def split_errors(products: DataFrame) -> DataFrame:
    """Add `error_type` and `error_message`; both null on valid rows."""
    error = F.when(F.col("inventory") < 0, "INVALID_INVENTORY").when(F.col("price") <= 0, "INVALID_PRICE")
    message = F.when(
        F.col("inventory") < 0,
        F.concat(F.lit("Inventory cannot be negative: "), F.col("inventory").cast("string")),
    ).when(
        F.col("price") <= 0, F.concat(F.lit("Price must be positive: "), F.col("price").cast("string"))
    )
    return products.withColumn("error_type", error).withColumn("error_message", message)


def high_value_metrics(products: DataFrame, above: float = 1000, by: tuple[str, ...] = ()) -> DataFrame:
    """Count, total and average price of the products above a price."""
    return (
        products.where(F.col("price") > above)
        .groupBy(*by)
        .agg(
            F.count("*").alias("high_value_count"),
            F.sum(F.round(F.col("price") * 100).cast("long")).alias("high_value_cents"),
        )
        .withColumn("average_cents", F.col("high_value_cents") / F.col("high_value_count"))
    )


def category_routes(df: DataFrame, tags: Mapping[str, str], category: str = "category", other: str = "unknown") -> DataFrame:
    """The output of each row by its category, `other` for the rest; write with `partitionBy(output)`."""
    pairs = [F.lit(x) for pair in tags.items() for x in pair]
    return df.withColumn(OUTPUT, F.coalesce(F.create_map(*pairs)[F.col(category)], F.lit(other)))


def rule_routes(df: DataFrame, rules: DataFrame, on: str, value: str) -> DataFrame:
    """Route by a rule table (`on`, `at_least`, `below`, `output`; null bounds are open).

    An equality join with a range test. The rules are stored, so that they are broadcast only if their bytes are few.
    """
    inside = (F.col("at_least").isNull() | (F.col(value) >= F.col("at_least"))) & (
        F.col("below").isNull() | (F.col(value) < F.col("below"))
    )
    return df.join(stored(rules), on, "inner").where(inside).drop("at_least", "below")
