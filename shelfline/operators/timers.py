"""Batch forms of timers: quiet products, periodic snapshots, session timeouts, abandonment.

A timer that is reset by every row of a key fires exactly where the gap to the next row is longer
than its delay, so each of these is a look at the neighbouring row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators.keyed import order_by_key, running
from shelfline.operators.ledger import KEY
from shelfline.schemas import SESSION_GAP_MS, SNAPSHOT_EVERY_MS, STALE_AFTER_MS

ORDER = ("ts", "seq")


def stale(
    rows: DataFrame,
    horizon: int,
    timeout_ms: int = STALE_AFTER_MS,
    order: Sequence[str] = ORDER,
    key: str = KEY,
) -> DataFrame:
    """One row per quiet gap longer than `timeout_ms`, with all columns of the row before the gap.

    The gap after the last row ends at `horizon` and counts from exactly `timeout_ms` on; a row
    exactly at the timer instant resets it. `stale_ts` is when the timer fires, `stale_ms` how long
    the product stayed quiet, `severity` HIGH beyond twice the timeout.
    """
    keyed = order_by_key(rows, [key], order, after=1)
    df = keyed.finish(keyed.df.withColumn("_next", F.lead("ts").over(keyed.window())))
    quiet = F.coalesce("_next", F.lit(horizon)) - F.col("ts")
    fired = F.when(F.col("_next").isNull(), quiet >= timeout_ms).otherwise(quiet > timeout_ms)
    return (
        df.where(fired)
        .withColumn("stale_ts", F.col("ts") + timeout_ms)
        .withColumn("stale_ms", quiet)
        .withColumn("severity", F.when(quiet > 2 * timeout_ms, "HIGH").otherwise("MEDIUM"))
        .drop("_next")
    )


def stale_events(stale_rows: DataFrame, timeout_ms: int = STALE_AFTER_MS) -> DataFrame:
    """STALE_INVENTORY events: only the product and its stock are set, no price."""
    return stale_rows.select(
        KEY,
        F.col("stale_ts").alias("ts"),
        "product_name",
        F.lit("STALE_INVENTORY").alias("event_type"),
        "current_inventory",
        F.format_string("No updates for %.1f hours", F.lit(timeout_ms / 3_600_000.0)).alias("change_reason"),
    )


def snapshots(
    rows: DataFrame,
    horizon: int,
    every_ms: int = SNAPSHOT_EVERY_MS,
    order: Sequence[str] = ORDER,
    key: str = KEY,
) -> DataFrame:
    """The key's current row every `every_ms` from its first row on, up to `horizon`.

    Each row answers the ticks between itself and the next row, so no join of ticks and rows is
    needed.
    """
    keyed = order_by_key(rows, [key], order, after=1)
    df = keyed.df.withColumn("_next", F.lead("ts").over(keyed.window()))
    df = keyed.finish(running(keyed, df, {"_start": ("min", F.col("ts"))}))
    age, until = F.col("ts") - F.col("_start"), F.col("_next") - F.col("_start")
    first = F.greatest(F.lit(1), F.ceil(age / every_ms)).cast("long")
    last = F.when(
        F.col("_next").isNull(), F.floor((F.lit(horizon) - F.col("_start")) / every_ms)
    ).otherwise(F.ceil(until / every_ms) - 1).cast("long")
    return (
        df.withColumn("_first", first)
        .withColumn("_last", last)
        .where(F.col("_first") <= F.col("_last"))
        .withColumn("_tick", F.explode(F.sequence("_first", "_last")))
        .withColumn("snapshot_ts", F.col("_start") + F.col("_tick") * every_ms)
        .drop("_next", "_start", "_first", "_last", "_tick")
    )


def number_sessions(
    activity: DataFrame,
    gap_ms: int = SESSION_GAP_MS,
    key: str = "user_id",
    order: Sequence[str] = ORDER,
    chain: bool = False,
) -> DataFrame:
    """Add `session_no` (1, 2 … per key): a new session starts `gap_ms` or more after the last row; `chain` as in `Keyed.finish`."""
    keyed = order_by_key(activity, [key], order, before=1)
    last = F.lag("ts").over(keyed.window())
    df = keyed.df.withColumn("_new", F.when(last.isNull() | (F.col("ts") - last >= gap_ms), 1).otherwise(0))
    return keyed.finish(running(keyed, df, {"session_no": ("sum", F.col("_new"))}), chain).drop("_new")


def session_timeouts(
    activity: DataFrame,
    gap_ms: int = SESSION_GAP_MS,
    key: str = "user_id",
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """One row per session: its start, the timeout instant, duration up to it, item count.

    The items themselves stay rows (`number_sessions`), since a session has no size bound.
    """
    return (
        number_sessions(activity, gap_ms, key, order)
        .groupBy(key, "session_no")
        .agg(
            F.min("ts").alias("session_start"),
            (F.max("ts") + gap_ms).alias("timeout_ts"),
            F.count("*").alias("item_count"),
        )
        .withColumn("duration_ms", F.col("timeout_ts") - F.col("session_start"))
    )


def abandoned(
    events: DataFrame,
    within_ms: int,
    key: str = "user_id",
    order: Sequence[str] = ORDER,
    start: str = "ADD_TO_CART",
    end: str = "ORDER_PLACED",
) -> DataFrame:
    """`start` events with no `end` event of the same key in the `within_ms` after them."""
    back = [f"_back_{c}" for c in order]
    reversed_ = events.where(F.col("event_type").isin(start, end)).select(
        "*", *((-F.col(c)).alias(b) for c, b in zip(order, back))
    )
    keyed = order_by_key(reversed_, [key], back)
    ends = F.when(F.col("event_type") == end, F.col("ts"))
    df = keyed.finish(running(keyed, keyed.df, {"next_end_ts": ("min", ends)}))
    late = F.col("next_end_ts").isNull() | (F.col("next_end_ts") - F.col("ts") > within_ms)
    return df.where((F.col("event_type") == start) & late).drop(*back)
