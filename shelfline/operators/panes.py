"""Sliding windows and ranges of time from mergeable totals, so that an event is read and shuffled once however many windows it is in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Precision of the distinct counts: 2^14 registers, about 0.8 % error.
REGISTERS = 14
HOUR = 3_600_000


def pane_of(ts: str, width_ms: int) -> Column:
    """The number of the pane that a time is in, also before 1970."""
    return F.expr(f"(`{ts}` - pmod(`{ts}`, {width_ms})) div {width_ms}")


def pane_totals(rows: DataFrame, by: Sequence[str], pane_ms: int, value: str, member: str, ts: str = "ts") -> DataFrame:
    """Per group and pane: `n`, `total`, `least`, `most` of `value` and a sketch `members` of the different `member`s.

    All of them merge, so later questions need the panes only. Rows without a time are in none. `value` is an integer column.
    """
    known = rows.where(F.col(ts).isNotNull()).withColumn("pane", pane_of(ts, pane_ms))
    return known.groupBy(*by, "pane").agg(
        F.count("*").alias("n"),
        F.sum(value).alias("total"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
        F.hll_sketch_agg(F.col(member).cast("string"), F.lit(REGISTERS)).alias("members"),
    )


def sliding_by_panes(rows: DataFrame, by: Sequence[str], width_ms: int, slide_ms: int, value: str, member: str, ts: str = "ts") -> DataFrame:
    """Every window of `width_ms` that begins at a multiple of `slide_ms` and has a row: `window_start`, count, total, mean, extremes, and the estimated
    number of different members. `width_ms` has to be a multiple of `slide_ms`.

    Rows are totalled by pane of `slide_ms` before the shuffle. The panes, one row per group and slide, are dealt by group; only then is each copied into its
    windows, which are merged where they are. What is shuffled doesn't depend on width over slide.
    """
    if slide_ms <= 0 or width_ms % slide_ms:
        raise ValueError("the width of a window has to be a multiple of its slide")
    panes = pane_totals(rows, by, slide_ms, value, member, ts)
    dealt = panes.repartition(*by) if by else panes.coalesce(1)
    first = F.explode(F.sequence(F.col("pane") - (width_ms // slide_ms - 1), F.col("pane")))
    merged = dealt.withColumn("window", first).groupBy(*by, "window").agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.hll_union_agg("members").alias("members"),
    )
    return merged.select(
        *by,
        (F.col("window") * slide_ms).alias("window_start"),
        "n",
        "total",
        (F.col("total") / F.col("n")).alias("mean"),
        "least",
        "most",
        F.hll_sketch_estimate("members").alias("members"),
    )


def store_hourly(rows: DataFrame, folder: str, member: str, value: str, ts: str = "ts") -> None:
    """Write a row per hour: `hour`, `n`, a sketch `members` and a quantile sketch `values`, partitioned by day, so that a range reads its days only."""
    known = rows.where(F.col(ts).isNotNull()).withColumn("hour", pane_of(ts, HOUR))
    hours = known.groupBy("hour").agg(
        F.count("*").alias("n"),
        F.hll_sketch_agg(F.col(member).cast("string"), F.lit(REGISTERS)).alias("members"),
        F.kll_sketch_agg_bigint(value).alias("values"),
    )
    day = F.expr("(hour - pmod(hour, 24)) div 24")
    hours.withColumn("day", day).repartition("day").write.mode("overwrite").partitionBy("day").parquet(folder)


def stored_hours(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("hour LONG, n LONG, members BINARY, values BINARY, day LONG").parquet(folder)


def over_ranges(hours: DataFrame, ranges: DataFrame, quantiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """`ranges` (`first_hour`, `hours`) with the events, the estimated members and `quantiles` of the values in them, from stored hours alone.

    A range is `hours` hours from `first_hour` on; one without events has no row. Ranges are looked up hour by hour, so their hours have to be fewer than
    what a join can take: thousands of ranges of some months.
    """
    asked = ranges.distinct().withColumn("hour", F.explode(F.sequence("first_hour", F.col("first_hour") + F.col("hours") - 1)))
    merged = hours.join(asked, "hour").groupBy("first_hour", "hours").agg(
        F.sum("n").alias("n"), F.hll_union_agg("members").alias("members"), F.kll_merge_agg_bigint("values").alias("values")
    )
    return merged.select(
        "first_hour",
        "hours",
        "n",
        F.hll_sketch_estimate("members").alias("members"),
        *(F.kll_sketch_get_quantile_bigint("values", F.lit(q)).alias(f"q{round(q * 100)}") for q in quantiles),
    )
