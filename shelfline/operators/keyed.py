"""Ordered work per key that survives a hot key.

A window over a key sorts all rows of that key in one task. That is right for ordinary keys and
wrong for a key with a third of the table. `order_by_key` therefore counts rows per key when the
input is large, and cuts each hot key into consecutive slices of equal row count:

* the hot rows are range-partitioned on (key, order), numbered, and written to the shared folder,
  so slice numbers do not change when a task is retried;
* windows run per (key, slice);
* what a slice needs from its neighbours comes as *halo* rows (the last `before` rows of the slice
  ahead of it, the first `after` rows of the slice behind it), or as carried totals (`running`).

Keys that are not hot keep one shuffle and one sort. Results do not depend on the slicing: rows that tie in all order
columns are ordered by a hash of the row, with and without slices, so only equal rows are interchangeable.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.session import (
    SLICE_CHECK_BYTES,
    SLICE_ROWS,
    input_bytes,
    materialise,
    setting,
    stored,
)

SLICE = "_slice"
HALO = "_halo"
TIE = "_tie"


@dataclass(frozen=True)
class Keyed:
    """Rows of `df` in `order` within `keys`; `sliced` when hot keys were cut."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]  # the last one breaks ties
    sliced: bool = False

    def window(self, *within: str) -> WindowSpec:
        parts = [*self.keys, *([SLICE] if self.sliced else []), *within]
        return Window.partitionBy(*(parts or [F.lit(0)])).orderBy(*self.order)

    def finish(self, df: DataFrame, chain: bool = False) -> DataFrame:
        """Drop halo rows and helper columns. With `chain` the hash of ties stays, so that a next step in the same order needs no second sort."""
        kept = df.where(~F.col(HALO)).drop(SLICE, HALO) if self.sliced else df
        return kept if chain else kept.drop(TIE)

    def with_df(self, df: DataFrame) -> Keyed:
        return replace(self, df=df)


def match(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Join on `cols` where null equals null; `left`'s columns plus the others of `right`."""
    renamed = right.select(*(F.col(c).alias(f"_r_{c}" if c in cols else c) for c in right.columns))
    test = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols], F.lit(True))
    joined = left.join(renamed, test, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*(f"_r_{c}" for c in cols))


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Keys with more than `limit` rows (partial counts are combined before the shuffle)."""
    return df.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > limit)


def order_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int = 0,
    after: int = 0,
    tie: bool = True,
) -> Keyed:
    """Prepare `df` for windows over `keys` in `order` that look at most `before`/`after` rows away.

    Unbounded running aggregates go through `running`, whatever `before` is. `tie=False` leaves the hash out that orders rows which tie in `order`:
    where `order` tells all rows of a key apart, or the result does not depend on the order of those that tie.
    """
    spark, keys, order = df.sparkSession, tuple(keys), tuple(order)
    if tie:
        order = (*order, TIE)
    if tie and TIE not in df.columns:  # else a step before this one has left it
        hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        df = df.withColumn(TIE, F.xxhash64(*hashable))
    plain = Keyed(df, keys, order)
    if input_bytes(df) <= setting(spark, SLICE_CHECK_BYTES):
        return plain

    size = max(setting(spark, SLICE_ROWS), before, after, 1)
    hot = stored(hot_keys(df, keys, size))
    found, hot_rows = hot.agg(F.count("*"), F.sum("_rows")).first()
    if not found:
        return plain

    if keys:
        names = hot.select(*keys)
        cold = match(df, names, keys, "left_anti")
        warm = match(df, names, keys, "left_semi")
    else:
        cold, warm = None, df
    parts = math.ceil(hot_rows / size)
    numbered = _slices(warm, keys, order, parts, size, before, after)
    if cold is not None:
        idle = cold.withColumn(SLICE, F.lit(None).cast("long")).withColumn(HALO, F.lit(False))
        numbered = idle.unionByName(numbered)
    return Keyed(numbered, keys, order, sliced=True)


def _slices(df, keys, order, parts, size, before, after) -> DataFrame:
    """Number the hot rows 0, 1, 2 … per key and cut them every `size` rows, with halo copies."""
    ranged = (
        df.repartitionByRange(parts, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
    )
    ranged = materialise(ranged)
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*keys, "_part")
        .agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
        .withColumn("_ahead", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    placed = match(ranged, stored(starts), [*keys, "_part"], "inner").select(
        *df.columns, (F.col("_ahead") + F.col("_id") - F.col("_first")).alias("_pos")
    )
    offset = F.col("_pos") % size
    own = ((F.col("_pos") - offset) / size).cast("long")
    homes = [own]
    if before:
        homes.append(F.when(offset >= size - before, own + 1))
    if after:
        homes.append(F.when((offset < after) & (own > 0), own - 1))
    return (
        placed.withColumn(SLICE, F.explode(F.array(*homes)))
        .where(F.col(SLICE).isNotNull())
        .withColumn(HALO, F.col(SLICE) != own)
        .drop("_pos")
    )


_MERGE = {
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    "count": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "min": (F.min, lambda a, b: F.least(a, b)),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
}
_FIRST = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def running(
    keyed: Keyed,
    df: DataFrame,
    aggs: Mapping[str, tuple[str, Column]],
    within: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Add running aggregates (first row up to this one) as columns.

    `aggs` maps an output name to (`sum`|`count`|`min`|`max`, column); `within` adds partition
    columns below the key; `strict` leaves the current row out. `df` is `keyed.df` with columns
    added, halo rows still in it.
    """
    spec = keyed.window(*within).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    if not keyed.sliced:
        return df.select("*", *(_FIRST[fn](col).over(spec).alias(name) for name, (fn, col) in aggs.items()))

    names = list(aggs)
    args = {name: f"_arg_{name}" for name in names}
    base = df.select(
        "*", *(F.when(~F.col(HALO), col).alias(args[name]) for name, (_, col) in aggs.items())
    )
    parts = [*keyed.keys, *within]
    totals = (
        base.where(F.col(SLICE).isNotNull() & ~F.col(HALO))
        .groupBy(*parts, SLICE)
        .agg(*(_FIRST[fn](args[name]).alias(f"_tot_{name}") for name, (fn, _) in aggs.items()))
    )
    earlier = Window.partitionBy(*parts).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # Every row's (key, value, slice) has a total, and slices without the value would add nothing.
    carried = totals.select(
        *parts,
        SLICE,
        *(_MERGE[fn][0](f"_tot_{name}").over(earlier).alias(f"_in_{name}") for name, (fn, _) in aggs.items()),
    )
    carried = stored(carried)  # so that the join knows its size
    local = base.select(
        "*", *(_FIRST[fn](args[name]).over(spec).alias(f"_here_{name}") for name, (fn, _) in aggs.items())
    )
    return match(local, carried, [*parts, SLICE], "left").select(
        *df.columns,
        *(
            _MERGE[fn][1](F.col(f"_in_{name}"), F.col(f"_here_{name}")).alias(name)
            for name, (fn, _) in aggs.items()
        ),
    )


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key: an aggregate, combined on the map side, so a hot key sends one row per task."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, *(F.col("_row")[c].alias(c) for c in rest))
        .select(*df.columns)
    )


def last_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, salts: int = 64) -> DataFrame:
    """The last `n` rows per key, newest first (`position` 1..n).

    Two steps: at most `n` rows per (key, salt) reach the second window, so no task ranks a whole
    hot key; Spark keeps only the first `n` of each group while it sorts.
    """
    newest = [F.col(c).desc() for c in order]
    salt = F.pmod(F.xxhash64(*order), F.lit(salts))
    first = (
        df.withColumn("_salt", salt)
        .withColumn("position", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*newest)))
        .where(F.col("position") <= n)
        .drop("_salt", "position")
    )
    final = Window.partitionBy(*keys).orderBy(*newest)
    return first.withColumn("position", F.row_number().over(final)).where(F.col("position") <= n)
