"""Tables that change over time: a change log applied to a table, and the version of a value that held when a row came."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.keyed import latest, order_by_key, running
from shelfline.session import stored

#: Columns that `apply_changes` reads beside key, order and row.
OP, ROW = "op", "row"
DELETED = "d"


def apply_changes(log: DataFrame, keys: Sequence[str], order: Sequence[str], base: DataFrame | None = None, until: Column | None = None) -> DataFrame:
    """The table that a change log leaves: per key the row of its last record, unless that is a deletion.

    `log` has the `keys`, the `order` of the records within a key, `op` (`d` for a deletion, anything else sets the row) and `row`,
    a struct of the whole row after the change. Records may come in any order and more than once. `base` (the columns of `row`)
    is the table before the log; a base row yields to any record of its key. `until` is a condition on the records, to get the table as of a point
    of the log. Records that tie in `order` are decided by deletion first, then by the larger row, so a result does not depend on arrival.

    One aggregate, combined before the shuffle: a key with very many records sends one record per task.
    """
    kept = log if until is None else log.where(until)
    gone = (F.col(OP) == DELETED) | F.col(ROW).isNull()
    records = kept.select(*keys, F.struct(*order).alias("_at"), gone.alias("_gone"), F.when(~gone, F.col(ROW)).alias("_row"))
    if base is not None:
        names = [f.name for f in log.schema[ROW].dataType.fields]
        kind = log.select(F.struct(*order).alias("_at")).schema["_at"].dataType
        first = base.select(*keys, F.lit(None).cast(kind).alias("_at"), F.lit(False).alias("_gone"), F.struct(*names).alias("_row"))
        records = records.unionByName(first)
    # `_at` of a base row is null, which is smaller than any record's.
    last = latest(records, keys, ("_at", "_gone", "_row"))
    rows = last.where("NOT _gone")
    return rows.select("_row.*") if set(keys) <= set(log.schema[ROW].dataType.names) else rows.select(*keys, "_row.*")


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    ts: str = "ts",
    version_order: Sequence[str] = ("ts",),
) -> DataFrame:
    """`rows` with the `values` of the last version of their key at or before their `ts`; null where there is none yet.

    `versions` has the `keys`, the `version_order` columns, of which the first is comparable with `ts`, and the `values`. A version holds from its own time
    on, rows of the same time included; of versions with equal order the larger values hold. Every row is returned, rows without a time with nulls.

    Rows and versions are one union, shuffled once by key; the last version is a running maximum over (order, values). A hot key
    is cut into slices, and each slice gets the last version before it.
    """
    what = F.struct(*(F.col(c).alias(f"o{k}") for k, c in enumerate(version_order)), *(F.col(c).alias(f"v{k}") for k, c in enumerate(values)))
    first = version_order[0]
    known = versions.where(F.col(first).isNotNull()).select(*keys, F.col(first).alias("_at"), F.lit(0).alias("_tag"), what.alias("_version"))
    asked = rows.select(*keys, F.col(ts).alias("_at"), F.lit(1).alias("_tag"), F.struct(*rows.columns).alias("_row"))
    both = asked.unionByName(known, allowMissingColumns=True)
    # Versions precede rows of their time, and the maximum does not depend on the order among either.
    keyed = order_by_key(both, keys, ("_at", "_tag"), tie=False)
    out = keyed.finish(running(keyed, keyed.df, {"_held": ("max", F.col("_version"))}))
    return out.where("_tag = 1").select("_row.*", *(F.col(f"_held.v{k}").alias(c) for k, c in enumerate(values)))


def rules_as_of(rows: DataFrame, rules: DataFrame, on: str, value: str, ts: str = "ts") -> DataFrame:
    """Route each row by the rules that were valid when it came.

    `rules` is a log (`on`, `rule_id`, `ts`, `active`, `at_least`, `below`, `output`): a record sets a rule of a key anew from its time on, `active` false
    ends it. A row gets one output per rule of its key that holds at its time and whose range has its `value`; null bounds are open. A row
    without a rule has no output. Equal rows stay apart only if a column tells them apart.
    """
    ids = stored(rules.select(on, "rule_id").distinct())
    held = as_of(rows.join(ids, on), rules, (on, "rule_id"), ("active", "at_least", "below", "output"), ts)
    inside = (F.col("at_least").isNull() | (F.col(value) >= F.col("at_least"))) & (F.col("below").isNull() | (F.col(value) < F.col("below")))
    return held.where(F.coalesce(F.col("active"), F.lit(False)) & inside).drop("active", "at_least", "below")
