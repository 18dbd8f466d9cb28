"""The ledger as incremental batches: the batch operators on each micro-batch plus stored state.

State is a table in the shared folder. Micro-batch `n` writes the products it touched as `delta`
number `n`, and every `full_every` batches the whole state as `full`. Reading state before `n` means
the last full table before it and the deltas since, with no listing of files. A batch that is retried reads
the same state and overwrites its own output, so results are the same after any failure.

Unlike per-key processors this runs on window expressions and slices hot products.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.keyed import latest
from shelfline.operators.ledger import KEY, ledger, ledger_alerts, ledger_events

STATE = "product_id STRING, inventory INT, price DOUBLE, name STRING, ts BIGINT"


@dataclass(frozen=True)
class StateTable:
    """Versioned state per key: deltas per batch and a full table every `full_every` batches."""

    root: str
    schema: str = STATE
    key: str = KEY
    full_every: int = 20

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """State as of the end of the batch ahead of `batch_id`."""
        return self._merged(spark, batch_id // self.full_every * self.full_every, batch_id)

    def write(self, spark: SparkSession, batch_id: int, delta: DataFrame) -> None:
        delta.write.mode("overwrite").parquet(f"{self.root}/delta/batch={batch_id}")
        after = batch_id + 1
        if after % self.full_every == 0:
            # `full/batch=n` is the state before batch n.
            base = after - self.full_every
            self._merged(spark, base, after).write.mode("overwrite").parquet(f"{self.root}/full/batch={after}")

    def _merged(self, spark: SparkSession, base: int, until: int) -> DataFrame:
        paths = [f"{self.root}/full/batch={base}"] if base else []
        paths += [f"{self.root}/delta/batch={i}" for i in range(base, until)]
        if not paths:
            return spark.createDataFrame([], self.schema).where(F.lit(False))  # so that the optimizer knows it to be empty
        rows = None
        for rank, path in enumerate(paths):
            part = spark.read.schema(self.schema).parquet(path).withColumn("_rank", F.lit(rank))
            rows = part if rows is None else rows.unionByName(part)
        return latest(rows, [self.key], ["_rank"]).drop("_rank")


def ledger_step(batch: DataFrame, state: DataFrame, order: Sequence[str] = ("ts", "seq")) -> tuple[DataFrame, DataFrame]:
    """Ledger rows of one micro-batch given the state before it, and the state rows it changes.

    A product's state enters as a catalogue row ahead of the batch's rows, which are in `order`.
    """
    touched = state.join(batch.select(KEY).distinct(), KEY, "left_semi")
    opening = touched.select(
        KEY,
        F.col("ts"),
        F.lit("PRODUCT").alias("kind"),
        "inventory", "price", "name",
        F.lit(0).alias("_live"),
    )
    rows = opening.unionByName(batch.withColumn("_live", F.lit(1)), allowMissingColumns=True)
    entries = ledger(rows, ("_live", *order)).where(F.col("_live") == 1).drop("_live")
    now = latest(
        entries.select(KEY, "current_inventory", "current_price", "product_name", *dict.fromkeys(("ts", *order))), [KEY], order
    ).select(
        KEY,
        F.col("current_inventory").alias("inventory"),
        F.col("current_price").alias("price"),
        F.col("product_name").alias("name"),
        "ts",
    )
    return entries, now


def ledger_sink(
    state: StateTable, outputs: Callable[[DataFrame, DataFrame, int], None], order: Sequence[str] = ("ts", "seq"), reread: bool = False
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function: ledger step, then `outputs(events, alerts, batch_id)`, then the state.

    A batch is read for its keys, for hot keys and for the ledger. With `reread` it is read from its source each time, which for files in columns costs less than
    keeping all rows; leave it out where rows are parsed from texts or come from a stateful step.

    `outputs` must be idempotent in the batch id. State is written last: a batch that fails before
    that runs again from the same state.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch if reread else batch.persist()
        entries, now = ledger_step(batch, state.before(spark, batch_id), order)
        entries = entries.persist()
        try:
            outputs(ledger_events(entries), ledger_alerts(entries), batch_id)
            # From `entries` again, so the persisted rows serve the state as well.
            state.write(spark, batch_id, now)
        finally:
            entries.unpersist()
            if not reread:
                batch.unpersist()

    return handle


def view_sink(
    state: StateTable, order: Sequence[str], publish: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that keeps the latest row per key and publishes the whole view.

    With a trigger of 30 seconds this is the periodic sync of a read model to its clients.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # read for its keys and for its rows
        try:
            touched = state.before(spark, batch_id).join(batch.select(state.key).distinct(), state.key, "left_semi")
            rows = touched.unionByName(batch.select(*touched.columns))
            state.write(spark, batch_id, latest(rows, [state.key], order))
        finally:
            batch.unpersist()
        publish(state.before(spark, batch_id + 1), batch_id)

    return handle


def write_slices(folder: str, slices: Mapping[str, DataFrame], batch_id: int) -> None:
    """Write each named output under its own folder and batch; a retry overwrites its own files."""
    for name, df in slices.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")
