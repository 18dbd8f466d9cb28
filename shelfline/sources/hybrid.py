"""Bounded sources in order, then a log, as one input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.keyed import latest


def hybrid(bounded: Sequence[DataFrame], log: DataFrame | None = None) -> DataFrame:
    """All stages as one DataFrame with `phase` 0, 1 … n; order by (`phase`, `ts`, `seq`).

    Stages may be files, tables or a log read so far; `ts` and `seq` are filled with 0 where a
    stage has none.
    """
    stages = [*bounded, *([log] if log is not None else [])]
    if not stages:
        raise ValueError("no stage given")
    out = None
    for phase, df in enumerate(stages):
        for col in ("ts", "seq"):
            if col not in df.columns:
                df = df.withColumn(col, F.lit(0).cast("long"))
        df = df.withColumn("phase", F.lit(phase))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def initial_state(products: DataFrame, ts: int = 0) -> DataFrame:
    """The bootstrap catalogue as opening state of the streaming ledger, one row per product."""
    rows = products.select(
        F.col("productId").alias("product_id"), "inventory", "price", "name", F.lit(ts).cast("long").alias("ts")
    )
    return latest(rows, ["product_id"], ["ts", "inventory", "price"])


def record_position(spark: SparkSession, folder: str, position: str) -> None:
    """Write down how far the log in `folder` goes now: its files, as a table at `position`.

    The bootstrap reads up to there, the stream from there on, whatever arrives in between. A position that is there already stays, so that a bootstrap that is
    repeated hands over at the same place.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{position}/_SUCCESS")
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return
    files = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"))
    files.write.mode("overwrite").parquet(position)


def _recorded(spark: SparkSession, position: str) -> DataFrame:
    return spark.read.schema("file STRING").parquet(position)


def _file() -> Column:
    return F.col("_metadata.file_name")


def log_until(spark: SparkSession, folder: str, schema: str, position: str) -> DataFrame:
    """The log's rows up to a recorded position, as a bounded stage."""
    rows = spark.read.schema(schema).parquet(folder).withColumn("_file", _file())
    return rows.join(_recorded(spark, position), F.col("_file") == F.col("file"), "left_semi").drop("_file")


def log_since(spark: SparkSession, folder: str, schema: str, position: str, **options: str) -> DataFrame:
    """The log's rows after a recorded position, as a stream; with `log_until` every row comes once.

    The files of the position are listed with the others and skipped by name.
    """
    stream = spark.readStream.schema(schema).options(**options).parquet(folder).withColumn("_file", _file())
    return stream.join(_recorded(spark, position), F.col("_file") == F.col("file"), "left_anti").drop("_file")
