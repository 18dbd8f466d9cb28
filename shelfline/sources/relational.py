"""Partitioned reads of a relational table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, partition: str, low: int, high: int, parts: int, fetch: int = 10_000) -> dict[str, str]:
    """Options that split the read into `parts` ranges of a numeric column."""
    if parts < 1 or high < low:
        raise ValueError("need at least one partition and low <= high")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
        "fetchsize": str(fetch),
    }


def read_table(spark: SparkSession, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
