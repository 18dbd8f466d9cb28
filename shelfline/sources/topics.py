"""Kafka topics as sources. The connector is a separate jar; without it only `options` works."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.config import JobConfig

# Rows per micro-batch; state processors sort a key's rows of one micro-batch in memory.
MAX_ROWS = 1_000_000


def options(config: JobConfig, topic: str, starting: str = "latest", max_rows: int = MAX_ROWS) -> dict[str, str]:
    """Reader options. `starting` is `latest`, `earliest`, a time in ms as digits, or offsets per topic and partition as JSON."""
    out = {
        "kafka.bootstrap.servers": config.bootstrap_servers,
        "kafka.metadata.max.age.ms": str(config.partition_discovery_ms),
        "subscribe": topic,
        "groupIdPrefix": config.group_id,
        "maxOffsetsPerTrigger": str(max_rows),
        **config.security(),
    }
    key = "startingTimestamp" if starting.isdigit() else "startingOffsets"
    return {**out, key: starting}


def read_topic(spark: SparkSession, config: JobConfig, topic: str, starting: str = "latest") -> DataFrame:
    """Message texts of a topic: `value`, its `ts` in ms and `seq` (partition and offset as one number)."""
    raw = spark.readStream.format("kafka").options(**options(config, topic, starting)).load()
    return text_rows(raw)


def text_rows(raw: DataFrame) -> DataFrame:
    """Broker columns to `value`, `ts`, `seq`; the key is not read."""
    seq = F.shiftleft(F.col("partition").cast("long"), 48).bitwiseOR(F.col("offset"))
    return raw.select(
        F.col("value").cast("string").alias("value"), F.unix_millis("timestamp").alias("ts"), seq.alias("seq")
    )


def typed(rows: DataFrame, schema: str) -> DataFrame:
    """Message texts as records of a schema; unreadable texts give null fields."""
    others = [c for c in rows.columns if c != "value"]
    return rows.select(*others, F.from_json("value", schema).alias("_r")).select(*others, "_r.*")


def after_bootstrap(partitions: dict[str, dict[str, int]]) -> str:
    """Start offsets noted before the bootstrap was read, so that nothing published since is skipped."""
    import json

    return json.dumps(partitions)
