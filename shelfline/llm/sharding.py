"""Sharding by fixed virtual slots.

Records are hashed into 4096 slots, for good. Bytes and rows are summed per slot, and a map gives each slot its shard.
The map is a small versioned table: rebalancing writes a new version in which only some slots have changed, so a record moves
only with its slot. Everything is built from DataFrame functions; what is done slot by slot is a fold over 4096 numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.registry import query, table
from shelfline.session import new_folder, stored

SLOTS = 4096
SHARDS = 16
#: How far above its even share a shard may keep its slots when the query's map is edited.
TOLERANCE = 0.0005


def slot_of(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """A record's virtual slot: by its id; records without one are dealt over all slots, so that many equal ones are no hot slot.

    The slot of a record without an id is its own only once it is stored.
    """
    return F.pmod(F.when(doc_id.isNull(), F.xxhash64(text, F.monotonically_increasing_id())).otherwise(F.xxhash64(doc_id)), F.lit(slots)).cast("int")


def slot_sums(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(vslot, bytes, rows) for all slots, empty ones too, from `records` (vslot, size)."""
    sums = records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(sums, "vslot", "left").select("vslot", F.coalesce("bytes", F.lit(0)).alias("bytes"), F.coalesce("rows", F.lit(0)).alias("rows"))


def _fold(one: DataFrame) -> DataFrame:
    """(vslot, shard): the slots of `order` one by one to the shard with the smallest load so far.

    `one` is one row with `order`, an array of (bytes, rows, vslot), and `loads`, the bytes that each shard starts with.
    """
    start = F.struct("loads", F.array().cast("array<int>").alias("to"))

    def give(a: Column, s: Column) -> Column:
        least = F.array_position(a["loads"], F.array_min(a["loads"])).cast("int") - 1
        grown = F.transform(a["loads"], lambda x, i: F.when(i == least, x + s["bytes"]).otherwise(x))
        return F.struct(grown.alias("loads"), F.array_append(a["to"], least).alias("to"))

    given = one.select("order", F.aggregate("order", start, give, lambda a: a["to"]).alias("to"))
    return given.select(F.explode(F.arrays_zip("order", "to")).alias("x")).select("x.order.vslot", F.col("x.to").alias("shard"))


def first_map(sums: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(vslot, shard, version 1): slots from the largest down, each to the shard with the fewest bytes so far."""
    one = sums.agg(F.reverse(F.array_sort(F.collect_list(F.struct("bytes", "rows", "vslot")))).alias("order"))  # all slots
    loads = F.array_repeat(F.lit(0).cast("bigint"), shards)
    return _fold(one.select("order", loads.alias("loads"))).withColumn("version", F.lit(1))


def plain_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(vslot, shard, version 1): the slots in turn, before anything is known of the records."""
    return spark.range(slots).select(F.col("id").cast("int").alias("vslot"), (F.col("id") % shards).cast("int").alias("shard"), F.lit(1).alias("version"))


def rebalanced(current: DataFrame, sums: DataFrame, shards: int, tolerance: float = 0.01) -> DataFrame:
    """The next version of `current` (vslot, shard, version) for `shards` shards and new `sums`; few slots change.

    A shard keeps its slots, largest first, while they fit into its even share of the bytes and `tolerance` of it;
    the others, which are small and so even the shares out, and those of shards that no longer exist, go to the shards with the fewest bytes.
    """
    both = current.join(sums, "vslot")
    total = Window.partitionBy()
    so_far = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot").rowsBetween(Window.unboundedPreceding, 0)
    limit = F.sum("bytes").over(total) / shards * (1 + tolerance)
    stays = (F.col("shard") < shards) & (F.sum("bytes").over(so_far) <= limit)
    marked = both.withColumn("stays", stays)
    one = marked.agg(
        F.reverse(F.array_sort(F.collect_list(F.when(~F.col("stays"), F.struct("bytes", "rows", "vslot"))))).alias("order"),
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))).alias("kept"),
    )
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.aggregate(F.filter("kept", lambda x: x["shard"] == s), F.lit(0).cast("bigint"), lambda a, x: a + x["bytes"]),
    )
    version = current.agg(F.max("version")).first()[0] + 1
    slots = marked.where("stays").select("vslot", "shard").unionByName(_fold(one.select("order", loads.alias("loads"))))
    return slots.withColumn("version", F.lit(version))


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to the map at `path`; versions are folders and never overwritten."""
    slot_map.coalesce(1).write.partitionBy("version").mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the map at `path`, by default the last."""
    kept = spark.read.schema("vslot int, shard int, version int").parquet(path)
    if version is None:
        version = kept.agg(F.max("version")).first()[0]
    return kept.where(F.col("version") == version)


def records_of(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot) of `docs` (doc_id, text): size is the text's UTF-8 bytes (null: none) plus 1, of the whole text however long."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        slot_of(F.col("doc_id"), F.col("text"), slots).alias("vslot"),
    )


def place(records: DataFrame, slot_map: DataFrame, sums: DataFrame) -> DataFrame:
    """`records` with shard and slot, the record's place in its shard, gapless from 0.

    A place is the rows in the shard's earlier virtual slots plus the place within the slot, so the largest sort is of one slot.
    Repeated rows and null ids have places of their own; no rows give no rows.
    """
    earlier = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        slot_map.select("vslot", "shard").join(sums, "vslot").select("vslot", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    )
    within = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    placed = records.join(starts, "vslot").withColumn("slot", F.col("start") + F.row_number().over(within) - 1)
    return placed.drop("start", "vslot")


@query("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = stored(records_of(table(spark, sf_dir, "documents")))
    sums = stored(slot_sums(records))
    path = new_folder(spark)
    save_map(plain_map(spark), path)
    save_map(rebalanced(load_map(spark, path, 1), sums, SHARDS, TOLERANCE), path)
    placed = place(records, load_map(spark, path), sums)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
