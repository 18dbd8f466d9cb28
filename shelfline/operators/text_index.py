"""Substring search by an index of trigrams: posting lists, and a look at the candidates only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256
#: Postings that a task sorts and writes.
PART_POSTINGS = 2_000_000
_GRAM = 3


def trigrams(text: Column) -> Column:
    """The different runs of three characters of a lower-cased text; none if it is shorter."""
    low = F.lower(text)
    return F.when(
        F.length(low) >= _GRAM,
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(low) - (_GRAM - 1)), lambda i: F.substring(low, i, F.lit(_GRAM)))),
    ).otherwise(F.array().cast("array<string>"))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def _parts(rows: DataFrame, fields: Sequence[str]) -> int:
    """Partitions of at most PART_POSTINGS postings each, since a text has no more trigrams than characters; no fewer than the session's."""
    n = rows.agg(F.sum(sum((F.coalesce(F.length(c), F.lit(0)) for c in fields), F.lit(0)).cast("long"))).first()[0] or 0
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // PART_POSTINGS))


def write_index(rows: DataFrame, folder: str, key: str, fields: Sequence[str]) -> None:
    """Write the posting lists of the text columns `fields` of `rows`: (bucket, gram, key), partitioned by bucket and sorted by gram.

    A row has a posting per different trigram of its fields, so the index grows with the texts; rows that share a key repeat it. Lists aren't collected: a common
    trigram's list is as many rows, which a few files share, since they are dealt by (gram, key). Partitions grow in number with the texts, not in size.
    """
    grams = F.array_distinct(F.flatten(F.array(*(trigrams(F.col(c)) for c in fields))))
    postings = rows.select(key, F.explode(grams).alias("gram")).withColumn("bucket", _bucket(F.col("gram")))
    dealt = postings.repartitionByRange(_parts(rows, fields), "bucket", "gram", key).sortWithinPartitions("bucket", "gram", key)
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(folder)


def candidates(spark: SparkSession, folder: str, key: str, key_type: str, text: str) -> DataFrame | None:
    """The `key`s whose rows have all trigrams of a text; None for a text that is too short to have any. Only these trigrams' lists are read."""
    low = text.lower()
    grams = sorted({low[i : i + _GRAM] for i in range(len(low) - _GRAM + 1)})
    if not grams:
        return None
    wanted = spark.createDataFrame([(g,) for g in grams], "gram STRING").select("gram", _bucket(F.col("gram")).alias("bucket"))
    buckets = [r.bucket for r in wanted.select("bucket").distinct().collect()]
    lists = spark.read.schema(f"gram STRING, {key} {key_type}, bucket INT").parquet(folder)
    hit = lists.where(F.col("bucket").isin(*buckets) & F.col("gram").isin(*grams))
    return hit.groupBy(key).agg(F.size(F.collect_set("gram")).alias("_grams")).where(F.col("_grams") == len(grams)).select(key)


def indexed_search(rows: DataFrame, folder: str, key: str, fields: Sequence[str], text: str) -> DataFrame:
    """The `rows` with the text, case-blind, in one of `fields`, by the index in `folder`.

    A row with all trigrams in different places is a candidate and no hit, so candidates are looked at. A text of fewer than three characters is looked for in all rows.
    """
    low = text.lower()
    hit = F.lit(False)
    for c in fields:
        hit = hit | F.coalesce(F.contains(F.lower(c), F.lit(low)), F.lit(False))
    found = candidates(rows.sparkSession, folder, key, rows.schema[key].dataType.simpleString(), text)
    return (rows if found is None else rows.join(found, key, "left_semi")).where(hit)
