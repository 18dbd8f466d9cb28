"""Packing: documents are put end to end and the stream of ids is cut every 2048 ids.

Two passes. The first encodes each partition, notes each document's place in it and stores the ids in the shared folder. Prefix
sums over the partitions' totals, one row each, give every partition's place in the whole stream. The second
pass cuts each document where windows begin: its pieces are the boundary records. Only the last sequence has padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.registry import query, table
from shelfline.session import stored
from shelfline.llm.words import library_memo, slices

WIDTH = 2048
END_ID = 1


def encoded_partitions(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids, n, part, before): little-endian 32-bit ids with the end id, and the ids before them in the partition."""
    schema = docs.select("doc_id").schema.add("ids", "binary").add("n", "long").add("before", "long")
    end = np.array([end_id], "<i4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for some in (x for batch in batches for x in slices(batch, 1)):
            ids = [x + end for x in library_memo(path).ids(x.as_py() for x in some.column(1))]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            places = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.record_batch([some.column(0), pa.array(ids, pa.binary()), pa.array(n), pa.array(places)], ["doc_id", "ids", "n", "before"])

    return docs.select("doc_id", "text").mapInArrow(encode, schema).withColumn("part", F.spark_partition_id())


def pack(docs: DataFrame, path: str, width: int = WIDTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset (all long) and the piece's ids (binary).

    Every id of every row of `docs` (doc_id, text) is in exactly one piece. Null and empty texts consist of the end id;
    a document longer than a window has several pieces; repeated rows are packed each. Other columns are ignored; no
    rows give no pieces. The order is that of the stored partitions.
    """
    encoded = stored(encoded_partitions(docs, path, end_id))
    totals = encoded.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total"))
    # One row per partition, so this window stays small; stored, so that its size is known when the join is planned.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = stored(totals.select("part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("ahead")))
    placed = encoded.join(places, "part").withColumn("g", F.col("ahead") + F.col("before"))
    cuts = F.transform(
        F.expr(f"sequence(g div {width}, (g + n - 1) div {width})"),
        lambda s: F.struct(
            (F.greatest(s * width, F.col("g")) - F.col("g")).alias("start"),
            (F.least((s + 1) * width, F.col("g") + F.col("n")) - F.greatest(s * width, F.col("g"))).alias("length"),
            s.alias("sequence_id"),
            (F.greatest(s * width, F.col("g")) - s * width).alias("offset"),
        ),
    )
    pieces = F.transform(
        cuts,
        lambda c: c.withField("ids", F.substring(F.col("ids"), (c["start"] * 4 + 1).cast("int"), (c["length"] * 4).cast("int"))),
    )
    return placed.select("doc_id", F.col("n").alias("doc_tokens"), F.explode(pieces).alias("p")).select(
        "doc_id", "p.start", "p.length", "doc_tokens", "p.sequence_id", "p.offset", "p.ids"
    )


def sequences(pieces: DataFrame, width: int = WIDTH, pad_id: int = 0) -> DataFrame:
    """(sequence_id, length, ids): the pieces of each sequence joined and padded to `width` ids.

    A sequence has at most `width` pieces, so no group grows with the data.
    """
    joined = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    pad = np.array([pad_id], "<i4").tobytes()
    return joined.select(
        "sequence_id",
        "length",
        F.rpad(F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])), F.lit(4 * width), F.lit(pad)).alias("ids"),
    )


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
