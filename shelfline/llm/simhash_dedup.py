"""Near-duplicate documents by SimHash fingerprints and an index of their bytes by position.

A fingerprint has eight bytes. Two fingerprints that differ in at most four bits differ in at most four bytes, so they
agree in four bytes or more, each at its own position: that is the guaranteed minimum of matches. A posting list of one
byte would hold every 256th fingerprint, and tallying matches over such lists would take a row per 32nd pair of
fingerprints. The count is therefore not taken pair by pair: lists are kept for each choice of four positions, so that two fingerprints meet in a list exactly
when a tally would reach the minimum, whatever the other bytes are. 70 rows per fingerprint enter the index, and the bits of pairs that meet are verified.

Lists of near copies are long, and their pairs would grow with the square of a group. Pairs are not emitted:

1. In every list all members are compared with one pivot, the smallest; links to it give components.
2. A list whose members are all in one component is done. In the others the members outside of the list's largest
   component are compared with all members of other components. Links found there join components.

Every pair of linked fingerprints is either compared or already in one component, so components are exact.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.components import connected_components
from shelfline.llm.registry import query, table
from shelfline.session import materialise, stored

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
#: Shingles whose bits are tallied at once, so that a long text needs no more memory than a short one.
_TALLY = 1 << 15


def simhash(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a UTF-8 text as a signed 64-bit number; 0 for null and for a text without words."""
    found = (text or b"").lower().split()  # of bytes: A-Z and ASCII white space only
    if not found:
        return 0
    if len(found) < words:
        digests = [xxhash.xxh64_digest(b" ".join(found), SEED)]
    else:
        joined = b" ".join(found)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(lengths + 1) - 1
        digest = xxhash.xxh64_digest
        digests = [digest(joined[a:b], SEED) for a, b in zip((ends - lengths).tolist(), ends[words - 1 :].tolist(), strict=False)]
    bits = np.zeros(64, np.int64)
    for k in range(0, len(digests), _TALLY):
        some = np.frombuffer(b"".join(digests[k : k + _TALLY]), np.uint8).reshape(-1, 8)
        bits += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * bits > len(digests)).tobytes(), "big", signed=True)


def fingerprint(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """`simhash` of a text column."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array((simhash(x.as_py(), words) for x in texts), pa.int64())

    return of.asNondeterministic()(text.cast("binary"))  # so that the optimizer never computes it twice


def _postings(prints: DataFrame, max_bits: int) -> DataFrame:
    """(posting, fp): a fingerprint in one list per choice of the byte positions that must agree."""
    held = 8 - max_bits
    lists = []
    for number, places in enumerate(combinations(range(8), held)):
        mask = sum(0xFF << 8 * p for p in places)
        free = next(p for p in range(8) if p not in places)  # holds the choice's number
        signed = int.from_bytes(mask.to_bytes(8, "big"), "big", signed=True)
        tag = int.from_bytes((number << 8 * free).to_bytes(8, "big"), "big", signed=True)
        lists.append(F.col("fp").bitwiseAND(F.lit(signed)).bitwiseOR(F.lit(tag)))
    return prints.select(F.explode(F.array(*lists)).alias("posting"), "fp")


def _linked(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def fingerprint_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component) for distinct fingerprints `prints` (fp: long) that have a link, by links of at most `max_bits` bits.

    A component is named by its smallest fingerprint; fingerprints without a link are absent. 0 to 4 bits are allowed.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0 to 4")
    # The distinct fingerprints are few bytes, which adaptive execution would leave to a few tasks; 70 rows come of each.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = _postings(prints.repartition(parts, "fp"), max_bits)
    lists = index.groupBy("posting").agg(F.count("*").alias("n"), F.min("fp").alias("pivot")).where("n > 1").drop("n")
    # The lists grow with the index and are no side to broadcast; a merge join spills, a hash join of partitions would not.
    members = stored(index.join(lists.hint("merge"), "posting"), "snappy")

    to_pivot = members.where((F.col("fp") != F.col("pivot")) & _linked("fp", "pivot", max_bits))
    first = materialise(connected_components(to_pivot.select(F.col("fp").alias("a"), F.col("pivot").alias("b"))))

    named = materialise(
        members.join(first, members.fp == first.node, "left").select("posting", "fp", F.coalesce("component", "fp").alias("part"))
    )
    sizes = named.groupBy("posting", "part").agg(F.count("*").alias("n"))
    open_lists = (
        sizes.groupBy("posting")
        .agg(F.count("*").alias("parts"), F.max_by("part", F.struct("n", "part")).alias("largest"))
        .where("parts > 1")
        .drop("parts")
    )
    rest = stored(named.join(stored(open_lists), "posting"))
    if rest.isEmpty():
        return first.select(F.col("node").alias("fp"), "component")
    few = rest.where("part <> largest").select("posting", F.col("fp").alias("fp_a"), F.col("part").alias("part_a"))
    across = few.join(rest, "posting").where(
        (F.col("part") != F.col("part_a"))
        & ((F.col("part") == F.col("largest")) | (F.col("part_a") < F.col("part")))
        & _linked("fp_a", "fp", max_bits)
    )
    across = stored(across.select("part_a", "part", "fp_a", "fp"))
    second = connected_components(across.select(F.col("part_a").alias("a"), F.col("part").alias("b")))
    joined = second.select(F.col("node").alias("part"), F.col("component").alias("whole"))
    singles = across.select(F.col("fp_a").alias("node")).unionByName(across.select(F.col("fp").alias("node"))).distinct()
    known = first.unionByName(singles.join(first, "node", "left_anti").select("node", F.col("node").alias("component")))
    return known.join(joined, known.component == joined.part, "left").select(
        F.col("node").alias("fp"), F.coalesce("whole", "component").alias("component")
    )


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs` (doc_id, text).

    Null texts and texts without words have fingerprint zero and are linked like others. Repeated rows stay and share
    a component; a row with a null doc_id gets its component's smallest id, null where no member has one. Texts of any
    length are read whole, their shingles tallied in runs. Other columns are ignored; no rows give no rows.
    """
    prints = stored(docs.select("doc_id", fingerprint(F.col("text"), words).alias("fp")))
    return named_components(prints, max_bits).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def named_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """`prints` (doc_id, fp, …) with component, the smallest fingerprint of the row's component, and component_id, its smallest doc_id."""
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    return _labelled(prints, distinct, materialise(fingerprint_components(distinct.select("fp"), max_bits)))


def _labelled(prints: DataFrame, distinct: DataFrame, parts: DataFrame) -> DataFrame:
    labelled = distinct.join(parts, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    # Written first, so that a large component can be split in the join.
    least = materialise(labelled.groupBy("component").agg(F.min("least").alias("component_id")))
    names = labelled.join(least, "component").select("fp", "component", "component_id")
    return prints.join(names, "fp")


def keyed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, doc, row): all columns of a row as one, whatever their names and types, and their hash."""
    quoted = {f.name: F.col("`" + f.name.replace("`", "``") + "`") for f in docs.schema.fields}
    # Maps have no hash of their own; their JSON text stands for them.
    parts = [F.to_json(F.struct(quoted[f.name])) if "map<" in f.dataType.simpleString() else quoted[f.name] for f in docs.schema.fields]
    return docs.select("doc_id", "text", F.struct(*quoted.values()).alias("doc"), F.xxhash64(*parts).alias("row"))


def one_of_each(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Of `rows`, as `keyed_rows` makes them, one of each component of `named` (component, doc_id, row).

    The rows that go are looked up, not those that stay: they are fewer, so that they are often broadcast.
    """
    named = stored(named.groupBy("component", "doc_id", "row").agg(F.count("*").alias("n")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "n"))
    keepers = stored(named.groupBy("component").agg(first.alias("k"), F.sum("n").alias("size")).where("size > 1"))
    own = (F.col("row") == F.col("k.row")) & F.col("doc_id").eqNullSafe(F.col("k.doc_id"))
    found = named.join(keepers, "component").select(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row"), own.alias("keeper"), "n")
    gone = stored(found.where("NOT keeper OR n > 1"))
    same = (F.col("row") == F.col("gone_row")) & F.col("doc_id").eqNullSafe(F.col("gone_id"))
    kept = rows.join(gone, same, "left_anti").select("doc.*")
    repeated = gone.where("keeper")
    if repeated.isEmpty():
        return kept
    return kept.unionByName(rows.join(repeated, same).select("row", "gone_id", "doc").dropDuplicates(["row", "gone_id"]).select("doc.*"))


def without_near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of `docs` (doc_id, text, …) of each component, with all its columns: the one with the smallest doc_id.

    Rows with a null doc_id come last, of rows that share an id the one with the smallest hash of the row stays, and of equal rows one.
    """
    rows = keyed_rows(docs)
    prints = stored(rows.select("doc_id", "row", fingerprint(F.col("text"), words).alias("fp")))
    return one_of_each(rows, named_components(prints, max_bits))


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
