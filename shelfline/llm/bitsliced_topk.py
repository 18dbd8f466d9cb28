"""Exact top-k by integer inner product over a bit-sliced index.

Components are quantised to floor(64 x). A block of candidates keeps, for each dimension, one bitmap per bit of the
quantised values. A query multiplies and adds in bitmap arithmetic: a weight's bits shift the slices, and carry-save
adders reduce the slices of each place until one bitmap per bit of the score is left. Going from the most
significant slice down, the rows that must be among the best k are split from those that can't be; the rows left at the
boundary have one score, and of these the smallest ids are taken.

The index is built once, a row per block of candidates, and stored. Queries go to it in chunks of bounded bytes that are broadcast; a pass reads the blocks in place, keeps the
best k rows per query over all blocks of a task, and only these are shuffled and ranked. The table itself is shuffled once, to make the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.registry import query, table
from shelfline.session import stored

SCALE = 64
K = 20
#: Rows of a block, so that its bitmaps stay in the processor's cache; blocks of a partition; bytes of the queries that are broadcast at once.
BLOCK_ROWS, PARTITION_BLOCKS, CHUNK_BYTES = 4096, 2, 16 << 20
#: Scores are 64-bit numbers.
_MOST = float(1 << 63)
_INDEX = "dims int, low long, bits int, ids binary, marks binary, vectors binary, slices binary"


class BitSlices:
    """The index of one block: `rows` is an integer matrix, vectors by dimensions."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.low = int(rows.min()) if rows.size else 0
        self.bits = max(1, (int(rows.max()) - self.low).bit_length()) if rows.size else 1
        padded = np.zeros((-(-len(rows) // 64) * 64, rows.shape[1]), np.int64)
        padded[: len(rows)] = rows - self.low
        # slices[dimension, bit] is a bitmap over the rows
        bits = (padded.T[:, None, :] >> np.arange(self.bits)[None, :, None]) & 1
        packed = np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")
        self.slices = np.ascontiguousarray(packed).view(np.uint64)
        self.there = self._all()

    def _all(self) -> np.ndarray:
        return np.packbits(np.arange(-(-len(self.rows) // 64) * 64) < len(self.rows), bitorder="little").view(np.uint64)

    @classmethod
    def stored(cls, rows: np.ndarray, low: int, bits: int, slices: bytes) -> BitSlices:
        """The index of a block as it was written."""
        block = cls.__new__(cls)
        block.rows, block.low, block.bits = rows, low, bits
        block.slices = np.frombuffer(slices, np.uint64).reshape(rows.shape[1], bits, -1)
        block.there = block._all()
        return block

    def score_slices(self, weights: np.ndarray) -> list[np.ndarray]:
        """Bitmaps of a score's bits, least significant first; it differs from the inner product by a constant of the query.

        A negative weight takes the complement of the value, so that only additions are left.
        """
        places: list[list[np.ndarray]] = []
        for sign in (1, -1):
            size = np.maximum(sign * weights, 0)
            for t in range(int(size.max(initial=0)).bit_length()):
                dims = np.flatnonzero(size >> t & 1)
                chosen = self.slices[dims]
                if sign < 0:
                    chosen = ~chosen
                for b in range(self.bits if len(dims) else 0):
                    while len(places) <= t + b:
                        places.append([])
                    places[t + b].append(chosen[:, b])
        return _add(places)

    def top(self, weights: np.ndarray, k: int, allowed: np.ndarray | None = None) -> np.ndarray:
        """Row numbers of the k best scores (all, if fewer), ties to smaller numbers; in no order. `allowed` is a bitmap."""
        open_ = self.there if allowed is None else allowed
        sure = np.zeros_like(open_)
        if int(np.bitwise_count(open_).sum()) <= k:
            return _numbers(open_)
        for bits in reversed(self.score_slices(weights)):
            upper = open_ & bits
            n = int(np.bitwise_count(sure | upper).sum())
            if n > k:
                open_ = upper
            else:
                sure |= upper
                open_ = open_ & ~bits
                if n == k:
                    return _numbers(sure)
        first = _numbers(sure)
        return np.concatenate([first, _numbers(open_)[: k - len(first)]])


def _add(places: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Carry-save addition: three bitmaps of a place become one there and one in the next, many triples at a time."""
    out, carried = [], []
    k = 0
    while k < len(places) or carried:
        held = [x for x in (*(places[k] if k < len(places) else ()), *carried) if len(x)]
        if not held:
            out.append(None)
            carried, k = [], k + 1
            continue
        stack, carried = np.concatenate(held), []
        while len(stack) > 1:
            m = len(stack) // 3 if len(stack) > 2 else 0
            if m:
                a, b, c = stack[:m], stack[m : 2 * m], stack[2 * m : 3 * m]
                ab = a ^ b
                carried.append((a & b) | (ab & c))
                stack = np.concatenate([ab ^ c, stack[3 * m :]])
            else:
                carried.append(stack[:1] & stack[1:])
                stack = stack[:1] ^ stack[1:]
        out.append(stack[0])
        k += 1
    width = next((x for x in out if x is not None), None)
    return [np.zeros_like(width) if x is None else x for x in out] if width is not None else []


def _numbers(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, mark, q, dims): whole components of the rows that take part, `mark` telling rows apart.

    Left out are null ids, null or empty vectors, and vectors with a null or non-finite component. Rows that share an id stay. A score that might not
    fit into 64 bits raises an error.
    """
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & sound)
    most = F.array_max(F.transform("embedding", lambda v: F.abs(v.cast("double"))))
    reach = rows.select((F.size("embedding") * F.pow(most * SCALE + 1, F.lit(2))).alias("reach")).agg(F.max("reach")).first()[0]
    if reach is not None and reach >= _MOST:
        raise ValueError("components are so large that a score would not fit into 64 bits")
    whole = F.transform("embedding", lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    return rows.select("vec_id", F.monotonically_increasing_id().alias("mark"), whole.alias("q"), F.size("embedding").alias("dims"))


def build_index(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The bit-sliced index of `rows` as `quantised` makes them: one row per block of vectors of one length, smaller ids first."""
    parts = max(1, -(-rows.count() // (block_rows * PARTITION_BLOCKS)))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            lengths = batch.column("dims").to_numpy()
            for dims in np.unique(lengths).tolist():
                some = batch.filter(pa.array(lengths == dims))
                q = some.column("q").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                held.setdefault(dims, []).append((some.column("vec_id").to_numpy(), some.column("mark").to_numpy(), q))
                if sum(len(x[0]) for x in held[dims]) >= block_rows * PARTITION_BLOCKS:
                    yield from written(dims, held.pop(dims))
        for dims, some in held.items():
            yield from written(dims, some)

    def written(dims: int, some: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        ids, marks, q = (np.concatenate([x[k] for x in some]) for k in range(3))
        order = np.lexsort((marks, ids))
        for k in range(0, len(order), block_rows):
            own = order[k : k + block_rows]
            block = BitSlices(np.ascontiguousarray(q[own], np.int64))
            raw = [x.astype("<i8").tobytes() for x in (ids[own], marks[own], block.rows)]
            values = [[dims], [block.low], [block.bits], *([x] for x in raw), [block.slices.tobytes()]]
            kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], [c.split()[0] for c in _INDEX.split(", ")])

    return stored(rows.repartition(parts, "mark").mapInArrow(blocks, _INDEX))


def _search(index: DataFrame, asked: Broadcast, k: int) -> DataFrame:
    """(query, query_id, vec_id, score): the best k rows of each task's blocks for every query, without the query's own row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        marks, ids, by_dims = asked.value
        for batch in batches:
            for row in batch.to_pylist():
                places, weights = by_dims.get(row["dims"], (np.zeros(0, np.int64), None))
                names, own = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["marks"], "<i8")
                block = BitSlices.stored(np.frombuffer(row["vectors"], "<i8").reshape(-1, row["dims"]), row["low"], row["bits"], row["slices"])
                order = np.argsort(own)
                at = np.minimum(np.searchsorted(own[order], marks[places]), len(own) - 1)
                at = np.where(own[order[at]] == marks[places], order[at], -1)
                for place, w, mine in zip(places.tolist(), weights if weights is not None else (), at.tolist(), strict=True):
                    allowed = block.there
                    if mine >= 0:
                        allowed = allowed.copy()
                        allowed[mine >> 6] &= ~np.uint64(1 << (mine & 63))
                    top = block.top(w, k, allowed)
                    near, scores = names[top], block.rows[top] @ w
                    if place in best:
                        near, scores = np.concatenate([best[place][0], near]), np.concatenate([best[place][1], scores])
                    kept = np.lexsort((near, -scores))[:k]
                    best[place] = (near[kept], scores[kept])
        sizes = [len(v[0]) for v in best.values()]
        places = np.repeat(np.fromiter(best, np.int64, len(best)), sizes)
        columns = [marks[places], ids[places]]
        columns += [np.concatenate([v[c] for v in best.values()]) if best else np.zeros(0, np.int64) for c in range(2)]
        yield pa.record_batch([pa.array(c.astype(np.int64)) for c in columns], ["query", "query_id", "vec_id", "score"])

    return index.mapInArrow(scan, "query long, query_id long, vec_id long, score long")


def _chunk(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Marks and ids of a chunk's queries, and by length their places and vectors."""
    lengths = rows.column("dims").to_numpy()
    by_dims = {}
    for dims in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == dims)
        q = rows.column("q").take(pa.array(places)).combine_chunks()
        by_dims[dims] = places, q.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)
    return rows.column("mark").to_numpy(), rows.column("vec_id").to_numpy(), by_dims


def top_k(vectors: DataFrame, is_query, k: int = K, block_rows: int = BLOCK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row of `vectors` (vec_id, embedding) for which the column `is_query` holds.

    Candidates are all rows but the query's own with the query's number of dimensions, also those that share its id. Ranks start at 1 and have no ties: equal scores go by
    smaller vec_id. A query has fewer rows if there are fewer candidates; queries that share an id have their rows each. Rows that `quantised` leaves out are
    neither; other columns are ignored; no rows give no rows.
    """
    rows = stored(quantised(vectors.select("vec_id", "embedding")))
    index, queries = build_index(rows, block_rows), rows.where(is_query)
    size = queries.agg(F.sum(F.col("dims") * 8 + 24)).first()[0] or 0
    chunks, found = max(1, -(-size // chunk_bytes)), None
    for chunk in range(chunks):
        some = queries if chunks == 1 else queries.where(F.pmod(F.xxhash64("mark"), F.lit(chunks)) == chunk)
        asked = vectors.sparkSession.sparkContext.broadcast(_chunk(some.select("vec_id", "mark", "q", "dims").toArrow()))
        part = stored(_search(index, asked, k))
        found = part if found is None else found.unionByName(part)
        asked.destroy()
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS mark, vec_id, embedding AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT mark, vec_id, list_transform(e, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM v),
s AS (SELECT a.mark, a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM q a JOIN q b ON a.mark <> b.mark AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY mark ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


@query("op4_topk", _SQL)
def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
