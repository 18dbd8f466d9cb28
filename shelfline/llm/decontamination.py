"""Benchmark decontamination: a broadcast hash set of test n-grams, a scan of all training windows, verified hits.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. A window is ten consecutive words of a
benchmark item; an item of fewer words is one window. The distinct (window, item) pairs are made by Spark. Their bytes are counted
before anything is broadcast: up to BLOCK_BYTES they are one hash set, a larger benchmark is cut into blocks of that size by hash, and the
documents are scanned once per block.

A task turns every word of a document into its number in the benchmark's vocabulary (0: not there), hashes all windows at
once with a rolling polynomial, looks the hashes up among the sorted ones of the benchmark, and compares the ten numbers of each hit,
so a collision of hashes is no hit. Documents are never shuffled; with one block they are read once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.registry import query, table
from shelfline.session import stored

WINDOW_WORDS = 10
#: Bytes of windows and item ids that are broadcast at once.
BLOCK_BYTES = 32 << 20
_PIECE = 1 << 22  # bytes of a text that are split into words at once
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ENTRY = 48  # bytes that a pair takes besides its text
#: What a byte becomes: letters lower-cased, other bytes of words as they are, all else a space.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_HITS = "n_words: long, n_hit: long, items: array<string>, spans: array<struct<start: long, end: long>>"


def plain(text: bytes | None) -> bytes:
    """A UTF-8 text with its words lower-cased and a space for every other byte, byte for byte."""
    return (text or b"").translate(_WORD_BYTES)


def _word_runs(spaced: bytes) -> Iterator[list[bytes]]:
    """The words of a long text in runs, so that a text's words are never all objects at once."""
    at = 0
    while at < len(spaced):
        end = len(spaced)
        if end - at > _PIECE:
            end = spaced.find(b" ", at + _PIECE)
            end = len(spaced) if end < 0 else end
        yield spaced[at:end].split()
        at = end


class WindowSet:
    """Windows of benchmark items as numbers of words: one table per window length, sorted by hash."""

    def __init__(self, windows: list[bytes], items: list[str | None]):
        split = [w.split(b" ") for w in windows]
        self.vocabulary: dict[bytes, int] = {}
        for words in split:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.tables: list[tuple[int, np.ndarray, np.ndarray, list[set[str]]]] = []
        for length in sorted({len(words) for words in split}):
            owners: dict[bytes, set[str]] = {}
            for words, item in zip(split, items, strict=True):
                if len(words) == length:
                    key = np.array([self.vocabulary[w] for w in words], np.int32).tobytes()
                    owners.setdefault(key, set()).update(() if item is None else (item,))
            numbers = np.frombuffer(b"".join(owners), np.int32).reshape(-1, length)
            hashes = _rolling(numbers.reshape(-1), length)[::length]
            order = np.argsort(hashes, kind="stable")
            held = list(owners.values())
            self.tables.append((length, hashes[order], numbers[order], [held[i] for i in order.tolist()]))

    def find(self, text: bytes | None) -> tuple[int, np.ndarray, set[str]]:
        """Number of words of a text, which of them are hit, and the items with a window in it."""
        spaced, number = plain(text), self.vocabulary.get
        runs = [np.fromiter(map(number, words, repeat(0)), np.int32, len(words)) for words in _word_runs(spaced)]
        words = np.concatenate(runs) if runs else np.zeros(0, np.int32)
        edges, items = np.zeros(len(words) + 1, np.int64), set()
        for length, hashes, numbers, owners in self.tables:
            if len(words) < length:
                continue
            own = _rolling(words, length)
            at = np.searchsorted(hashes, own)
            found = np.flatnonzero(hashes[np.minimum(at, len(hashes) - 1)] == own)
            seen = set()
            for place, row in zip(found.tolist(), at[found].tolist(), strict=True):
                while row < len(hashes) and hashes[row] == own[place]:  # equal hashes of other windows stand beside it
                    if np.array_equal(numbers[row], words[place : place + length]):
                        edges[place] += 1
                        edges[place + length] -= 1
                        seen.add(row)
                    row += 1
            items.update(*(owners[row] for row in seen))
        return len(words), np.cumsum(edges[:-1]) > 0, items


def _rolling(numbers: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every `length` consecutive numbers."""
    n = len(numbers) - length + 1
    wide, out = numbers.astype(np.uint64), np.zeros(n, np.uint64)
    for k in range(length):
        out *= _ODD
        out += wide[k : k + n]
    out ^= out >> np.uint64(29)
    return out * _ODD


def _spans(text: bytes, hit: np.ndarray) -> list[dict[str, int]]:
    """Code points from the first to the last word of every run of hit words."""
    if not hit.any():
        return []
    solid = np.concatenate([[False], np.frombuffer(plain(text), np.uint8) != 0x20, [False]])
    turns = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = turns[::2], turns[1::2]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    # Code points before a byte: all bytes but continuation bytes begin one.
    points = np.concatenate([[0], np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)])
    return [{"start": int(points[starts[a]]), "end": int(points[ends[b - 1]])} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def benchmark_windows(benchmark: DataFrame, words: int = WINDOW_WORDS) -> DataFrame:
    """(window, item): the distinct windows of `benchmark` (item_id, text), their words joined by a space, with their items' ids as text.

    Items without words have none.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = plain(text.as_py()).split()
                for k in range(0, max(1, len(found) - words + 1) if found else 0, 10_000):
                    last = min(k + 10_000, max(1, len(found) - words + 1))
                    some = [b" ".join(found[i : i + words]) for i in range(k, last)]
                    yield pa.record_batch([pa.array(some, pa.binary()), pa.array([item] * len(some), pa.string())], ["window", "item"])

    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary"))
    return rows.mapInArrow(cut, "window binary, item string").distinct()


def _blocks(windows: DataFrame, block_bytes: int) -> Iterator[Broadcast]:
    """The hash set of all windows, in blocks of about `block_bytes`, one at a time."""
    held = stored(windows)
    total = held.agg(F.sum(F.octet_length("window") + F.coalesce(F.octet_length("item"), F.lit(0)) + _ENTRY)).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    for k in range(n):
        block = held if n == 1 else held.where(F.pmod(F.xxhash64("window", "item"), F.lit(n)) == k)
        rows = block.toArrow()
        yield n, windows.sparkSession.sparkContext.broadcast(WindowSet(rows.column("window").to_pylist(), rows.column("item").to_pylist()))


def _hits(text: Column, known: Broadcast) -> Column:
    """struct<n_words, n_hit, items, spans> of a text column for one block of windows."""

    @F.arrow_udf(f"struct<{_HITS}>")
    def of(texts: pa.Array) -> pa.Array:
        out = []
        for x in texts:
            text = x.as_py()
            n, hit, items = known.value.find(text)
            out.append({"n_words": n, "n_hit": int(hit.sum()), "items": sorted(items), "spans": _spans(text or b"", hit)})
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.array(
            out, pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(span))])
        )

    return of.asNondeterministic()(text.cast("binary"))  # so that the optimizer never computes it twice


def _merged(hits: DataFrame) -> DataFrame:
    """One row per key of the hits of several blocks: items together, and spans that touch or overlap as one."""

    @F.arrow_udf("struct<n_hit: long, spans: array<struct<start: long, end: long>>>")
    def join(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts, spans.to_pylist(), strict=True):
            raw = text.as_py()
            solid = np.concatenate([[False], np.frombuffer(plain(raw), np.uint8) != 0x20, [False]])
            turns = np.flatnonzero(solid[1:] != solid[:-1])
            points = np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)])
            begins, hit = points[turns[::2]], np.zeros(len(turns) // 2 + 1, np.int64)
            for s in found:
                hit[np.searchsorted(begins, s["start"])] += 1
                hit[np.searchsorted(begins, s["end"])] -= 1
            words = np.cumsum(hit[:-1]) > 0
            out.append({"n_hit": int(words.sum()), "spans": _spans(raw, words)})
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.array(out, pa.struct([("n_hit", pa.int64()), ("spans", pa.list_(span))]))

    together = hits.groupBy("key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.first("text").alias("text"),
    )
    return together.withColumn("both", join.asNondeterministic()("text", "spans")).select("key", "items", "both.n_hit", "both.spans")


def contamination(docs: DataFrame, benchmark: DataFrame, words: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` (text, …) with a column `leak`: struct<n_words, n_hit, items, spans>.

    `n_hit` counts the words inside any occurrence of a window of `benchmark` (item_id, text); `items` are the ids, as sorted
    text, of the items that own these windows; `spans` are the runs of hit words as code points, ends exclusive. Null and empty texts have
    no words; a text of any length is worked on whole. Every row of `docs` is returned, repeated ones too, with all columns, a column
    `leak` replaced. Items that share a window are all named; repeated items count once; an item without id is hit but not named. An
    empty benchmark has no windows; no rows give no rows.
    """
    windows = benchmark_windows(benchmark, words)
    parts = []
    for n, known in _blocks(windows, block_bytes):
        if n == 1:
            return docs.withColumn("leak", _hits(F.col("text"), known))
        if not parts:
            rows = stored(docs.select(F.struct(*(docs[_quoted(c)] for c in docs.columns)).alias("doc")).withColumn("key", F.monotonically_increasing_id()))
            texts = rows.select("key", F.col("doc").getField("text").cast("binary").alias("text"))
        parts.append(stored(texts.withColumn("h", _hits(F.col("text"), known)).where("h.n_hit > 0").select("key", "h.items", "h.spans", "text")))
        known.destroy()
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    found = stored(_merged(hits))
    counts = texts.select(F.col("key"), _word_count(F.col("text")).alias("n_words"))
    whole = rows.join(counts, "key").join(found, "key", "left")
    leak = F.struct(
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start: long, end: long>>")).alias("spans"),
    )
    return whole.select("doc.*", leak.alias("_leak_")).drop("leak").withColumnRenamed("_leak_", "leak")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _word_count(text: Column) -> Column:
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array((sum(map(len, _word_runs(plain(x.as_py())))) for x in texts), pa.int64())

    return of.asNondeterministic()(text)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", words: int = WINDOW_WORDS) -> DataFrame:
    """`docs` (text, …) free of `benchmark`: without the documents that hold a window (`remove="documents"`), or with the
    hit spans cut out of their texts (`"spans"`), every row kept. Clean texts stay as they are, null ones null."""
    found = contamination(docs, benchmark, words)
    if remove == "documents":
        return found.where(F.col("leak.n_hit") == 0).drop("leak")
    if remove != "spans":
        raise ValueError("remove must be 'spans' or 'documents'")
    text, spans = F.col("text"), F.col("leak.spans")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    kept = F.zip_with(starts, ends, lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int")))
    return found.withColumn("text", F.when(F.size(spans) > 0, F.array_join(kept, "")).otherwise(text)).drop("leak")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS ws FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS id, {_WORDS} AS ws FROM benchmark),
windows AS (
    SELECT DISTINCT id, n, array_to_string(ws[i:i + n - 1], ' ') AS w
    FROM (SELECT id, ws, least({WINDOW_WORDS}, len(ws)) AS n, unnest(range(1, len(ws) - least({WINDOW_WORDS}, len(ws)) + 2)) AS i FROM items WHERE len(ws) > 0)
),
cuts AS (
    SELECT k, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
    FROM (SELECT k, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n)
),
hits AS (SELECT DISTINCT k, n, i, id FROM cuts JOIN windows USING (n, w)),
hit_words AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM hits) GROUP BY k),
hit_items AS (SELECT k, count(DISTINCT id) AS n_items, sha256(coalesce(string_agg(DISTINCT id, ',' ORDER BY id), '')) AS items_sha256 FROM hits GROUP BY k)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit_words USING (k) LEFT JOIN hit_items USING (k)
"""


@query("op13_decontamination", _SQL)
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "leak.n_words",
        "leak.n_hit",
        F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leak.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )
