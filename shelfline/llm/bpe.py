"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs, and decoding.

For each piece of text the leaves of a tree hold the rank of the pair that starts at each symbol (none: infinity), joined
with its place. A node is the minimum of its children, so the root is the leftmost pair of lowest rank. Merging it changes
three leaves, its own and those beside it, and the nodes above them: logarithmic work, until the root is infinite. Pieces of
about the same length are worked on together, one row of a matrix each, so the tree's steps are numpy operations over all.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.registry import query, table
from shelfline.llm.words import SPECIAL, WORD_END, WordMemo, byte_letters, id_lists, slices

#: Pieces with more symbols than this are worked on one by one, so that a matrix stays small.
LONG_PIECE = 128
_NONE = np.iinfo(np.int64).max


class SegmentTreeBpe:
    """Encoder of pieces from the merges of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.tokens = [""] * (max([*vocab.values(), *SPECIAL.values()]) + 1)
        for text, i in [*vocab.items(), *SPECIAL.items()]:
            self.tokens[i] = text
        self._inner = np.array([vocab[c] for c in byte_letters()])
        self._last = np.array([vocab[c + WORD_END] for c in byte_letters()])
        self._width = len(self.tokens)
        keys = np.array([vocab[a] * self._width + vocab[b] for a, b in merges])
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order
        self._made = np.array([vocab[a + b] for a, b in merges])
        self._by_pair = {int(k): int(r) for k, r in zip(self._keys, self._ranks, strict=True)}

    def __call__(self, pieces: list[str]) -> list[np.ndarray]:
        raw = [p.encode() for p in pieces]
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(raw)
        classes: dict[int, list[int]] = {}
        for i, b in enumerate(raw):
            if len(b) > LONG_PIECE:
                out[i] = self._one(b)
            elif b:
                classes.setdefault(1 << (len(b) - 1).bit_length(), []).append(i)
        for width, members in classes.items():
            for k in range(0, len(members), 4096):
                some = members[k : k + 4096]
                for i, ids in zip(some, self._many([raw[j] for j in some], width), strict=True):
                    out[i] = ids
        return out

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self._width + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], -1)

    def _many(self, raw: list[bytes], width: int) -> list[np.ndarray]:
        n, levels = len(raw), width.bit_length() - 1
        lengths = np.fromiter(map(len, raw), np.int64, n)
        places = np.arange(width)
        text = np.frombuffer(b"".join(b.ljust(width, b"\0") for b in raw), np.uint8).reshape(n, width)
        ids = np.where(places == lengths[:, None] - 1, self._last[text], self._inner[text])
        there = places < lengths[:, None]
        after = np.tile(places + 1, (n, 1))  # next symbol's place
        before = np.tile(places - 1, (n, 1))

        tree = np.full((n, 2 * width), _NONE)
        rank = self._pair_ranks(ids[:, :-1], ids[:, 1:])
        leaf = np.where((rank >= 0) & there[:, 1:], rank * width + places[:-1], _NONE)
        tree[:, width : 2 * width - 1] = leaf
        for k in range(levels - 1, -1, -1):
            low, high = 1 << k, 2 << k
            tree[:, low:high] = np.minimum(tree[:, 2 * low : 2 * high : 2], tree[:, 2 * low + 1 : 2 * high : 2])

        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            root = tree[rows, 1]
            at, rank = root % width, root // width
            gone = after[rows, at]
            following = after[rows, gone]
            ids[rows, at] = self._made[rank]
            there[rows, gone] = False
            after[rows, at] = following
            inside = following < lengths[rows]
            before[rows[inside], following[inside]] = at[inside]
            tree[rows, width + gone] = _NONE
            right = np.where(inside, following, 0)
            rank = np.where(inside, self._pair_ranks(ids[rows, at], ids[rows, right]), -1)
            tree[rows, width + at] = np.where(rank >= 0, rank * width + at, _NONE)
            left = before[rows, at]
            has = left >= 0
            left = np.where(has, left, 0)
            rank = np.where(has, self._pair_ranks(ids[rows, left], ids[rows, at]), -1)
            changed = np.where(rank >= 0, rank * width + left, _NONE)
            tree[rows, width + left] = np.where(has, changed, tree[rows, width + left])
            nodes = [width + gone, width + at, width + left]
            for _ in range(levels):
                nodes = [x >> 1 for x in nodes]
                for x in nodes:
                    tree[rows, x] = np.minimum(tree[rows, 2 * x], tree[rows, 2 * x + 1])
            rows = rows[tree[rows, 1] != _NONE]
        kept = ids[there]
        return np.split(kept, np.cumsum(there.sum(axis=1))[:-1])

    def _one(self, raw: bytes) -> np.ndarray:
        """The same for one long piece, in plain lists: numpy calls on single rows cost more than they save."""
        n = len(raw)
        width = 1 << (n - 1).bit_length()
        ids = [*self._inner[np.frombuffer(raw[:-1], np.uint8)].tolist(), int(self._last[raw[-1]])]
        after, before, there = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        ranks, pair_width, none = self._by_pair, self._width, int(_NONE)

        def leaf(place: int) -> int:
            rank = ranks.get(ids[place] * pair_width + ids[after[place]]) if after[place] < n else None
            return none if rank is None else rank * width + place

        tree = [none] * width + [leaf(i) for i in range(n)] + [none] * (width - n)
        for x in range(width - 1, 0, -1):
            tree[x] = min(tree[2 * x], tree[2 * x + 1])

        def put(place: int, value: int) -> None:
            x = width + place
            tree[x] = value
            while x > 1:
                x >>= 1
                tree[x] = min(tree[2 * x], tree[2 * x + 1])

        while (root := tree[1]) != none:
            rank, at = divmod(root, width)
            gone = after[at]
            ids[at], there[gone], after[at] = int(self._made[rank]), False, after[gone]
            if after[at] < n:
                before[after[at]] = at
            put(gone, none)
            put(at, leaf(at))
            if before[at] >= 0:
                put(before[at], leaf(before[at]))
        return np.array([x for x, alive in zip(ids, there, strict=True) if alive], np.int64)


@lru_cache(2)
def _bpe(path: str) -> SegmentTreeBpe:
    return SegmentTreeBpe(path)


@lru_cache(2)
def _names(path: str) -> pa.Array:
    return pa.array(_bpe(path).tokens)


@lru_cache(2)
def _memo(path: str) -> WordMemo:
    return WordMemo(_bpe(path))


def encode(text: Column, path: str) -> Column:
    """Ids of a text column as array<int>, as with the vocabulary file at `path` on every executor; null is empty."""

    @F.arrow_udf("array<int>")
    def of(texts: pa.Array) -> pa.Array:
        return id_lists(_memo(path).ids(x.as_py() for x in texts))

    return of.asNondeterministic()(text)


def _join_tokens(lists: pa.Array, path: str) -> pa.Array:
    """This vocabulary has no decoder: a text is its tokens with a space between them."""
    names = _names(path).take(lists.values)
    return pc.fill_null(pc.binary_join(pa.ListArray.from_arrays(lists.offsets, names), " "), "")


def decode(ids: Column, path: str) -> Column:
    """Text of a column of ids, as with the vocabulary file at `path`; null is empty. An id outside of the vocabulary raises an error."""

    @F.arrow_udf("string")
    def of(lists: pa.Array) -> pa.Array:
        if lists.null_count:
            lists = id_lists(b"" if x is None else np.array(x, "<i4").tobytes() for x in lists.to_pylist())
        return _join_tokens(lists, path)

    return of.asNondeterministic()(ids)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) for every row of `docs` (doc_id, text).

    Null and empty texts have no ids and decode to an empty text; repeated rows are encoded each; other columns are
    ignored; no rows give no rows.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 1):
                ids = id_lists(_memo(path).ids(x.as_py() for x in some.column(1)))
                yield pa.record_batch([some.column(0), ids, _join_tokens(ids, path)], ["doc_id", "ids", "decoded"])

    schema = docs.select("doc_id").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")
    return docs.select("doc_id", "text").mapInArrow(code, schema)


@query("op8_bpe")
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
