"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, by lockstep merging of whole batches.

Both tokenizers cut the same bytes, so their tokens are two ascending lists of end offsets and aligning them is a merge: link
the two current tokens, then advance the one that ends first, or both, which is a cut. One numpy vector holds the pointers of all documents
of a batch. Every step emits a link for each, advances them together and drops those that are finished. So that a batch's longest document does
not walk alone, documents are entered at several places: every LANE tokens at the next offset where both tokenizers end a token.

A pair of ids counts the documents that hold it linked. A batch of documents is a chunk with a list of its distinct pairs; its
documents refer to that list. Only the lists are summed up over the corpus, joined with the totals and brought back to their chunks, so what is shuffled per
chunk is bounded by its bytes, and no table of the corpus's pairs is held in one place.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.registry import query, table
from shelfline.llm.words import byte_letters, slices
from shelfline.session import stored

#: Tokens of a lane, about, and how far a common end is searched for beyond them.
LANE, REACH = 512, 64
_SPACE = "▁"
#: White-space characters in a row from which on a text is left to the slower library.
LONG_SPACE = 50_000
_LONG_SPACE = re.compile(rf"\s{{{LONG_SPACE}}}")
#: How the byte-level vocabulary splits a text before merging; a fixed value of its file's kind.
_PATTERN = public_tokenizers.PATTERN


class ByteLevel:
    """Tokenizer A: byte-level BPE from a `tokenizers` file. Ids are ranks, so tiktoken's encoder gives the same ids faster."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"] for t in model["added_tokens"]}
        byte = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(byte[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
        self.bytes = [b""] * (max(model["model"]["vocab"].values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token
        self._encoding = tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._path = path

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [self._by_library(t) if len(t) > LONG_SPACE and _LONG_SPACE.search(t) else self._encoding.encode_ordinary(" " + t) for t in texts]

    def _by_library(self, text: str) -> list[int]:
        """For white space so long that tiktoken's splitter runs out of stack."""
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self._path)
        library.encode_special_tokens = True
        return library.encode(" " + text, add_special_tokens=False).ids


class Pieces:
    """Tokenizer B: a sentencepiece model, which puts the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(self._model.id_to_piece(i)[3:5], 16)]) if self._model.is_byte(i) else self._model.id_to_piece(i).replace(_SPACE, " ").encode()
            for i in range(self._model.get_piece_size())
        ]

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


@lru_cache(2)
def _tokenizers(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces, np.ndarray, np.ndarray]:
    a, b = ByteLevel(path_a), Pieces(path_b)
    return a, b, *(np.array([len(x) for x in t.bytes], np.int64) for t in (a, b))


class Aligned(NamedTuple):
    """A batch: ids of both sides one document after another, links and cuts as places in them, and each document's first places.

    `cut_a` and `cut_b` are the last tokens of each group, ascending.
    """

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray


def encode_both(texts: list[str | None], path_a: str, path_b: str) -> tuple[list[list[int]], list[list[int]]]:
    """Ids of every text; none on either side where it is null or empty or the tokens' bytes differ from space and text."""
    a, b, _, _ = _tokenizers(path_a, path_b)
    there = [i for i, t in enumerate(texts) if t]
    some = [texts[i] for i in there]
    out: tuple[list, list] = [[] for _ in texts], [[] for _ in texts]
    for i, text, ids_a, ids_b in zip(there, some, a(some), b(some), strict=True):
        raw = b" " + text.encode()
        if b"".join(map(a.bytes.__getitem__, ids_a)) == raw and b"".join(map(b.bytes.__getitem__, ids_b)) == raw:
            out[0][i], out[1][i] = ids_a, ids_b
    return out


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    values = np.concatenate([np.array(x, np.int32) for x in ids]) if ids else np.zeros(0, np.int32)
    return values.astype(np.int32), np.concatenate([[0], np.cumsum(lengths)])


def align(ids_a: list[list[int]], ids_b: list[list[int]], size_a: np.ndarray, size_b: np.ndarray, lane: int = LANE) -> Aligned:
    """Links and cuts of a batch of documents, whose tokens have `size_a` and `size_b` bytes by id."""
    (a, first_a), (b, first_b) = _flat(ids_a), _flat(ids_b)
    # Offsets over the whole batch: documents' ends are common to both sides.
    end_a, end_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    at_a, at_b = _lanes(end_a, end_b, first_a, first_b, lane)
    stop = np.append(at_a[1:], len(a))
    links, cuts = [], []
    while len(at_a):
        links.append((at_a, at_b))
        ahead_a, ahead_b = end_a[at_a], end_b[at_b]
        cut = ahead_a == ahead_b
        cuts.append((at_a[cut], at_b[cut]))
        at_a, at_b = at_a + (ahead_a <= ahead_b), at_b + (ahead_b <= ahead_a)
        going = at_a < stop
        if not going.all():
            at_a, at_b, stop = at_a[going], at_b[going], stop[going]
    none = np.zeros(0, np.int64)
    link_a, link_b = (np.concatenate([none, *(x[k] for x in links)]) for k in range(2))
    cut_a, cut_b = (np.sort(np.concatenate([none, *(x[k] for x in cuts)])) for k in range(2))
    return Aligned(a, b, first_a, first_b, link_a, link_b, cut_a, cut_b)


def _lanes(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """First tokens of the lanes: those of all documents with tokens, and after common ends about every `lane` tokens."""
    filled = np.diff(first_a) > 0
    places = np.arange(lane, len(end_a), lane)
    near = places[:, None] + np.arange(REACH)
    near = np.minimum(near, len(end_a) - 1)
    hit = np.searchsorted(end_b, end_a[near])
    common = end_b[np.minimum(hit, len(end_b) - 1)] == end_a[near] if len(end_b) else np.zeros(near.shape, bool)
    found = common.any(axis=1)
    column = common.argmax(axis=1)[found]
    rows = np.flatnonzero(found)
    extra_a, extra_b = near[rows, column] + 1, hit[rows, column] + 1
    starts = np.unique(np.concatenate([first_a[:-1][filled], extra_a[extra_a < len(end_a)]]))
    both = dict(zip(extra_a.tolist(), extra_b.tolist(), strict=True)) | dict(zip(first_a[:-1][filled].tolist(), first_b[:-1][filled].tolist(), strict=True))
    return starts, np.array([both[x] for x in starts.tolist()], np.int64)


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below n, six bytes each of which the unused ones and the last are zero; and how many digits."""
    width = len(str(max(n - 1, 1)))
    text = np.array([str(i) for i in range(n)], f"S{width + 1}")
    return text.view(np.uint8).reshape(n, width + 1), np.char.str_len(text)


@lru_cache(2)
def _digit_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _digits(n)


def group_digests(found: Aligned) -> list[str]:
    """SHA-256 of each document's groups, `a,a|b` joined by semicolons; an empty text without tokens."""
    n_a, n_b = len(found.a), len(found.b)
    if not n_a:
        return [""] * (len(found.first_a) - 1)
    group_a = np.searchsorted(found.cut_a, np.arange(n_a))
    group_b = np.searchsorted(found.cut_b, np.arange(n_b))
    place_a = np.arange(n_a) + np.concatenate([[0], found.cut_b + 1])[group_a]
    place_b = np.arange(n_b) + (found.cut_a + 1)[group_b]
    ids, marks = np.empty(n_a + n_b, np.int32), np.full(n_a + n_b, ord(","), np.uint8)
    ids[place_a], ids[place_b] = found.a, found.b
    marks[place_a[found.cut_a]] = ord("|")
    marks[place_b[found.cut_b]] = ord(";")
    digits, lengths = _digit_table(int(ids.max()) + 1 if ids.max() >= 1 << 17 else 1 << 17)
    text = digits[ids]
    text[np.arange(len(ids)), lengths[ids]] = marks
    flat = text.reshape(-1)
    flat = flat[flat != 0].tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths[ids] + 1)])[found.first_a + found.first_b].tolist()
    return [hashlib.sha256(flat[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(ends, ends[1:], strict=False)]


def _packed(values: np.ndarray) -> bytes:
    """Numbers from zero on in the fewest bytes each, their width first."""
    top = int(values.max(initial=0))
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _id(docs: DataFrame) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"


def _encoded(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document, its distinct pairs as places in the chunk's list and how often each is linked; and one row per chunk
    with the list itself and how many documents hold each pair."""
    measures = ["n_a", "n_b", "n_groups", "n_links"]
    schema = (
        f"{_id(docs)}, at long, is_doc boolean, {', '.join(f'{c} long' for c in measures)}, "
        "groups_sha256 string, places binary, times binary, pairs array<long>, held array<int>"
    )
    names = [c.split()[0] for c in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, b, size_a, size_b = _tokenizers(path_a, path_b)
        at = 0
        for some in (x for batch in batches for x in slices(batch, 1)):
            n = some.num_rows
            found = align(*encode_both(some.column(1).to_pylist(), path_a, path_b), size_a, size_b)
            doc_of = np.repeat(np.arange(n), np.diff(found.first_a))
            codes = found.a[found.link_a].astype(np.int64) * len(b.bytes) + found.b[found.link_b]
            listed, place = np.unique(codes, return_inverse=True)
            keys, times = np.unique(doc_of[found.link_a] * max(len(listed), 1) + place, return_counts=True)
            doc, place = np.divmod(keys, max(len(listed), 1))
            held = np.bincount(place, minlength=len(listed))
            bounds = np.searchsorted(doc, np.arange(n + 1)).tolist()
            own = [(place[x:y], times[x:y]) for x, y in zip(bounds, bounds[1:], strict=False)]
            groups = np.bincount(doc_of[found.cut_a], minlength=n)
            links = np.bincount(doc_of[found.link_a], minlength=n)
            yield pa.record_batch(
                [
                    some.column(0),
                    pa.array([at] * n, pa.int64()),
                    pa.array([True] * n),
                    *(pa.array(x.astype(np.int64)) for x in (np.diff(found.first_a), np.diff(found.first_b), groups, links)),
                    pa.array(group_digests(found), pa.string()),
                    pa.array([_packed(np.diff(p, prepend=0)) for p, _ in own], pa.binary()),
                    pa.array([_packed(t) for _, t in own], pa.binary()),
                    pa.nulls(n, pa.list_(pa.int64())),
                    pa.nulls(n, pa.list_(pa.int32())),
                ],
                names=names,
            )
            if len(listed):
                one = [pa.nulls(1, some.column(0).type), pa.array([at], pa.int64()), pa.array([False]), *(pa.nulls(1, pa.int64()) for _ in measures)]
                one += [pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())]
                one += [pa.array([listed], pa.list_(pa.int64())), pa.array([held.astype(np.int32)], pa.list_(pa.int32()))]
                yield pa.record_batch(one, names=names)
            at += 1

    rows = docs.select("doc_id", "text").mapInArrow(work, schema)
    return rows.withColumn("chunk", F.shiftleft(F.spark_partition_id().cast("long"), 32) + F.col("at")).drop("at")


def _listed(encoded: DataFrame) -> DataFrame:
    """(chunk, place, pair, held): the lists of all chunks."""
    return encoded.where("not is_doc").select("chunk", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "p")).select(
        "chunk", "place", "p.pairs", "p.held"
    ).withColumnRenamed("pairs", "pair")


def _pair_counts(encoded: DataFrame, width: int) -> DataFrame:
    """(pair, n, top): in how many documents a pair is linked, and whether no pair with the same A id is in more."""
    totals = stored(_listed(encoded).groupBy("pair").agg(F.sum("held").alias("n")))
    most = totals.groupBy(F.expr(f"pair div {width}").alias("a")).agg(F.max("n").alias("most"))
    return stored(totals.join(most, F.expr(f"pair div {width} = a")).select("pair", "n", (F.col("n") == F.col("most")).alias("top")))


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(a_id, b_id, n, top) for every pair of ids that is linked in `docs` (doc_id, text): the number of rows that hold it, and
    whether that is the highest of its A id. See `aligned` for odd rows."""
    width = _width(path_b)
    counts = _pair_counts(stored(_encoded(docs, path_a, path_b)), width)
    return counts.select(F.expr(f"pair div {width}").alias("a_id"), (F.col("pair") % width).alias("b_id"), "n", "top")


def _width(path_b: str) -> int:
    return len(Pieces(path_b).bytes)


def token_links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, a_ids, b_ids, links, cuts) for every row of `docs` (doc_id, text): ids of both tokenizers, links and cuts as
    places in them (array<struct<a, b>>), links in the documents' order, a cut being the last tokens of a group. See `aligned` for odd rows."""
    pair = "array<struct<a: int, b: int>>"
    schema = f"{_id(docs)}, a_ids array<int>, b_ids array<int>, links {pair}, cuts {pair}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, size_a, size_b = _tokenizers(path_a, path_b)
        for some in (x for batch in batches for x in slices(batch, 1)):
            found = align(*encode_both(some.column(1).to_pylist(), path_a, path_b), size_a, size_b)
            order = np.lexsort((found.link_b, found.link_a))
            links = _per_doc(found.link_a[order], found.link_b[order], found)
            ids = [
                pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(x, pa.int32()))
                for first, x in ((found.first_a, found.a), (found.first_b, found.b))
            ]
            yield pa.record_batch([some.column(0), *ids, links, _per_doc(found.cut_a, found.cut_b, found)], names=["doc_id", "a_ids", "b_ids", "links", "cuts"])

    return docs.select("doc_id", "text").mapInArrow(work, schema)


def _per_doc(a: np.ndarray, b: np.ndarray, found: Aligned) -> pa.Array:
    bounds = np.searchsorted(a, found.first_a)
    doc = np.repeat(np.arange(len(found.first_a) - 1), np.diff(bounds))
    own = [pa.array((x - first[doc]).astype(np.int32)) for x, first in ((a, found.first_a), (b, found.first_b))]
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.StructArray.from_arrays(own, ["a", "b"]))


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of `docs` (doc_id, text).

    `n_best` are the links whose pair of ids is in no fewer documents than any other with its A id, `count_sum` adds the pairs'
    document counts up over the links. Rows whose text is null or empty, or whose tokens don't spell space and text, have no tokens: zeros and an empty text.
    Repeated rows, and rows with a null doc_id, are documents of their own. Other columns are ignored; no rows give no rows. A text is
    worked on whole; a task's memory grows with the longest one, by some 60 bytes a byte.
    """
    encoded = stored(_encoded(docs, path_a, path_b))
    counts = _pair_counts(encoded, _width(path_b))
    known = _listed(encoded).drop("held").join(counts, "pair").select("chunk", "place", "n", "top")
    rows = encoded.where("is_doc").drop("is_doc", "pairs", "held").withColumnRenamed("chunk", "own_chunk")
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    names = [*kept, "n_best", "count_sum", "groups_sha256"]
    schema = f"{_id(docs)}, {', '.join(f'{c} long' for c in names[1:-1])}, groups_sha256 string"

    def work(own: pa.Table, listed: pa.Table) -> pa.Table:
        n, top = np.zeros(listed.num_rows, np.int64), np.zeros(listed.num_rows, np.int64)
        place = listed.column("place").to_numpy()
        n[place], top[place] = listed.column("n").to_numpy(), listed.column("top").to_numpy()
        best, total = [], []
        for places, times in zip(own.column("places").to_pylist(), own.column("times").to_pylist(), strict=True):
            places, times = np.cumsum(_unpacked(places)), _unpacked(times)
            best.append(int((times * top[places]).sum()))
            total.append(int((times * n[places]).sum()))
        columns = [*(own.column(c) for c in kept), pa.array(best, pa.int64()), pa.array(total, pa.int64()), own.column("groups_sha256")]
        return pa.table(columns, names=names)

    return rows.groupBy("own_chunk").cogroup(known.groupBy("chunk")).applyInArrow(work, schema)


@query("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
