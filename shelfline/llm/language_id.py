"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are folded to lower-case letters and blanks; n-grams of one to three characters are hashed into 65,536 buckets. The model is a
matrix of log probabilities, buckets by languages, whose size does not depend on the corpus; it is broadcast. Tasks
score batches of documents as a sparse matrix of n-grams (bucket numbers with row offsets) in numpy.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.registry import query, table

BUCKETS = 1 << 16
#: Largest number of labelled documents, per language, that training is expected to read; they are chosen by a hash of doc_id.
TRAINING_DOCUMENTS = 4_000
#: More languages than this are refused: the matrix would no longer be small.
MAX_LANGUAGES = 256
SMOOTHING = 0.5
UNKNOWN = "und"
_AT_ONCE = 1 << 18
_BLANK = 32


@lru_cache(1)
def _fold() -> np.ndarray:
    """For every code point its lower-case letter, or a blank."""
    table_ = np.full(0x110000, _BLANK, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            table_[i] = ord(low) if len(low := c.lower()) == 1 else i
    return table_


def letters(text: str | None) -> np.ndarray:
    """The folded code points of a text."""
    raw = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    return _fold()[raw]


def ngram_buckets(folded: np.ndarray) -> np.ndarray:
    """Bucket numbers of all one-, two- and three-grams."""
    mixed = [folded * np.uint32(0x9E3779B1)]
    for n in (2, 3):
        if len(folded) >= n:
            mixed.append((mixed[-1][:-1] ^ (mixed[-1][:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + folded[n - 1 :] * np.uint32(0xC2B2AE35))
    key = np.concatenate(mixed)
    return (key ^ (key >> np.uint32(13))) * np.uint32(0x27D4EB2F) >> np.uint32(16)


@dataclass
class Model:
    languages: list[str]
    log_probability: np.ndarray  # buckets x languages
    log_prior: np.ndarray

    def score(self, texts: Iterable[str | None]) -> Iterator[tuple[str, float]]:
        """The likeliest language of each text and its posterior probability; `und` and 0 without letters or languages."""
        rows: list[np.ndarray] = []
        size = 0
        for text in texts:
            folded = letters(text)
            rows.append(ngram_buckets(folded) if (folded != _BLANK).any() else folded[:0])
            size += len(rows[-1])
            if size >= _AT_ONCE:
                yield from self._batch(rows)
                rows, size = [], 0
        yield from self._batch(rows)

    def _batch(self, rows: list[np.ndarray]) -> Iterator[tuple[str, float]]:
        full = [r for r in rows if len(r)] if self.languages else []
        answers = iter(())
        if full:
            starts = np.cumsum([0, *(len(r) for r in full[:-1])])
            sums = np.empty((len(full), len(self.languages)))
            columns = np.concatenate(full)
            for k in range(len(self.languages)):
                sums[:, k] = np.add.reduceat(self.log_probability[k][columns], starts, dtype=np.float64)
            sums += self.log_prior
            best = sums.argmax(axis=1)
            share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            answers = zip(best.tolist(), share.tolist(), strict=True)
        for r in rows:
            if len(r) and self.languages:
                k, p = next(answers)
                yield self.languages[k], p
            else:
                yield UNKNOWN, 0.0


def train(labelled: DataFrame, per_language: int = TRAINING_DOCUMENTS) -> Model:
    """A model from `labelled` (doc_id, text, lang); rows with a null in any of them teach nothing.

    From a language with more than `per_language` documents a share is drawn by a hash of doc_id, so that about that many
    are read, whole. Only the counts per language and bucket come to the driver. No rows give a model without languages.
    """
    usable = labelled.where("text is not null and lang is not null and doc_id is not null").select("doc_id", "text", "lang")
    found = usable.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [r["lang"] for r in found]
    if not languages:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros(0))
    share = F.lit(0.0)
    for r in found:
        share = F.when(F.col("lang") == r["lang"], min(1.0, per_language / r["count"])).otherwise(share)
    drawn = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    summed = drawn.select("lang", "text").mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = summed.toArrow()  # at most languages x buckets rows
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    at = {x: k for k, x in enumerate(languages)}
    counts[[at[x] for x in rows["lang"].to_pylist()], rows["bucket"].to_numpy()] += rows["n"].to_numpy()
    prior = np.array([r["count"] for r in found], float)
    return Model(
        languages,
        np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32),
        np.log(prior / prior.sum()),
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            seen = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
            seen += np.bincount(ngram_buckets(letters(text.as_py())), minlength=BUCKETS)
    for lang, seen in sums.items():
        full = np.flatnonzero(seen)
        yield pa.record_batch(
            [pa.array([lang] * len(full)), pa.array(full, pa.int32()), pa.array(seen[full])], ["lang", "bucket", "n"]
        )


def language(text: Column, model: Broadcast) -> Column:
    """Struct (lang_pred, score) for a text column, by a broadcast `Model`."""

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def of(texts: pa.Array) -> pa.Array:
        found = list(model.value.score(x.as_py() for x in texts))
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["lang_pred", "score"]
        )

    return of.asNondeterministic()(text)


def held_out(doc_id: Column) -> Column:
    """Documents from which nothing is learned: a fifth by a checksum of the id. A null id is neither held out nor learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, labelled: DataFrame | None = None, per_language: int = TRAINING_DOCUMENTS) -> DataFrame:
    """`docs` (doc_id, text, …) with a struct column `language` (lang_pred, score), from the text alone.

    `labelled` (doc_id, text, lang), by default `docs`, is learned from where it is not held out. Null texts and texts without
    letters are `und` with score 0 (a column `language` of the input is replaced), and so is every text if nothing was labelled. Repeated rows get the same answer each; no rows give no rows.
    """
    labelled = docs if labelled is None else labelled
    model = train(labelled.where(~held_out(F.col("doc_id"))), per_language)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn("language", language(F.col("text"), sent))


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score")
