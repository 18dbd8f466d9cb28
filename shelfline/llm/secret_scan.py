"""Secrets in texts: known forms by pattern, and random strings by how badly a tokenizer compresses them.

A vocabulary made from ordinary text needs few tokens for words and many for random strings. Strings of key-like characters whose
characters-per-token ratio is low are reported, after digests, UUIDs and numbers are excluded: they are random as well, but no secrets.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left
from functools import lru_cache
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.registry import query, table

#: The kinds in the order of the report, and the base patterns with the length that a match must have.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 8, 16

#: A random string has this many characters or more, and fewer characters per token than this; below SURE_LENGTH, fewer than SHORT_CHARS_PER_TOKEN.
RANDOM_LENGTH, SURE_LENGTH = 16, 20
CHARS_PER_TOKEN, SHORT_CHARS_PER_TOKEN = 2.2, 1.8
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % RANDOM_LENGTH)
_PART = re.compile(r"[^/=_-]+")
_UUID = re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Za-z])")
#: Known digests (MD5, SHA-1, SHA-2 in hexadecimal), numbers, and a few characters again and again.
_STRUCTURED = re.compile(
    r"[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{56}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{96}|[0-9A-Fa-f]{128}|[0-9+=/_-]+|(.{1,4}?)\1{3,}"
)


@lru_cache(2)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, encoding="ascii") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, file)}
    return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the pattern matches, in code points, by start and kind."""
    found = []
    for m in ASSIGN.finditer(text):
        if m.end(1) - m.start(1) >= ASSIGN_LENGTH:
            found.append((m.start(), 0, m.end()))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= ACCESS_LENGTH:
            found.append((m.start(), 1, m.end()))
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _random_looking(part: str, encoding: tiktoken.Encoding) -> bool:
    """A part of a run, of any length, with few characters per token; digests, numbers and single tokens are none."""
    if part.isdigit() or _STRUCTURED.fullmatch(part):
        return False
    tokens = len(encoding.encode_ordinary(part))
    return tokens > 1 and len(part) < CHARS_PER_TOKEN * tokens


def _random_in(run: str, encoding: tiktoken.Encoding) -> list[tuple[int, int]]:
    """(start, end) of the longest stretches of random-looking parts of a run that are random as a whole.

    It is the whole run if random-looking parts make up half of it, and if more than words would be left of it.
    """
    stretches, words, looking, whole = [], True, 0, [m.span() for m in _UUID.finditer(run)]
    at_end = False  # the last part was random-looking
    for m in _PART.finditer(run):
        if any(a < m.end() and m.start() < b for a, b in whole):
            at_end = False
        elif _random_looking(m.group(), encoding):
            if at_end:
                stretches[-1] = (stretches[-1][0], m.end())
            else:
                stretches.append(m.span())
            at_end, looking = True, looking + len(m.group())
        else:
            at_end = False
            words &= m.group().isalpha()
    found = [(a, b) for a, b in stretches if _is_random(run[a:b], encoding)]
    if found and words and len(found) == len(stretches):
        return found
    return [(0, len(run))] if 2 * looking >= len(run) and _is_random(run, encoding) else found


def _is_random(string: str, encoding: tiktoken.Encoding) -> bool:
    if len(string) < RANDOM_LENGTH or _STRUCTURED.fullmatch(string):
        return False
    limit = CHARS_PER_TOKEN if len(string) >= SURE_LENGTH else SHORT_CHARS_PER_TOKEN
    return len(string) < limit * len(encoding.encode_ordinary(string))


def random_spans(text: str, base: list[tuple[int, int, int]], encoding: tiktoken.Encoding) -> list[tuple[int, int, int]]:
    """Key-like strings of letters and digits with few characters per token that no base span overlaps.

    Names, paths and addresses around a key would hide it, so the parts of a run between / = _ - are tested as well as the whole run. The span is
    that of the parts, or of the whole run.
    """
    found = []
    starts = [x for x, _, _ in base]  # ascending; and the furthest end of all spans up to each
    ends = list(accumulate((y for _, _, y in base), max))
    for m in _CANDIDATE.finditer(text):
        for a, b in ((m.start() + a, m.start() + b) for a, b in _random_in(m.group(), encoding)):
            before = bisect_left(starts, b)
            if not before or ends[before - 1] <= a:
                found.append((a, 3, b))
    return found


def secret_spans(text: Column, path: str, pattern: str) -> Column:
    """array<struct<kind, start, end>> for a text column, by start and kind; null is empty.

    Positions are code points, ends exclusive. `path` is a tiktoken vocabulary on every executor, `pattern` how it splits text.
    """

    @F.arrow_udf("array<struct<kind: string, start: int, end: int>>")
    def of(texts: pa.Array) -> pa.Array:
        encoding, out = _encoding(path, pattern), []
        for x in texts:
            s = x.as_py() or ""
            base = base_spans(s)
            spans = sorted(base + random_spans(s, base, encoding))
            out.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans])
        return pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))

    return of.asNondeterministic()(text)


def scan(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """`docs` (text, …) with a column `spans`: every row is kept, a row without secrets has none.

    Null and empty texts have none; repeated rows are scanned each; a column `spans` of the input is replaced; no rows give no rows.
    """
    return docs.withColumn("spans", secret_spans(F.col("text"), path, pattern))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by `[kind]`; a text without spans stays as it is."""
    parts = F.aggregate(
        spans,
        F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            F.when(s["start"] < a["at"], a["done"])
            .otherwise(F.concat(a["done"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit("["), s["kind"], F.lit("]")))
            .alias("done"),
            F.greatest(a["at"], s["end"]).alias("at"),
        ),
        lambda a: F.concat(a["done"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, parts).otherwise(text)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    def of_kind(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of_kind(k) for k in KINDS]
    base = F.filter("spans", lambda s: s["kind"] != KINDS[-1])
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )
