"""Cross-tokenizer alignment against the libraries and a merge written out byte by byte."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import DATA
from tokenizers import Tokenizer

from shelfline.llm import token_alignment as A

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None,
    "",
    " ",
    "a",
    "Hello world, it's 2024!",
    "  two  spaces\n\n\tand tabs ",
    "été 東京 😀 αβγ ﬁ ½ ﷺ",
    "has ▁ inside",
    "<|endoftext|> <s> </s> <unk> <0x0A>",
    "Hello world, it's 2024!",
    "x" * 5000,
    "word " * 4000,
    "\x00 nul \x1f\x7f​﻿",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    letters = {c: b for b, c in enumerate(A.byte_letters())}
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])

    def bytes_a(i):
        return bytes(letters[c] for c in a.id_to_token(i))

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()

    def encode(text):
        if not text:
            return [], []
        found = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = b" " + text.encode()
        same = b"".join(map(bytes_a, found[0])) == raw == b"".join(map(bytes_b, found[1]))
        return found if same else ([], [])

    return encode, bytes_a, bytes_b


def brute(text, libraries):
    """ids, links and groups from the byte ranges of all tokens."""
    encode, bytes_a, bytes_b = libraries
    ids = encode(text)
    ranges = []
    for side, of in zip(ids, (bytes_a, bytes_b), strict=True):
        at, out = 0, []
        for i in side:
            out.append((at, at + len(of(i))))
            at = out[-1][1]
        ranges.append(out)
    links, low = [], 0
    for i, (a, b) in enumerate(ranges[0]):
        while low < len(ranges[1]) and ranges[1][low][1] <= a:
            low += 1
        j = low
        while j < len(ranges[1]) and ranges[1][j][0] < b:
            links.append((i, j))
            j += 1
    common = {e for _, e in ranges[0]} & {e for _, e in ranges[1]}
    groups, cuts = [], []
    begin = 0
    for end in sorted(common):
        own = [[i for i, (x, y) in zip(side, r, strict=True) if begin <= x and y <= end] for side, r in zip(ids, ranges, strict=True)] if len(ids[0]) < 400 else None
        groups.append(own)
        cuts.append(tuple(next(k for k, r in enumerate(side) if r[1] == end) for side in ranges) if len(ids[0]) < 400 else None)
        begin = end
    return ids, links, groups, cuts


def digest(groups):
    if not groups:
        return ""
    return hashlib.sha256(";".join("|".join(",".join(map(str, side)) for side in g) for g in groups).encode()).hexdigest()


def test_encoders_equal_the_libraries(spark, libraries):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    a, b = A.encode_both(texts, *PATHS)
    for text, x, y in zip(texts, a, b, strict=True):
        assert (x, y) == tuple(map(list, libraries[0](text))), text


def test_long_white_space():
    """Longer than what tiktoken's splitter can stand, and equal to it below that."""
    a = A.ByteLevel(PATHS[0])
    for n in (100, A.LONG_SPACE, 2_000_000):
        text = " " * n + "x" + "\n" * 10
        (ids,) = a([text])
        assert b"".join(a.bytes[i] for i in ids) == b" " + text.encode()
    text = "\t" * 60_000 + "x"
    assert a([text]) == [a._encoding.encode_ordinary(" " + text)]


def test_links_and_cuts(spark, libraries):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, a_ids int")
    rows = {r.doc_id: r for r in A.token_links(df, *PATHS).collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids, links, groups, cuts = brute(text, libraries)
        assert (rows[i].a_ids, rows[i].b_ids) == (list(ids[0]), list(ids[1]))
        assert [tuple(x) for x in rows[i].links] == links
        assert len(rows[i].cuts) == len(groups)
        if len(ids[0]) < 400:
            assert [tuple(x) for x in rows[i].cuts] == cuts


def test_lanes_do_not_change_the_result():
    """Random token ends, with lanes of all lengths, also where no common end is near."""
    rng = random.Random(6)
    size = np.array([1, 2, 3, 7])
    for lane in (1, 2, 5, 1000):
        docs = []
        for _ in range(30):
            total = rng.choice([0, 1, 10, 300])
            sides = []
            for _ in range(2):
                left, ids = total, []
                while left:
                    i = rng.choice([k for k in range(4) if size[k] <= left])
                    ids.append(i)
                    left -= size[i]
                sides.append(ids)
            docs.append(sides)
        one = A.align([d[0] for d in docs], [d[1] for d in docs], size, size, lane)
        plain = A.align([d[0] for d in docs], [d[1] for d in docs], size, size, 1 << 30)
        assert sorted(zip(one.link_a, one.link_b, strict=True)) == sorted(zip(plain.link_a, plain.link_b, strict=True))
        assert (one.cut_a == plain.cut_a).all() and (one.cut_b == plain.cut_b).all()
        assert A.group_digests(one) == A.group_digests(plain)


def expected(texts, libraries):
    found = [brute(t, libraries) for t in texts]
    held = Counter()
    for ids, links, _, _ in found:
        held.update({(ids[0][i], ids[1][j]) for i, j in links})
    most = {}
    for (a, _), n in held.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for ids, links, groups, _ in found:
        n = [held[ids[0][i], ids[1][j]] for i, j in links]
        best = sum(c == most[ids[0][i]] for c, (i, _) in zip(n, links, strict=True))
        long = len(ids[0]) >= 400
        out.append((len(ids[0]), len(ids[1]), len(groups), len(links), best, sum(n), None if long else digest(groups)))
    return out, held, most


def test_counts(spark, libraries, monkeypatch):
    """Over several chunks, with null ids and repeated rows."""
    texts = TEXTS * 2
    df = spark.createDataFrame([(i or None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, chunk int").repartition(4)
    want, held, most = expected(texts, libraries)
    got = A.aligned(df, *PATHS).collect()
    assert len(got) == len(texts)
    for r in got:
        w = want[r.doc_id or 0]
        assert tuple(r)[1:7] == w[:6]
        assert w[6] is None or r.groups_sha256 == w[6]
    pairs = {(r.a_id, r.b_id): (r.n, r.top) for r in A.pair_counts(df, *PATHS).collect()}
    assert pairs == {p: (n, n == most[p[0]]) for p, n in held.items()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert A.aligned(df, *PATHS).count() == 0 == A.token_links(df, *PATHS).count()


def test_op11_query(spark, libraries):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    want = dict(zip(docs, expected(docs.values(), libraries)[0], strict=True))
    rows = A.op11_alignment(spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == want[r.doc_id][:6]
        assert want[r.doc_id][6] is None or r.groups_sha256 == want[r.doc_id][6]
    assert sum(w[6] is not None for w in want.values()) > 20
