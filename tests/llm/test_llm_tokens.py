"""Encoding, decoding, packing and counting against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import DATA
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm import bpe, packing, token_counts, words

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [
    None,
    "",
    " \t\n",
    "a<|endoftext|>b c<|startoftext|> <|endoftext|>",
    "ΑΣ ΣΑΣ İstanbul don't ''s it'S 12three ４ é é ﬁ ß",
    "x\x1cy \x1d z\x1e\x1f",
    "\x85a\xa0b　c d​e᠎f g",
    "日本語テキスト😀😀 👍🏽 \x00 ﻿ ́a",
    "a" * 700,
    "ab!?" * 300,
    "🇩🇪" * 90,
    "the of and " * 3000,
    "H\u0331 T\u0308 W\u030a Y\u030a J\u030c \u212a \u0130",
    "A<|ENDOFTEXT|>B THE Cat",
]
SCHEMA = "doc_id long, text string, ids string, n int, part string, start int, length string"


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2, "z") for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def real(spark):
    return [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").collect()]


@pytest.mark.parametrize("encoder", [bpe.SegmentTreeBpe(PATH), words.library_encoder(PATH)])
def test_memo_gives_the_library_ids(real, encoder):
    memo = words.WordMemo(encoder, words=500, pieces_=300)  # far fewer than there are
    for _ in range(2):
        found = [np.frombuffer(x, "<i4").tolist() for x in memo.ids(ODD + real)]
        assert found == [library_ids(t) for t in ODD + real]
    assert len(memo._words) <= 500


def test_segment_tree_on_random_pieces():
    encode, model, letters, rng = bpe.SegmentTreeBpe(PATH), LIBRARY.model, words.byte_letters(), random.Random(3)
    pieces = ["".join(rng.choice("aetinsohr" if k % 2 else "abé日!") for _ in range(rng.randint(1, 200))) for k in range(600)]
    for piece, ids in zip(pieces, encode(pieces), strict=True):
        assert ids.tolist() == [t.id for t in model.tokenize("".join(letters[b] for b in piece.encode()))]
        assert encode._one(piece.encode()).tolist() == ids.tolist() or len(piece.encode()) == 1


def test_encode_documents(spark):
    found = {r.doc_id: r for r in bpe.encode_documents(docs(spark, ODD), PATH).collect()}
    assert len(found) == len(ODD)
    for i, text in enumerate(ODD):
        assert found[i].ids == library_ids(text)
        assert found[i].decoded == LIBRARY.decode(library_ids(text), skip_special_tokens=False)
    assert bpe.encode_documents(docs(spark, []), PATH).count() == 0


def test_encode_and_decode_columns(spark):
    coded = docs(spark, ODD).select("doc_id", bpe.encode(F.col("text"), PATH).alias("ids")).withColumn("back", bpe.decode(F.col("ids"), PATH))
    for r in coded.collect():
        assert (r.ids, r.back) == (library_ids(ODD[r.doc_id]), LIBRARY.decode(library_ids(ODD[r.doc_id]), skip_special_tokens=False))
    assert spark.sql("SELECT cast(null AS array<int>) AS ids").select(bpe.decode(F.col("ids"), PATH)).first()[0] == ""


def test_op8_query(spark):
    for r in bpe.op8_bpe(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet"), "doc_id").collect():
        ids = library_ids(r.text)
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def check_pieces(pieces, expected, width):
    """Every id of every document once; sequences gapless, full but for the last."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(expected)
    for i, ids in expected.items():
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert bytes(p.ids) == np.array(ids[at : at + p.length], "<i4").tobytes()
            at += p.length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, parts in by_sequence.items():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == width or s == len(by_sequence) - 1 and at <= width


@pytest.mark.parametrize("width", [16, 2048])
@pytest.mark.parametrize("parts", [1, 5])
def test_packing(spark, width, parts):
    source = docs(spark, ODD).repartition(parts)
    pieces = packing.pack(source, PATH, width=width)
    check_pieces(pieces.collect(), {i: [*library_ids(t), 1] for i, t in enumerate(ODD)}, width)
    whole = packing.sequences(pieces, width).collect()
    assert {len(s.ids) for s in whole} == {4 * width}
    assert sum(s.length for s in whole) == sum(len(library_ids(t)) + 1 for t in ODD)


def test_packing_of_nothing_and_of_repeated_rows(spark):
    assert packing.pack(docs(spark, []), PATH).count() == 0
    twice = docs(spark, ["one two", "one two"]).selectExpr("cast(null as long) doc_id", "text")
    assert packing.pack(twice, PATH).selectExpr("sum(length)").first()[0] == 6


def test_op3_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for p in packing.op3_packing(spark, DATA).collect():
        ids = [*library_ids(texts[p.doc_id]), 1]
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())


def test_token_counts(spark, real):
    lengths = np.array([len(library_ids(t)) for t in ODD + real])
    answers = token_counts.limit_answers(token_counts.length_histogram(docs(spark, ODD + real), PATH)).cache()
    rows = answers.collect()
    assert sorted(r.length for r in rows) == sorted(set(lengths.tolist()))
    for r in rows:
        fits = lengths <= r.length
        assert (r.documents, r.tokens) == ((lengths == r.length).sum(), lengths[lengths == r.length].sum())
        assert (r.documents_fitting, r.tokens_fitting) == (fits.sum(), lengths[fits].sum())
        assert (r.documents_longer, r.tokens_longer) == ((~fits).sum(), lengths[~fits].sum())
        assert r.truncated_tokens == np.minimum(lengths, r.length).sum()
        assert r.quantile == fits.mean()
    for limit in (0, 1, 100, 777, 10**6):
        assert token_counts.truncated_total(answers, limit).first()[0] == np.minimum(lengths, limit).sum()
    for share in (0.1, 0.5, 0.99, 1.0):
        assert token_counts.length_quantile(answers, share).first()[0] == np.quantile(lengths, share, method="inverted_cdf")


def test_token_counts_of_nothing(spark):
    answers = token_counts.limit_answers(token_counts.length_histogram(docs(spark, []), PATH))
    assert answers.count() == 0
    assert token_counts.truncated_total(answers, 5).first()[0] == 0
    assert token_counts.length_quantile(answers, 0.5).first()[0] is None


def test_op9_query(spark, real):
    rows = token_counts.op9_token_counts(spark, DATA).collect()
    assert sum(r.documents for r in rows) == len(real)
    assert sum(r.tokens for r in rows) == sum(len(library_ids(t)) for t in real)


def test_latin_words_are_cut_without_normalising(monkeypatch):
    """The same pieces for every character, and no normalising of the words that most texts consist of."""

    def general(word):
        return words.PIECES.findall(words.unicodedata.normalize("NFC", word).replace("Σ", "σ").lower())

    for c in map(chr, [*range(0xD800), *range(0xE000, 0x11000), *range(0x1D400, 0x1D500)]):
        for word in (c, f"a{c}b", f"É{c},", f"A{c}1", f"{c}'s"):
            assert words.pieces(word) == general(word)
    monkeypatch.setattr(words.unicodedata, "normalize", None)
    assert [words.pieces(w) for w in ("", "Word", "Öl,", "it's", "a--1")] == [[], ["word"], ["öl", ","], ["it", "'s"], ["a", "--", "1"]]
