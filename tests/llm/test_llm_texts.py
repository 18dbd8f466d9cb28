"""Secret scans and language identification."""

import hashlib
import random
import re
import string

import public_tokenizers
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from shelfline.llm import language_id, secret_scan

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RNG = random.Random(8)
RANDOM = ["".join(RNG.choice(string.ascii_letters + string.digits) for _ in range(n)) for n in (24, 32, 48)]
CASES = {
    "password=hunter22x and": [("assign", 0, 18)],
    "PassWord\"  :  'abcdefgh'": [("assign", 0, 23)],
    "token=short": [],
    "api-key=abcdefgh apikey=abcdefgh API_KEY: abcdefgh": [("assign", 17, 32), ("assign", 33, 50)],
    "pa\u017f\u017fword=abcdefgh to\u212aen=abcdefgh": [],
    "éé AKIAABCDEFGHIJKL AKIASHORT": [("access", 3, 19)],
    "x" * 3 + "0123456789abcdef" * 2 + "z": [("hex", 3, 35)],
    "secret=" + "0123456789abcdef" * 2: [("assign", 0, 39), ("hex", 7, 39)],
    "0123456789ABCDEF" * 2: [],
    "123e4567-e89b-12d3-a456-426614174000 2024-01-01-2024-01-01 document_identifier_of_the_page": [],
    "someCamelCaseIdentifierName THE_LONG_CONSTANT_NAME https://example.com/a/path/of/words": [],
    "gggg" * 10 + " " + "keitlichenlichkeitbe": [],
}


def brute_base(text):
    out = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    ascii_only = "".join(c if ord(c) < 128 else "\x00" for c in text)
    out += [(m.start(), 0, m.end()) for m in re.finditer(pattern, ascii_only, re.IGNORECASE) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def scanned(spark, texts):
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, spans string, kind int")
    return {r.doc_id: [tuple(s) for s in r.spans] for r in secret_scan.scan(df, *VOCABULARY).collect()}


def test_base_spans(spark):
    got = scanned(spark, list(CASES))
    assert [got[i] for i in range(len(CASES))] == list(CASES.values())


def test_random_strings_are_found(spark):
    texts = [f"ordinary words {s} and more words" for s in RANDOM]
    assert list(scanned(spark, texts).values()) == [[("random", 15, 15 + len(s))] for s in RANDOM]


def test_odd_rows(spark):
    assert scanned(spark, [None, "", " ", "word " * 50_000]) == {0: [], 1: [], 2: [], 3: []}
    assert scanned(spark, []) == {}


def test_redaction(spark):
    texts = [*CASES, None, "", f"a {RANDOM[0]} b {RANDOM[1]}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = secret_scan.scan(df, *VOCABULARY).withColumn("clean", secret_scan.redacted(F.col("text"), F.col("spans"))).collect()
    for r in rows:
        out, at = "", 0
        for kind, a, b in r.spans:
            if a >= at:
                out += r.text[at:a] + f"[{kind}]"
            at = max(at, b)
        assert r.clean == (out + r.text[at:] if r.spans else r.text)
    assert rows[-1].clean == "a [random] b [random]"


def test_op5_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = secret_scan.op5_secrets(spark, DATA).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = [f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in brute_base(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == base
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(b.startswith(k) for b in base) for k in secret_scan.KINDS[:3]]


@pytest.fixture(scope="module")
def language_rows(spark):
    return language_id.op6_language(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id"
    ).collect()


def test_op6_held_out_accuracy(language_rows):
    held = [r for r in language_rows if r.held_out]
    assert len(language_rows) == 1000 and 150 < len(held) < 250
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in language_rows)


def test_language_of_odd_rows(spark):
    rows = [(i, t, l, "x", 0.5) for i, (t, l) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 20)]
    rows += [(100, None, "en", "x", 0.5), (101, "", None, "x", 0.5), (102, "123 !?", "en", "x", 0.5), (103, "und der Hund", None, "x", 0.5)]
    rows += [(None, "the dog", "en", "x", 0.5), (104, "Z", None, "x", 0.5), (105, "the dog " * 40_000, None, "x", 0.5), (105, "the dog", None, "x", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, language string, score double")
    got = {(r.doc_id, r.text and r.text[:9]): (r.language.lang_pred, r.language.score) for r in language_id.identify(df).collect()}
    assert got[100, None] == got[101, ""] == got[102, "123 !?"] == ("und", 0.0)
    assert got[103, "und der H"][0] == "de" and got[None, "the dog"][0] == got[105, "the dog t"][0] == got[105, "the dog"][0] == "en"
    assert got[104, "Z"][0] in ("en", "de")
    assert language_id.identify(df.limit(0)).count() == 0
    assert {r.language.lang_pred for r in language_id.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_training_reads_about_its_bound(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'aaa bbb', 'ccc ddd') AS text", "if(id % 2 = 0, 'x', 'y') AS lang")
    model = language_id.train(df, per_language=200)
    assert [lang for lang, _ in model.score(["ab", "cd", None, "1"])] == ["x", "y", "und", "und"]


def test_ngrams_of_short_texts():
    assert [len(language_id.ngram_buckets(language_id.letters("abcd"[:n]))) for n in range(5)] == [0, 1, 3, 6, 9]


def found_spans(text):
    encoding = secret_scan._encoding(*VOCABULARY)
    return secret_scan.random_spans(text, secret_scan.base_spans(text), encoding)


@pytest.mark.parametrize("before", [
    "production_database_connection_string=", "/home/user/projects/configuration/production/credentials/",
    "https://example.com/documents/archive/information/download/", "",
])
def test_random_strings_behind_names_paths_and_urls(before):
    rng = random.Random(4)
    for n in [24] * 50 + [40] * 10:
        key = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
        text, start = f"some words {before}{key} and more", 11 + len(before)
        assert found_spans(text) == [(start, 3, start + n)]


def test_known_structures_in_a_run_are_no_secrets():
    uuid, digest = "123e4567-e89b-12d3-a456-426614174000", "0123456789ABCDEF" * 2
    for run in [f"documents/archive/{uuid}/page", f"name_of_the_document={digest}", "the-page-2024-01-01-2024-01-02", "a/path/of/words/and-more-words"]:
        assert found_spans(f"see {run} there") == []


@pytest.mark.parametrize("letters, n, least", [
    (string.ascii_lowercase, 24, 0.98), (string.ascii_lowercase, 32, 0.98), (string.ascii_uppercase, 32, 0.98), (string.ascii_letters, 24, 0.98),
    (string.ascii_letters + string.digits, 16, 0.98), (string.ascii_lowercase, 16, 0.75), (string.ascii_uppercase, 16, 0.9),
])
def test_random_strings_of_every_class_and_length(letters, n, least):
    rng = random.Random(6)
    for before in ("", "sk-"):
        found = 0
        for _ in range(400):
            text, start = f"some words {before}{''.join(rng.choices(letters, k=n))} and more", 11 + len(before)
            found += any(a <= start and start + n <= b for a, _, b in found_spans(text))
        assert found >= least * 400


def test_words_in_names_and_paths_are_no_secrets():
    for run in ["state-of-the-art-and-up-to-date-as-of-now", "AbstractSingletonProxyFactoryBean", "MAX_RETRY_COUNT_DEFAULT", "/usr/local/share/applications", "utf8mb4_unicode_520_ci", "2024-01-01T10-20-30-abc"]:
        assert found_spans(f"see {run} there") == []
