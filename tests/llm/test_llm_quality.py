"""Quality measures and proven cutoffs against brute force."""

import math
import random
import re
from collections import Counter

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from shelfline.llm import quality_rules as Q
from shelfline.session import stored


def brute(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    covered = {j for i in range(len(found) - 4) if windows[tuple(found[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(found)
    return n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


ODD = [
    None,
    "",
    " \n\t\r\x0b\x0c ",
    "one two three four",
    "a b c d e",
    "a b c d e a b c d e",
    "a a a a a a a",
    "a a a a a",
    "x y z w v u x y z w v q r s t x y z w v",
    "line one\nline one\n\n \nline one \nother",
    "é#ü $%& \xa0nbsp | < > 日本",
    "w\x85x\x1cy",
    " lead and trail ",
    "word " * 30_000,
    " ".join(f"w{i % 5000}" for i in range(12_000)),
]


def measured(spark, rows, schema="doc_id long, text string, lang string, base string"):
    return Q.with_base_measures(spark.createDataFrame(rows, schema))


def test_base_measures(spark):
    rows = [(i, t, "en", "x") for i, t in enumerate(ODD)]
    got = {r.doc_id: tuple(r.base[k] for k in (*Q.BASE, "base_failed")) for r in measured(spark, rows).collect()}
    assert got == {i: brute(t) for i, t in enumerate(ODD)}


def test_base_measures_of_random_texts(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) + rng.choice(["", "\na b\na b"]) for _ in range(300)]
    got = {r.doc_id: tuple(r.base[k] for k in (*Q.BASE, "base_failed")) for r in measured(spark, [(i, t, "en", "") for i, t in enumerate(texts)]).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("n", [0, 1, 50, 299, 300, 5000])
@pytest.mark.parametrize("rate,error", [(0.01, 0.05), (0.2, 0.001)])
def test_exact_binomial_bound(spark, n, rate, error):
    cdf, best = 0.0, -1
    for k in range(n + 1):
        cdf += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(rate) + (n - k) * math.log1p(-rate))
        if cdf > error:
            break
        best = k
    got = spark.range(1).select(Q.allowed_errors(F.lit(n).cast("long"), rate, F.lit(error)).alias("k")).first().k
    assert got == best


def words(n, junk=""):
    return " ".join(f"word{i}{junk}" for i in range(n))


def test_cutoffs_are_proven_per_stratum(spark):
    """Junk is rejected where labels prove the rule; a stratum with few labels keeps it."""
    rows = [(i, words(12), "en") for i in range(2500)] + [(i, words(12, "##"), "en") for i in range(2500, 2600)]
    rows += [(i, words(12), "de") for i in range(3000, 3040)] + [(3999, words(12, "##"), "de"), (4000, words(12, "##"), None), (None, words(12), "en")]
    labels = [(i, 1, 0) for i in range(2500)] + [(i, 0, 0) for i in range(2500, 2600)] + [(i, 1, 0) for i in range(3000, 3040)] + [(None, 1, 0), (5, None, 0)]
    docs = stored(measured(spark, rows, "doc_id long, text string, lang string"))
    got = Q.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    rejected = {r.doc_id: r.rejected_by for r in got if not r.kept}
    assert set(rejected) == set(range(2500, 2600)) and all("symbols_per_char" in x for x in rejected.values())


def test_no_cutoff_beyond_the_allowed_rate(spark):
    """5 % of the good documents have symbols, so no cutoff below their share can be proven."""
    rows = [(i, words(12, "##" if i % 20 == 0 else ""), "en") for i in range(3000)]
    labels = spark.createDataFrame([(i, 1) for i in range(3000)], "doc_id long, quality int")
    docs = stored(measured(spark, rows, "doc_id long, text string, lang string"))
    proven = Q.cutoffs(docs.withColumn("stratum", F.col("lang")), labels).first().cutoffs
    assert proven["symbols_per_char"] >= 24 / 86 and all(r.kept for r in Q.judge(docs, labels).collect())


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = stored(measured(spark, [(1, words(12, "###"), "en", ""), (1, "short", "en", ""), (2, None, None, "")]))
    assert sorted((r.doc_id, r.kept) for r in Q.judge(docs, none).collect()) == [(1, False), (1, True), (2, False)]
    assert Q.judge(stored(docs.limit(0)), none).count() == 0


def test_op2_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = Q.op2_quality(spark, DATA).collect()
    assert {r.doc_id: tuple(r[k] for k in (*Q.BASE, "base_failed")) for r in got} == {i: brute(t) for i, t in texts.items()}
    assert not any(r.kept and r.base_failed for r in got)
