"""Quality rules whose cutoffs carry a guarantee: few good documents are rejected, in every stratum.

Each rule compares one measure of a document with a cutoff. Labelled documents are the holdout: for every stratum (language), rule
and candidate cutoff, the good documents that the cutoff would reject are counted, and the exact binomial bound tells whether the rate of
false rejections can still be above the allowed one. The strictest cutoff that passes is used. All tests of all strata,
rules share the error probability by Bonferroni's correction; the cutoffs of one rule are tested from lenient to strict until one fails,
which needs no further share. The rules of a stratum share the allowed rate, so with probability 1 - ERROR no stratum loses
more than RATE of its good documents to the rules together. A stratum with too few labels for a proof has no cutoff:
there only the base rule rejects.

Everything is built from DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.registry import query, table
from shelfline.session import stored

#: Allowed rate of false rejections in a stratum, and the probability that the guarantee fails anywhere.
RATE, ERROR = 0.02, 0.05
#: Measures, each rejecting above its cutoff, with the candidate cutoffs from lenient to strict.
RULES = {
    "symbols_per_char": [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.03, 0.02],
    "mean_word_length": [20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0, 7.5, 7.0],
    "repeated_line_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4],
    "repeated_word_share": [0.19, 0.18, 0.17, 0.16, 0.15],
}
WINDOW_WORDS = 5
_SPACE = "[ \\t-\\r]+"
_BLANKS = " \t\n\x0b\x0c\r"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_base_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with a struct column `base` (BASE and n_lines: long; base_failed: boolean) from whole texts; null has no words.

    A column `base` of the input is replaced. Repeated words are found by sorting the hashes of a text's five-word windows, in the row itself: no shuffle.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(whole, F.lit(_BLANKS))
    step = docs.withColumn("__words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE)))
    step = step.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    n = F.size("__hashes")
    at = F.col("__hashes")
    windows = F.transform(
        F.sequence(F.lit(0), n - WINDOW_WORDS), lambda i: F.xxhash64(*[at[i + k] for k in range(WINDOW_WORDS)])
    )
    step = step.withColumn("__windows", F.when(n >= WINDOW_WORDS, windows).otherwise(F.array().cast("array<bigint>")))
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    ordered = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("__sorted", F.when(repeats, ordered))
    s, last = F.col("__sorted"), F.size("__sorted") - 1
    twice = lambda x, k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == x["h"])) | (
        (k < last) & (s[F.least(k + 1, last)]["h"] == x["h"])
    )
    places = F.sort_array(F.array_compact(F.transform("__sorted", lambda x, k: F.when(twice(x, k), x["i"]))))
    step = step.withColumn("__places", places)
    p, end = F.col("__places"), F.size("__places") - 1
    covered = F.transform(
        "__places",
        lambda x, k: F.when(k == end, WINDOW_WORDS).otherwise(F.least(F.lit(WINDOW_WORDS), p[F.least(k + 1, end)] - x)),
    )
    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    step = step.withColumn("__covered", F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0))).withColumn("__lines", lines)
    base = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.col("__covered").cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        ((n < 10) | (100 * F.col("__covered").cast("long") > 20 * n)).alias("base_failed"),
    )
    return step.withColumn("base", base).drop("__words", "__hashes", "__windows", "__sorted", "__places", "__covered", "__lines")


def measures() -> dict[str, Column]:
    """The rules' measures as columns over `base`; a document without words has 0 of each."""
    b = F.col("base")
    share = lambda a, n: F.when(n > 0, a / n).otherwise(F.lit(0.0))
    return {
        "symbols_per_char": share(b["n_symbols"], b["word_chars"]),
        "repeated_line_share": share(b["n_dup_lines"], b["n_lines"]),
        "repeated_word_share": share(b["n_repeat_words"], b["n_words"]),
        "mean_word_length": share(b["word_chars"], b["n_words"]),
    }


def allowed_errors(n: Column, rate: float, error: Column) -> Column:
    """The largest k with P(Binomial(n, rate) <= k) <= error; -1 if not even k = 0 has it.

    Terms follow from one another in logarithms, so that no n underflows; the sum runs to the mean, beyond which no k passes.
    """
    odds, none = math.log(rate) - math.log1p(-rate), n * math.log1p(-rate)
    start = F.struct(none.alias("term"), none.alias("sum"), F.lit(-1).cast("long").alias("k"))

    def step(a: Column, i: Column) -> Column:
        term = F.when(i == 0, a["term"]).otherwise(a["term"] + F.log((n - i + 1) / F.greatest(i, F.lit(1))) + odds)
        high, low = F.greatest(a["sum"], term), F.least(a["sum"], term)
        total = F.when(i == 0, term).otherwise(high + F.log1p(F.exp(low - high)))
        return F.struct(term.alias("term"), total.alias("sum"), F.when(total <= F.log(error), i).otherwise(a["k"]).alias("k"))

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.ceil(n * rate).cast("long")), start, step, lambda a: a["k"])


def cutoffs(measured: DataFrame, labels: DataFrame, rate: float = RATE, error: float = ERROR) -> DataFrame:
    """(stratum, cutoffs): for each stratum with labels a map from rule to its strictest proven cutoff.

    `measured` has doc_id, `base` and the stratum; `labels` (doc_id, quality: 1 is good). A document with several
    labels is good only if all are; null ids and labels are left out. Documents that fail the base rule prove nothing.
    """
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    values = measured.where(~F.col("base.base_failed")).select("doc_id", "stratum", *[c.alias(r) for r, c in measures().items()])
    holdout = values.join(good.where("quality = 1").select("doc_id"), "doc_id")
    grid = [(r, i, float(c)) for r, cs in RULES.items() for i, c in enumerate(cs)]
    counts = holdout.groupBy("stratum").agg(
        F.count("*").alias("n"), *[F.count(F.when(F.col(r) > c, 1)).alias(f"{r}_{i}") for r, i, c in grid]
    )
    # One row per stratum from here on.
    share = F.lit(error) / (F.count("*").over(Window.partitionBy()) * len(RULES))
    tests = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"{r}_{i}").alias("rejected")) for r, i, c in grid])
    proven = (
        counts.withColumn("share", share)
        .withColumn("allowed", allowed_errors(F.col("n"), rate / len(RULES), F.col("share")))
        .select("stratum", "allowed", F.explode(tests).alias("t"))
        .where("t.rejected <= allowed")
        .groupBy("stratum", "t.rule")
        .agg(F.min("t.cutoff").alias("cutoff"))
    )
    return proven.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))


def judge(measured: DataFrame, labels: DataFrame, stratum: str = "lang", rate: float = RATE, error: float = ERROR) -> DataFrame:
    """`measured` (a stored `with_base_measures`) with `rejected_by` (array of rules, `base` first) and `kept`.

    Every row stays, repeated ones too. Null texts have no words and fail the base rule; a null stratum is a stratum of its own; without
    labels only the base rule rejects; no rows give no rows.
    """
    rows = measured.withColumn("stratum", F.coalesce(F.col(stratum), F.lit("(none)")))
    proven = stored(cutoffs(rows, labels, rate, error))  # stored, so that its size is known when the join is planned
    values = {rule: measures()[rule] for rule in RULES}
    rules = [F.when(F.col("base.base_failed"), F.lit("base"))]
    rules += [F.when(value > F.try_element_at("cutoffs", F.lit(rule)), F.lit(rule)) for rule, value in values.items()]
    judged = rows.join(proven, "stratum", "left").withColumn("rejected_by", F.array_compact(F.array(*rules)))
    return judged.withColumn("kept", F.size("rejected_by") == 0).drop("stratum", "cutoffs")


def _sql() -> str:
    """The query in SQL: windows and lines are unnested, the binomial terms are written with log-gamma."""
    tests = ", ".join(f"('{rule}', {cutoff})" for rule, cuts in RULES.items() for cutoff in cuts)
    rate = RATE / len(RULES)
    return rf"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '(none)') AS stratum, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g FROM w, unnest(range(1, greatest(len(words) - 3, 1))) AS r(i)),
twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM twice, unnest(range(i, i + 5)) AS r(j) GROUP BY 1),
b AS (
  SELECT w.doc_id, stratum, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b),
m AS (
  SELECT doc_id, stratum, base_failed, unnest(['symbols_per_char', 'mean_word_length', 'repeated_line_share', 'repeated_word_share']) AS rule,
         unnest([CASE WHEN word_chars > 0 THEN n_symbols::DOUBLE / word_chars ELSE 0 END, CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END,
                 CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END, CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END]) AS value FROM f),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY 1 HAVING min(quality) = 1),
h AS (SELECT m.* FROM m JOIN good USING (doc_id) WHERE NOT base_failed),
sizes AS (SELECT stratum, count(DISTINCT doc_id) AS n FROM h GROUP BY 1),
terms AS (
  SELECT stratum, k, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({rate}) + (n - k) * ln(1 - {rate}))) OVER (PARTITION BY stratum ORDER BY k) AS cdf
  FROM sizes, unnest(range(0, CAST(ceil(n * {rate}) AS BIGINT) + 1)) AS r(k)),
allowed AS (SELECT stratum, max(k) AS k FROM terms WHERE cdf <= {ERROR} / ((SELECT count(*) FROM sizes) * {len(RULES)}) GROUP BY 1),
c AS (
  SELECT h.stratum, h.rule, t.cutoff FROM h JOIN (VALUES {tests}) AS t(rule, cutoff) ON t.rule = h.rule JOIN allowed a ON a.stratum = h.stratum
  GROUP BY 1, 2, 3, a.k HAVING count(CASE WHEN value > t.cutoff THEN 1 END) <= a.k),
cut AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM c GROUP BY 1, 2),
bad AS (SELECT doc_id, list(m.rule) AS rules FROM m JOIN cut USING (stratum, rule) WHERE value > cutoff GROUP BY 1)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rules IS NULL AS kept,
       array_to_string(list_filter(['base', {", ".join(f"'{r}'" for r in RULES)}], lambda r: (r = 'base' AND base_failed) OR coalesce(list_contains(rules, r), false)), ',') AS rejected_by
FROM f LEFT JOIN bad USING (doc_id)
"""


@query("op2_quality", _sql())
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = stored(with_base_measures(docs).drop("text"))
    judged = judge(measured, table(spark, sf_dir, "labels"))
    base = [F.col(f"base.{name}") for name in (*BASE, "base_failed")]
    return judged.select("doc_id", *base, "kept", F.array_join("rejected_by", ",").alias("rejected_by"))
