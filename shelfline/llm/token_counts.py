"""Token counts from an exact histogram of encoded lengths.

Documents are counted by their length in tokens. Suffix sums over the histogram then answer, for every context limit at
once, how many documents and tokens there are, how many a limit cuts off, and which length is a given quantile.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.registry import query, table
from shelfline.llm.words import library_memo


def token_count(text: Column, path: str) -> Column:
    """Number of tokens of a text column; 0 for null."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array((len(x) // 4 for x in library_memo(path).ids(x.as_py() for x in texts)), pa.int64())

    return of.asNondeterministic()(text)


def length_histogram(docs: DataFrame, path: str) -> DataFrame:
    """(length, documents): rows of `docs` (text) by encoded length. Null and empty texts have length 0.

    Repeated rows count each; other columns are ignored; no rows give no rows.
    """
    return docs.select(token_count(F.col("text"), path).alias("length")).groupBy("length").agg(F.count("*").alias("documents"))


def limit_answers(histogram: DataFrame) -> DataFrame:
    """One row per length that occurs, taken as the context limit. All numbers are exact; they are constant between two rows
    except `truncated_tokens`, which grows by `documents_longer` a token.

    documents, tokens: of that length; documents_longer, tokens_longer: beyond the limit (suffix sums);
    documents_fitting, tokens_fitting: within it; truncated_tokens: what is left when every document is cut at the
    limit; quantile: the share of documents that fit. The window's rows are the lengths that occur: at most the longest document's length.
    """
    beyond = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = histogram.withColumn("tokens", F.col("length") * F.col("documents"))
    for name in ("documents", "tokens"):
        sums = sums.withColumn(f"{name}_longer", F.coalesce(F.sum(name).over(beyond), F.lit(0)))
        sums = sums.withColumn(f"{name}_fitting", F.sum(name).over(everything) - F.col(f"{name}_longer"))
    return sums.select(
        "length",
        "documents",
        "tokens",
        "documents_fitting",
        "tokens_fitting",
        "documents_longer",
        "tokens_longer",
        (F.col("tokens_fitting") + F.col("length") * F.col("documents_longer")).alias("truncated_tokens"),
        (F.col("documents_fitting") / (F.col("documents_fitting") + F.col("documents_longer"))).alias("quantile"),
    )


def truncated_total(answers: DataFrame, limit: int) -> DataFrame:
    """(tokens): all tokens when every document is cut at any `limit`, also one that is no document's length."""
    kept = F.when(F.col("length") <= limit, F.col("tokens")).otherwise(F.lit(limit) * F.col("documents"))
    return answers.agg(F.coalesce(F.sum(kept), F.lit(0)).alias("tokens"))


def length_quantile(answers: DataFrame, share: float) -> DataFrame:
    """(length): the smallest length within which at least `share` of the documents are; null without documents."""
    return answers.where(F.col("quantile") >= share).agg(F.min("length").alias("length"))


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return limit_answers(length_histogram(table(spark, sf_dir, "documents"), path))
