"""Files as sources: whole files, JSON arrays and lines, feature lines, and files that may be missing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import schemas as S


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One file, one record. For large catalogues prefer JSON lines, which split."""
    return spark.read.text(path, wholetext=True)


def product_array(spark: SparkSession, path: str) -> DataFrame:
    """Typed products from files that hold one JSON array each."""
    return spark.read.schema(S.PRODUCT).option("multiLine", True).json(path)


def product_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.PRODUCT).json(path)


def or_empty(spark: SparkSession, path: str) -> DataFrame:
    """Whole files, or no rows when the path does not exist."""
    try:
        return whole_files(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return in_memory(spark, [], "value STRING")


def in_memory(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """The feature lines of GeoJSON files that hold one feature per line; header and footer drop out."""
    return spark.read.text(path).where(F.col("value").contains('"Feature"') & F.col("value").contains('"geometry"'))


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New text files of a folder as a stream of lines."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_parquet(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
