"""Output of micro-batches with a commit point: data files first, then one manifest that appears at once.

A batch writes its rows to a folder that no reader looks at yet, then a manifest that names the folder, under a name that only one writer can take: the
rename of a finished file fails where the name is there already. Readers follow manifests, so they see all of a batch or nothing, and a batch that
is repeated after a failure, or written twice at the same time, counts once. Needs a file system whose rename is atomic, as HDFS and local ones.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.sinks.topics import Sink

_MANIFESTS = "_commits"


def committed_sink(folder: str, partition_by: tuple[str, ...] = ()) -> Sink:
    """A `foreachBatch` function that writes a batch once; a batch that is committed already is left alone."""

    def write(df: DataFrame, batch_id: int) -> None:
        spark, name = df.sparkSession, f"{batch_id:020d}.json"
        if _exists(spark, f"{folder}/{_MANIFESTS}/{name}"):
            return
        data = f"data/{batch_id}-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(f"{folder}/{data}")
        manifest = {"batch": batch_id, "path": data, "schema": df.schema.json()}
        if not _publish(spark, folder, name, json.dumps(manifest)):
            _fs(spark, folder).delete(_path(spark, f"{folder}/{data}"), True)

    return write


def committed(spark: SparkSession, folder: str, since: int | None = None, until: int | None = None) -> DataFrame:
    """The rows of all committed batches, or of those from `since` to `until`, with their `batch`.

    Files without a manifest, of batches that failed or are still being written, aren't read. An output without any commit has no rows and no columns but `batch`.
    """
    if not _exists(spark, f"{folder}/{_MANIFESTS}"):
        return spark.createDataFrame([], "batch LONG")
    manifests = spark.read.schema("batch LONG, path STRING, schema STRING").json(f"{folder}/{_MANIFESTS}")
    # One small row per batch.
    found = sorted((r.batch, r.path, r.schema) for r in manifests.where(_within(since, until)).collect())
    if not found:
        return spark.createDataFrame([], "batch LONG")
    from pyspark.sql.types import StructType

    schema = StructType.fromJson(json.loads(found[-1][2]))
    rows = spark.read.schema(schema).option("basePath", folder).parquet(*(f"{folder}/{path}" for _, path, _ in found))
    number = F.regexp_extract(F.col("_metadata.file_path"), "/data/([0-9]+)-[0-9a-f]{32}/", 1).cast("long")
    return rows.withColumn("batch", number)


def _within(since: int | None, until: int | None) -> Column:
    low = F.lit(True) if since is None else F.col("batch") >= since
    return low if until is None else low & (F.col("batch") <= until)


def uncommitted(spark: SparkSession, folder: str) -> list[str]:
    """Data folders without a manifest: what a batch that failed has left. Safe to delete while no batch is being written."""
    fs, data = _fs(spark, folder), _path(spark, f"{folder}/data")
    if not fs.exists(data):
        return []
    there = {status.getPath().getName() for status in fs.listStatus(data)}
    known = {r.path.split("/")[-1] for r in spark.read.schema("path STRING").json(f"{folder}/{_MANIFESTS}").collect()} if _exists(spark, f"{folder}/{_MANIFESTS}") else set()
    return sorted(f"{folder}/data/{name}" for name in there - known)


def _publish(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Put a manifest there, whole and under its name, unless the name is taken."""
    jvm, fs = spark.sparkContext._jvm, _fs(spark, folder)
    fs.mkdirs(_path(spark, f"{folder}/{_MANIFESTS}"))
    draft = _path(spark, f"{folder}/{_MANIFESTS}/.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        files.rename(fs.makeQualified(draft), fs.makeQualified(_path(spark, f"{folder}/{_MANIFESTS}/{name}")), options)
    except Exception as error:
        if "FileAlreadyExistsException" not in str(error):
            raise
        fs.delete(draft, False)
        return False
    return True


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))
