"""Session defaults and the few settings the operators read at run time."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# A key with more rows than this is cut into slices of this many rows.
SLICE_ROWS = "spark.shelfline.sliceRows"
# Inputs whose files are smaller than this are not searched for hot keys.
SLICE_CHECK_BYTES = "spark.shelfline.sliceCheckBytes"

_DEFAULTS = {
    SLICE_ROWS: 4_000_000,
    SLICE_CHECK_BYTES: 256 * 1024 * 1024,
}

#: Bytes of the Arrow batches that go to Python workers, which both sides hold whole and outside of the heap.
ARROW_BYTES, ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app_name: str = "shelfline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def setting(spark: SparkSession, name: str) -> int:
    return int(spark.conf.get(name, str(_DEFAULTS[name])))


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches where the session has not set a bound itself; rows with long texts would make batches of Spark's 64 MB."""
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, ARROW_BATCH)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from `spark.checkpoint.dir`.

    Where none is set, one machine (a `local` master, as in tests) gets a temporary folder; a cluster gets an error,
    since its executors could not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="shelfline-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder, so later readers see the same rows after a lost executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back.

    Later stages depend on no executor, and Spark knows the table's bytes when it plans a join: it broadcasts it up to
    `spark.sql.autoBroadcastJoinThreshold` and shuffles it beyond. `discard_stored` deletes these tables.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SCOPE: ContextVar[str | None] = ContextVar("scope", default=None)


def new_folder(spark: SparkSession) -> str:
    """A new folder of this application under the shared one, inside the folder of the scope where there is one."""
    return f"{_SCOPE.get() or _own_folder(spark)}/{uuid.uuid4().hex}"


@contextmanager
def scoped(spark: SparkSession) -> Iterator[str]:
    """Tables stored inside go to a folder of their own, which `drop_folder` deletes once nothing reads them."""
    folder = new_folder(spark)
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/shelfline/{spark.sparkContext.applicationId}"


def discard_stored(spark: SparkSession) -> None:
    """Delete what `stored` has written in this application, once no result is read any more."""
    drop_folder(spark, _own_folder(spark))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files and tables under `df`, as Spark's own statistics give them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
