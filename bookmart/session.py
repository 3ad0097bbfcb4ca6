"""Session helpers: a tuned builder and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on. ANSI stays on (the Spark 4 default);
# operators use try_cast / get where the data may be malformed.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # stream state beyond executor memory (exact dedup keeps every key)
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


PARSED_ROW_GROUP = 8 << 20      # of tables of parsed rows, which are narrow and read several times
# Rows of a file of parsed editions. Every file counts 4 MB (openCostInBytes) more in a
# split of 128 MB, so a split has some 30 files at most however well they compress.
PARSED_FILE_ROWS = 1 << 17


def get_session(master: str | None = None, app: str = "bookmart",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster leave ``master`` unset; the launcher supplies it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Uses the session's own setting. Without one a cluster session is an error,
    since a machine-local folder would not survive the loss of an executor; a
    session whose driver and tasks share one machine (tests, the local checks)
    gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="bookmart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/bookmart/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this library has written under the checkpoint root. For the
    owner of the folder, after results are stored: frames that read it, of any
    session that shares the folder, cannot be read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/bookmart")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def scale_conf(shuffle_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Settings sized for one run from its expected shuffle volume.

    Shuffle partitions start at shuffle bytes / partition size (at least 200)
    and AQE coalesces small ones; scan splits and skew thresholds follow the
    same partition size, so a task's input fits in executor memory.
    """
    parts = max(200, -(-int(shuffle_bytes) // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def materialise(df, name: str, row_group: int | None = None, file_rows: int | None = None):
    """Cut lineage: write ``df`` as a parquet table in the shared checkpoint
    folder and return its read-back. Columnar and compressed (a checkpoint
    stores uncompressed rows by default), and later readers get column pruning
    and predicate pushdown; a lost executor re-reads the table instead of
    recomputing the lineage. ``row_group`` (bytes) makes row groups smaller than
    Parquet's 128 MB, so a table of few files is read by more tasks;
    ``file_rows`` bounds the rows of a file, and with them those of a task that
    reads well compressed rows."""
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("overwrite")
    if row_group:
        w = w.option("parquet.block.size", str(row_group))
    if file_rows:
        w = w.option("maxRecordsPerFile", file_rows)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)
