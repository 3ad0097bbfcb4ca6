"""Continuous landing with deduplication by record key.

Three policies, chosen by the caller:
* stored (``start_stored_dedup``): exact, without state in the stream: every
  micro-batch is compared with the stored rows, which are bucketed by the key,
  so the keys of earlier batches do not move and are not held in memory.
* exact (no watermark): every key ever seen is kept in state; a repeat of any
  age is dropped. State grows with the number of distinct keys.
* bounded (watermark): ``dropDuplicatesWithinWatermark`` forgets a key once
  the event-time watermark passes it, so state stays bounded; a repeat that
  arrives later than the delay is emitted again.
A ``timestamp_ntz`` event time is cast to ``timestamp`` for the watermark in
a helper column, which is dropped from the output.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import keys as K
from ..operators import merge

_ET = "_bm_event_time"


def read_stream(spark: SparkSession, path: str, schema: T.StructType,
                glob: str | None = None, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def dedup(stream: DataFrame, keys: list[str], event_time: str | None = None,
          delay: str | None = None) -> DataFrame:
    if event_time and delay:
        s = stream.withColumn(_ET, F.col(event_time).cast("timestamp")).withWatermark(_ET, delay)
        return s.dropDuplicatesWithinWatermark(keys).drop(_ET)
    return stream.dropDuplicates(keys)


def to_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a parquet folder; the sink's own log makes a replayed
    micro-batch idempotent. ``availableNow`` processes what is there, then stops."""
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(path))


def new_rows(batch: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key of ``batch`` whose key ``stored`` does not hold. Null is
    a key like any other; rows with one are compared apart, so that the rest
    joins on plain equality, in the buckets of the stored side. The batch is
    spread first: its files may come as one row group each, and a task sorts all
    that it reads before it leaves one row per key."""
    once = K.one_per_key(batch.hint("rebalance"), keys)
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    plain = once.filter(complete).join(stored.select(*keys), keys, "left_anti")
    n, s = once.filter(~complete).alias("n"), stored.filter(~complete).select(*keys).alias("s")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"n.{k}").eqNullSafe(F.col(f"s.{k}"))
    return plain.select(*batch.columns).unionByName(n.join(s, same, "left_anti").select(*batch.columns))


def start_stored_dedup(stream: DataFrame, root: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Append the rows with new keys to the stored table ``root`` (see
    ``read_deduped``). A replayed micro-batch is compared with all others'
    rows and replaces its own, so it gives the same rows again."""
    source = "dedup-" + hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    schema = stream.schema

    def apply(batch: DataFrame, batch_id: int) -> None:
        stored = merge.read_all(batch.sparkSession, root, schema, without=(source, str(batch_id)))
        merge.append_changes(new_rows(batch, stored, keys), root, source, str(batch_id), keys)

    return (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_deduped(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return merge.read_all(spark, root, schema)
