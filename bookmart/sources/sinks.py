"""Parquet sinks and the staging load.

Partition counts are never forced to 1: compaction uses the REBALANCE hint so
adaptive execution sizes the output files from the measured shuffle size,
and ``maxRecordsPerFile`` caps each file. Load-date partitions are written
with dynamic partition overwrite, so writing one day keeps the others.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import catalogue as C
from ..functions.text import load_date_parts


def _writer(df: DataFrame, mode: str, max_records: int | None):
    w = df.write.mode(mode).option("compression", "snappy")
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    return w


def compact_write(df: DataFrame, path: str, partitions: int | None = None,
                  max_records: int | None = C.SINK_MAX_RECORDS_PER_FILE) -> str:
    """Few, well-sized files. With ``partitions`` a plain repartition;
    otherwise AQE picks the count from the data size."""
    out = df.repartition(partitions) if partitions else df.hint("rebalance")
    _writer(out, "overwrite", max_records).parquet(path)
    return path


def sample_rows(df: DataFrame, n: int, order_cols: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows in a total order (deterministic); Spark
    plans a per-task top-n and merges only n rows per task."""
    return df.orderBy(*(order_cols or df.columns)).limit(n)


def partitioned_write(df: DataFrame, path: str, load_date: str,
                      partitions: int | None = None,
                      max_records: int | None = C.SINK_MAX_RECORDS_PER_FILE,
                      dynamic: bool = True) -> str:
    """Add year/month/day of ``load_date`` and write partitioned by them.
    Dynamic overwrite replaces only that day's folder; a day without rows has
    nothing to replace it with, so its folder then gets an empty file."""
    parts = load_date_parts(load_date)
    out = df.withColumns(parts)
    out = out.repartition(partitions) if partitions else out.hint("rebalance")
    written = Observation()
    (_writer(out.observe(written, F.count(F.lit(1)).alias("n")), "overwrite", max_records)
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy("year", "month", "day").parquet(path))
    if not written.get["n"]:
        d = dt.date.fromisoformat(load_date)
        day = f"year={d.year}/month={d.month}/day={d.day}"
        df.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{day}")
    return path


def fact_write(df: DataFrame, path: str, partitions: int | None = None,
               max_records: int | None = C.SINK_MAX_RECORDS_PER_FILE) -> str:
    """Unpartitioned sink (the frame is written once, so not cached)."""
    return compact_write(df, path, partitions, max_records)


def clustered_write(df: DataFrame, path: str, dist_key: str, sort_key: str,
                    split_key: str | None = None, partitions: int | None = None,
                    max_records: int | None = C.SINK_MAX_RECORDS_PER_FILE) -> str:
    """Files hold contiguous ranges of ``dist_key`` (tight min/max per
    file, so readers prune on it and co-located rows stay together), each
    sorted by ``sort_key`` (row-group statistics prune on it). ``split_key``
    is a second range key: a ``dist_key`` value holding a large share of the
    rows spans several adjacent files instead of one oversized task."""
    keys = [dist_key] + ([split_key] if split_key else [])
    out = (df.repartitionByRange(partitions, *keys) if partitions
           else df.repartitionByRange(*keys))
    _writer(out.sortWithinPartitions(sort_key), "overwrite", max_records).parquet(path)
    return path


def bucketed_write(df: DataFrame, table: str, path: str, dist_key: str | list[str],
                   sort_key: str | None = None, buckets: int = 64) -> DataFrame:
    """C3 as Spark bucketing: an external catalog table over ``path``,
    bucketed by ``dist_key`` and sorted by ``sort_key`` inside each bucket.
    Joins and aggregations on ``dist_key`` between tables with the same
    bucket count then run without an exchange (co-location). A bucket cannot
    split one key: where a single key may hold a large share of the rows, bucket
    by the key and a salt (``sources.bucketed.salted``), or use
    ``clustered_write`` with a ``split_key``."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        raise ValueError(f"the table {table} exists already")
    w = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *([dist_key] if isinstance(dist_key, str) else dist_key))
    if sort_key:
        w = w.sortBy(sort_key)
    w.saveAsTable(table)
    return spark.table(table)


def stage_load(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a staged table with the declared schema, columns by name."""
    return spark.read.schema(schema).parquet(path).select(*[f.name for f in schema.fields])


def batched_landing(df: DataFrame, path: str, batch_rows: int) -> str:
    """Append records in files of at most ``batch_rows`` rows; the last,
    smaller batch is always written."""
    _writer(df, "append", batch_rows).parquet(path)
    return path


def read_load_day(spark: SparkSession, path: str, load_date: str) -> DataFrame:
    """Read one load day; the filter prunes the partition folders."""
    p = load_date_parts(load_date)
    return spark.read.parquet(path).filter(
        (F.col("year") == p["year"]) & (F.col("month") == p["month"]) & (F.col("day") == p["day"]))


def newest_load_day(spark: SparkSession, path: str) -> str:
    """The newest load day of a partitioned table, as text (partition values
    only; no data is read)."""
    day = F.max(F.make_date("year", "month", "day")).cast("string")
    return spark.read.parquet(path).agg(day).first()[0]


def stage_day(spark: SparkSession, path: str, schema: T.StructType, load_date: str) -> DataFrame:
    """S8 for one load day of a partitioned table."""
    return read_load_day(spark, path, load_date).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
