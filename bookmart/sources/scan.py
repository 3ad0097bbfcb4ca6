"""Table scans: the same plan at every size.

Projections reach the parquet reader; how many tasks a scan has is up to the
files' row groups and ``spark.sql.files.maxPartitionBytes``. Nothing is cached
or spread here: a job that reads a frame more than once writes it once itself
(``session.materialise``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
