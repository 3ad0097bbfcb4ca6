"""Small helpers shared by the operators of this subpackage.

Words are everywhere the maximal runs of ``[^\\x20\\x09-\\x0D]``. In a task
``bytes.split()`` cuts exactly there (unlike ``str.split()``, which also cuts
at other Unicode spaces).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise

WORD_BREAK = "[\\x20\\x09-\\x0D]+"

__all__ = ["WORD_BREAK", "documents", "materialise", "sha256_hex", "shuffle_width", "table", "text_batches",
           "unused", "word_count"]


@contextmanager
def text_batches(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """At most ``rows`` rows in the Arrow batches of what runs inside: with whole
    texts the default of 10,000 would hold tens of MB on both sides of every
    task. The session's own setting is back afterwards, so plans that run later
    do not see it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if int(before) <= 0 or int(before) > rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unused(name: str, docs: DataFrame) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.size(F.array_remove(F.split(text, WORD_BREAK), "")), F.lit(0)).cast("long")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
