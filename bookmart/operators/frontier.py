"""Keys not yet seen (crawl frontier), and the seen-keys table.

The seen-keys table is bucketed by the key and only grows by appends; readers
take its distinct keys, so a repeated append never double counts, and only the
candidates of a round are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import bucketed


def unseen(candidates: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Distinct candidate keys absent from ``seen``. Candidates are made
    distinct first: each map task collapses a hot key before the shuffle, so
    the anti join sees every key once."""
    c = candidates.select(key).where(candidates[key].isNotNull()).distinct()
    return c.join(seen.select(key), on=key, how="left_anti")


def add_seen(seen: DataFrame, new_keys: DataFrame, key: str) -> DataFrame:
    return seen.select(key).unionByName(new_keys.select(key)).distinct()


def read_seen(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The distinct keys recorded so far (empty if none yet; a table that
    cannot be read is an error). The table is bucketed by the key, so neither
    making its keys distinct nor the anti join of ``unseen`` moves them."""
    return bucketed.read_or_empty(spark, path, T.StructType([T.StructField(key, T.StringType())])).distinct()


def record_seen(new_keys: DataFrame, path: str, key: str) -> str:
    """Append newly processed keys (distinct per append)."""
    bucketed.append(new_keys.select(F.col(key).cast("string").alias(key)).distinct(), path, [key])
    return path
