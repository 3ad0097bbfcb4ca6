"""J4 upsert, A7 bridge reload, and tables kept as appended changes.

Upsert semantics: update on key match, insert otherwise, never delete.
When the update covers every target column the result is exactly
``target - matched keys + deduplicated source``. It is computed with one
full outer join on the key and a match flag (see ``upsert``), which also
serves a column subset: columns not updated keep the target's values.

A stored table is the sum of its changes: every load or micro-batch appends
its own rows, marked with an *attempt*, and then names the attempt in ``loads``
beside its (source, batch) and the day it is *of*. What is written grows with
the batch, not with the table. Readers see the rows of the last named attempt
of every (source, batch) and nothing else:

* a repeated batch replaces what it wrote before, also when it has no rows now;
* rows of an attempt that ended before its entry in ``loads`` do not count, and
  the attempt before it stays whole;
* the current state is, per key, the row of the latest day, on one day of the
  batch that came first later; a batch repeated keeps its place, so loads may be
  run again in any order.

A table with a key is bucketed by it, so the newest row per key is found inside
the buckets, without a shuffle. ``compact`` writes the current state as the
start of a new table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import bucketed
from ..sources.bucketed import read_if_written
from . import keys as K

ATTEMPT, AS_OF, PLACE = "_bm_attempt", "_bm_as_of", "_bm_place"
MANY_LOADS = 100_000         # entries of ``loads`` that are sent to every task; beyond it they are joined by shuffle
_LOAD = T.StructType([T.StructField(c, T.StringType()) for c in ("source", "batch", "attempt", "as_of")]
                     + [T.StructField("made", T.LongType())])


def upsert(target: DataFrame, source: DataFrame, key: str,
           update_cols: list[str] | None = None, dedup: bool = True) -> DataFrame:
    """Target rows whose key is not in the (deduplicated) source, plus the
    source rows; with ``update_cols`` only those columns take source values
    on a match (others keep the target's, new rows take the source's).

    One full outer join on the key: each input is computed once (an anti
    join plus a union would run the source lineage twice), both sides hold
    one row per key, and the deduplicated source arrives already
    hash-partitioned on the key. A match is decided by a flag, not by
    ``coalesce``: an update may set a null.
    """
    src = K.one_per_key(source, key) if dedup else source
    src = src.select(*target.columns)
    rest = [c for c in target.columns if c != key]
    upd = set(rest if update_cols is None else update_cols)
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("_bm_t"))
    s = src.select(*[F.col(c).alias(f"s_{c}") for c in src.columns], F.lit(True).alias("_bm_s"))
    both = t.join(s, F.col(f"t_{key}") == F.col(f"s_{key}"), "full_outer")
    matched = F.col("_bm_s").isNotNull()
    in_target = F.col("_bm_t").isNotNull()
    out = [F.when(matched, F.col(f"s_{key}")).otherwise(F.col(f"t_{key}")).alias(key)]
    for c in rest:
        if c in upd:
            out.append(F.when(matched, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c))
        else:
            out.append(F.when(in_target, F.col(f"t_{c}")).otherwise(F.col(f"s_{c}")).alias(c))
    return both.select(*out)


def bridge_reload(staging: DataFrame, cols: list[str]) -> DataFrame:
    """A bridge is replaced by the distinct pairs of its staging."""
    return staging.select(*cols).dropDuplicates(cols)


# --- tables of appended changes -------------------------------------------------

def _loads_path(root: str) -> str:
    return f"{root.rstrip('/')}/loads"


def _rows_path(root: str) -> str:
    return f"{root.rstrip('/')}/rows"


def _loads(spark: SparkSession, root: str) -> DataFrame:
    found = read_if_written(spark, _loads_path(root), _LOAD)
    return spark.createDataFrame([], _LOAD) if found is None else found


def visible(spark: SparkSession, root: str) -> DataFrame:
    """One row per (source, batch): its last named attempt, the day it is of,
    and its place among the batches (that of its first attempt)."""
    last = F.struct("made", "attempt")
    return _loads(spark, root).groupBy("source", "batch").agg(
        F.max_by("attempt", last).alias(ATTEMPT), F.max_by("as_of", last).alias(AS_OF), F.min("made").alias(PLACE))


def write_rows(df: DataFrame, root: str, attempt: str, key: str | list[str] | None = None,
               buckets: int | None = None) -> None:
    """First half of a load: the rows, which no reader sees yet. ``buckets``: of a
    table that has none yet (by default from a count, which stores the rows once more)."""
    marked = df.withColumn(ATTEMPT, F.lit(attempt))
    if key is None:
        marked.write.mode("append").parquet(_rows_path(root))
    else:
        bucketed.append(marked, root, [key] if isinstance(key, str) else list(key), buckets)


def name_attempt(spark: SparkSession, root: str, source: str, batch: str, attempt: str, as_of: str | None = None) -> None:
    """Second half: from here on readers see the attempt. Without ``as_of`` the
    batch is of the day of its first attempt."""
    if as_of is not None:
        dt.date.fromisoformat(as_of)
    own = (F.col("source") == source) & (F.col("batch") == batch)
    top, before = _loads(spark, root).agg(F.max("made"), F.max_by("as_of", F.when(own, F.col("made")))).first()
    row = (source, batch, attempt, as_of or before or dt.date.today().isoformat(), (top or 0) + 1)
    spark.createDataFrame([row], _LOAD).coalesce(1).write.mode("append").parquet(_loads_path(root))


def append_changes(df: DataFrame, root: str, source: str, batch: str, key: str | list[str] | None = None,
                   as_of: str | None = None, buckets: int | None = None) -> None:
    """Append the rows of one load or micro-batch (with a ``key``: at most one
    row per key); repeated with the same ``source`` and ``batch`` it replaces
    what it wrote before. ``as_of``: the day the rows are of (YYYY-MM-DD)."""
    attempt = uuid.uuid4().hex
    write_rows(df, root, attempt, key, buckets)
    name_attempt(df.sparkSession, root, source, batch, attempt, as_of)


def _changes(spark: SparkSession, root: str, schema: T.StructType, loads: DataFrame) -> DataFrame:
    """The rows of the attempts in ``loads``, with its columns."""
    stored = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType())])
    rows = bucketed.read(spark, root, stored) if bucketed.layout(spark, root) else \
        read_if_written(spark, _rows_path(root), stored)
    rows = spark.createDataFrame([], stored) if rows is None else rows
    few = loads.limit(MANY_LOADS + 1).count() <= MANY_LOADS
    return rows.join(F.broadcast(loads) if few else loads, ATTEMPT)


def is_loaded(spark: SparkSession, root: str) -> bool:
    return read_if_written(spark, _loads_path(root), _LOAD) is not None


def read_current(spark: SparkSession, root: str, key: str, schema: T.StructType) -> DataFrame:
    """The newest row per key (of rows that one batch holds under one key, an
    arbitrary but fixed one)."""
    names = [f.name for f in schema.fields]
    tie = F.xxhash64(*[f.name for f in schema.fields if not isinstance(f.dataType, T.MapType)])
    newest = Window.partitionBy(key).orderBy(F.col(AS_OF).desc(), F.col(PLACE).desc(), tie)
    return (_changes(spark, root, schema, visible(spark, root)).withColumn("_bm_rn", F.row_number().over(newest))
            .filter("_bm_rn = 1").select(*names))


def read_latest(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows of the newest load alone (a reloaded table)."""
    loads = visible(spark, root).orderBy(F.col(AS_OF).desc(), F.col(PLACE).desc(), "source", "batch").limit(1)
    return _changes(spark, root, schema, loads).select(*[f.name for f in schema.fields])


def read_all(spark: SparkSession, root: str, schema: T.StructType, without: tuple[str, str] | None = None) -> DataFrame:
    """The rows of every batch, but for the (source, batch) ``without``."""
    loads = visible(spark, root)
    if without:
        loads = loads.filter(~((F.col("source") == without[0]) & (F.col("batch") == without[1])))
    return _changes(spark, root, schema, loads).select(*[f.name for f in schema.fields])


def compact(spark: SparkSession, root: str, new_root: str, key: str, schema: T.StructType) -> None:
    """The current state as the first load of a new table, of the latest day
    held: an older day run again into the new table still does not win."""
    day = visible(spark, root).agg(F.max(AS_OF)).first()[0]
    append_changes(read_current(spark, root, key, schema), new_root, "compact", "0", key, day)
