"""W1 distributed surrogate keys, W2 one-row-per-key selection, distinct rows.

W1. ``row_number() OVER (ORDER BY v)`` with no partition clause plans an
``Exchange SinglePartition``: the whole column goes through one task. Here
the frame is range-partitioned on the order columns, sorted inside each
partition, and numbered locally with ``monotonically_increasing_id`` (whose
upper bits are the partition index). Per-partition counts (one row per
partition, a size bounded by the partition count) give each partition its
offset. The numbered frame is first written as a table in the shared
checkpoint folder: the range bounds come from a sample, so the rows and the
counts must come from one materialisation, and a lost executor must not
re-sample.

W2. The warehouse load kept ``ROW_NUMBER() OVER (PARTITION BY k ORDER BY k)
= 1``, which picks an arbitrary row. Here the pick is the smallest row in
(key, every other column ascending, nulls last) order. The window form is
planned with a partial ``WindowGroupLimit`` before the shuffle (each map task
keeps its first row per key), so a hot key is reduced before it moves and
its rows are never gathered in one task; ``one_per_key_agg`` computes the same
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

_PART = "_bm_part"
_ID = "_bm_mid"

TASK_ROWS = 1 << 18         # rows of a task of distinct_rows, about


def surrogate_key(df: DataFrame, order_cols: list[str], key: str,
                  num_partitions: int | None = None,
                  materialised: bool = True) -> DataFrame:
    """Add ``key`` = 1-based row number in ``order_cols`` order (BIGINT).

    Ties are numbered in an arbitrary order, as with ``row_number``. A hash of
    the whole row is the last range key, so one value repeated on many
    different rows is spread over several partitions instead of one.
    """
    tie = F.xxhash64(*[F.col(c) for c in df.columns]).alias("_bm_tie")
    df = df.withColumn("_bm_tie", tie)
    rng = [*order_cols, "_bm_tie"]
    ranged = (df.repartitionByRange(num_partitions, *rng)
              if num_partitions else df.repartitionByRange(*rng))
    ranged = (ranged.sortWithinPartitions(*rng)
              .withColumn(_PART, F.spark_partition_id())
              .withColumn(_ID, F.monotonically_increasing_id()))
    if materialised:
        ranged = materialise(ranged, "surrogate-key")
    counts = ranged.groupBy(_PART).agg(F.count(F.lit(1)).alias("_bm_n"))
    # One row per partition: the single-partition window below sees at most
    # num_partitions rows, and the broadcast is bounded by the same number.
    offsets = counts.select(
        _PART,
        F.coalesce(F.sum("_bm_n").over(
            Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_bm_off"))
    local = F.col(_ID) - F.shiftleft(F.col(_PART).cast("bigint"), 33)
    return (ranged.join(F.broadcast(offsets), _PART)
            .withColumn(key, F.col("_bm_off") + local + 1)
            .drop(_PART, _ID, "_bm_off", "_bm_tie"))


def extend_keys(previous: DataFrame, values: DataFrame, value_cols: list[str],
                key: str) -> DataFrame:
    """Stable surrogate keys across loads: values already in ``previous``
    keep their key; values not seen before are numbered in value order after
    the largest existing key. (Recomputing dense keys each run, the default,
    shifts ids whenever a value is inserted.) A value that ``previous`` holds
    under several keys keeps the smallest, so no join on the value can repeat a
    row. New values (null is a value too) are found with a null-safe anti join
    on distinct values and numbered with ``surrogate_key``; the current maximum
    is a scalar subquery, so nothing passes through the driver."""
    kept = previous.groupBy(*value_cols).agg(F.min(key).cast("long").alias(key))
    n, k = values.select(*value_cols).distinct().alias("n"), kept.alias("k")
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in value_cols]
    new = n.join(k, reduce(lambda a, b: a & b, same), "left_anti")
    top = previous.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("m")).scalar()
    numbered = surrogate_key(new, value_cols, key).withColumn(key, F.col(key) + top)
    return kept.select(key, *value_cols).unionByName(numbered.select(key, *value_cols))


def surrogate_key_global(df: DataFrame, order_cols: list[str], key: str) -> DataFrame:
    """Single-partition window: only for domains with a proven small bound."""
    return df.withColumn(key, F.row_number().over(Window.orderBy(*order_cols)).cast("long"))


def distinct_rows(df: DataFrame, rows: int) -> DataFrame:
    """Distinct rows of a frame of about ``rows`` rows, ``TASK_ROWS`` of them in a
    task. A task of ``distinct`` holds its rows in a hash map, and how many it gets
    follows the compressed bytes of a split or a shuffle partition and a fixed
    partition count; here tasks, not rows in a task, grow with the frame. Copies
    of one row meet in one task: they take its time, no memory."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return df.repartition(tasks, *df.columns).distinct()


def _nulls_last_key(cols: list[str]):
    parts = []
    for c in cols:
        parts += [F.col(c).isNull().alias(f"_n_{c}"), F.col(c).alias(c)]
    return F.struct(*parts)


def _orderable(df: DataFrame, cols: list[str]) -> list[str]:
    from pyspark.sql.types import MapType
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in cols if not isinstance(types[c], MapType)]


def one_per_key(df: DataFrame, key: str | list[str],
                order_cols: list[str] | None = None) -> DataFrame:
    """One row per key; the smallest by ``order_cols`` (default: all
    non-key columns in table order, ascending, nulls last; map columns,
    which have no order, are left out of the default).

    ``row_number() = 1`` is planned with a partial ``WindowGroupLimit`` below
    the shuffle: each map task keeps only its first row per key, so a key
    holding a third of the rows is reduced before it moves."""
    keys = [key] if isinstance(key, str) else list(key)
    order = order_cols if order_cols is not None else _orderable(
        df, [c for c in df.columns if c not in keys])
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (df.withColumn("_bm_rn", F.row_number().over(w))
            .filter("_bm_rn = 1").drop("_bm_rn"))


def one_per_key_agg(df: DataFrame, key: str | list[str],
                order_cols: list[str] | None = None) -> DataFrame:
    """W2 as an aggregate, ``min(struct(...))`` (same result as
    ``one_per_key``): partial sort-aggregation reduces each key per map task."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    order = order_cols if order_cols is not None else rest
    tail = [c for c in rest if c not in order]
    best = F.min(F.struct(_nulls_last_key(order).alias("o"),
                          *[F.col(c) for c in tail])).alias("_bm_best")
    out = df.groupBy(*keys).agg(best)
    sel = [F.col(k) for k in keys]
    for c in rest:
        src = (F.col("_bm_best.o").getField(c) if c in order
               else F.col("_bm_best").getField(c))
        sel.append(src.alias(c))
    return out.select(*sel).select(*df.columns)

