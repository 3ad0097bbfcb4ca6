"""A4 group count and A5 two-phase (salted) aggregation for skewed keys.

Phase 1 groups by (key, salt), phase 2 merges the partial results per key;
the result equals the plain aggregate. Salts are a separate column (never
spliced into the key text), so keys containing the separator stay intact,
and they are deterministic hashes, so a retried task writes the same shuffle
output. With a distinct count the salt is a hash of the counted value, so
each value lives in exactly one salt bucket and the partial counts add up.

In Spark the functions offered here are already skew-safe without salting:
count / sum / min / max / avg combine on the map side (a hot key reaches the
reducer as one row per map task), and a single distinct count is planned as
an aggregate on (key, value) first, which spreads a hot key's values. The
operator is kept as the general two-phase form (and for parity).

Aggregates that gather a key's values have no such partial form and need the
two phases: ``salted_quantile`` merges one bounded sketch per (key, salt),
``salted_mode`` reduces (key, value) counts, ``salted_set`` unites sets of
disjoint parts of the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import salt as salt_col

_SALT = "_bm_salt"


def group_count(df: DataFrame, keys: list[str], out: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def salted_agg(df: DataFrame, keys: list[str], aggs: dict, salts: int = 16,
               salt_cols: list[str] | None = None) -> DataFrame:
    """Two-phase aggregate.

    ``aggs`` maps output name -> (function, column); function is one of
    count, sum, min, max, avg, count_distinct. At most one column may be
    counted distinct; it then also serves as the salt source.
    """
    distinct_cols = {c for fn, c in aggs.values() if fn == "count_distinct"}
    if len(distinct_cols) > 1:
        raise ValueError("salted_agg: one count_distinct column at most")
    if distinct_cols:
        salt_src = sorted(distinct_cols)
    else:
        salt_src = salt_cols or [c for c in df.columns if c not in keys]
    salted = df.withColumn(_SALT, salt_col(salts, *salt_src))

    phase1, phase2 = [], []
    for name, (fn, c) in aggs.items():
        p = f"_p_{name}"
        if fn == "count":
            e = F.count(F.lit(1)) if c in (None, "*") else F.count(F.col(c))
            phase1.append(e.alias(p))
            phase2.append(F.sum(p).alias(name))
        elif fn in ("sum", "min", "max"):
            phase1.append(getattr(F, fn)(F.col(c)).alias(p))
            phase2.append(getattr(F, fn)(p).alias(name))
        elif fn == "avg":
            phase1 += [F.sum(F.col(c)).alias(p + "_s"), F.count(F.col(c)).alias(p + "_n")]
            phase2.append((F.sum(p + "_s") / F.sum(p + "_n")).alias(name))
        elif fn == "count_distinct":
            phase1.append(F.count_distinct(F.col(c)).alias(p))
            phase2.append(F.sum(p).alias(name))
        else:
            raise ValueError(f"salted_agg: unsupported function {fn}")
    partial = salted.groupBy(*keys, _SALT).agg(*phase1)
    return partial.groupBy(*keys).agg(*phase2)


SKETCH_SIZE = 4096          # of a quantile sketch; its ranks are right to about 1/1000


def salted_quantile(df: DataFrame, keys: list[str], col: str, quantiles: dict[str, float], salts: int = 16,
                    salt_cols: list[str] | None = None, size: int = SKETCH_SIZE) -> DataFrame:
    """Approximate quantiles (output name -> share) of a numeric column per key,
    nulls ignored: a KLL sketch per (key, salt), merged per key, so a hot key's
    values are never in one task. Whole numbers give whole numbers. A key
    without values has null quantiles."""
    whole = dict(df.dtypes)[col] in ("tinyint", "smallint", "int", "bigint")
    sketch, merge, quantile, cast = \
        (F.kll_sketch_agg_bigint, F.kll_merge_agg_bigint, F.kll_sketch_get_quantile_bigint, "bigint") if whole else \
        (F.kll_sketch_agg_double, F.kll_merge_agg_double, F.kll_sketch_get_quantile_double, "double")
    # the salt is of the whole row: a value that repeats is spread as well
    source = salt_cols or [c for c in df.columns if c not in keys]
    part = (df.filter(F.col(col).isNotNull()).withColumn(_SALT, salt_col(salts, *source)).groupBy(*keys, _SALT)
            .agg(sketch(F.col(col).cast(cast), F.lit(size)).alias("_s")))
    merged = part.groupBy(*keys).agg(merge("_s", F.lit(size)).alias("_s"))
    found = merged.select(*keys, *[quantile("_s", F.lit(float(q))).alias(name) for name, q in quantiles.items()])
    return _with_all_keys(df, found, keys)


def salted_mode(df: DataFrame, keys: list[str], col: str, out: str = "mode", count: str = "mode_count") -> DataFrame:
    """The most frequent value of a column per key (of several, the smallest;
    nulls ignored) and how often it occurs. Counting by (key, value) spreads a
    hot key over its values and a hot value is combined on the map side; the
    counts are then reduced to one row per key."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(col).alias("v"))).alias("_b"))
    return _with_all_keys(df, best.select(*keys, F.col("_b.v").alias(out), (-F.col("_b.n")).alias(count)), keys)


def salted_set(df: DataFrame, keys: list[str], col: str, out: str = "values", salts: int = 16) -> DataFrame:
    """The sorted distinct values of a column per key, nulls ignored. A value
    belongs to one salt, so the sets of the salts are disjoint: they are made
    apart, and only distinct values meet in a key's row."""
    part = (df.filter(F.col(col).isNotNull()).withColumn(_SALT, salt_col(salts, col)).groupBy(*keys, _SALT)
            .agg(F.collect_set(col).alias("_v")))
    found = part.groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("_v"))).alias(out))
    return _with_all_keys(df, found, keys)


def _with_all_keys(df: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """``found`` plus the keys of ``df`` that it lacks, with nulls."""
    k, f = df.select(*keys).distinct().alias("k"), found.alias("f")
    same = F.lit(True)
    for c in keys:
        same = same & F.col(f"k.{c}").eqNullSafe(F.col(f"f.{c}"))
    return k.join(f, same, "left").select(*[F.col(f"k.{c}").alias(c) for c in keys],
                                          *[F.col(f"f.{c}").alias(c) for c in found.columns if c not in keys])
