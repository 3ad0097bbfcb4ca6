"""A2, A2b across loads: medians without reading old rows again.

Every load stores one quantile sketch per column beside its rows (a few KB
whatever the load's size). The median over all loads is that of the merged
sketches, so a new load is imputed from its own rows and the stored sketches. A
load run again replaces its sketches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import merge

SIZE = 4096                 # ranks are right to about 1/1000
_ROW = T.StructType([T.StructField("column_name", T.StringType()), T.StructField("sketch", T.BinaryType()),
                     T.StructField("n_values", T.LongType()), T.StructField("n_rows", T.LongType())])


def record(df: DataFrame, root: str, load: str, cols: list[str], size: int = SIZE) -> None:
    """Store the sketches of one load (a day), one aggregate pass over its rows."""
    aggs = [a for i, c in enumerate(cols) for a in (
        F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias(f"s{i}"), F.count(c).alias(f"n{i}"))]
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("sketch"), F.col(f"n{i}").alias("n_values"),
                     F.col("_rows").alias("n_rows")) for i, c in enumerate(cols)]
    one = df.agg(*aggs, F.count(F.lit(1)).alias("_rows")).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    merge.append_changes(one.filter("n_values > 0"), root, "load", load, as_of=load)


def quantiles(spark: SparkSession, root: str, share: float = 0.5, size: int = SIZE) -> DataFrame:
    """column_name, value (the quantile over all loads), n_values."""
    held = merge.read_all(spark, root, _ROW)
    merged = held.groupBy("column_name").agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("s"),
                                             F.sum("n_values").alias("n_values"))
    return merged.select("column_name", F.kll_sketch_get_quantile_double("s", F.lit(share)).alias("value"), "n_values")


def fill(df: DataFrame, root: str, cols: list[str]) -> DataFrame:
    """Replace nulls in ``cols`` by the medians over all recorded loads (in the
    column's type; a column without any value stays null). Lazy: one scalar
    subquery over the sketches."""
    found = quantiles(df.sparkSession, root)
    held = "_bm_medians"
    one = found.agg(*[F.max(F.when(F.col("column_name") == c, F.col("value"))).alias(c) for c in cols])
    types = dict(df.dtypes)
    return (df.withColumn(held, one.select(F.struct(*cols).alias("m")).scalar())
            .withColumns({c: F.coalesce(F.col(c), F.col(held).getField(c).cast(types[c])) for c in cols}).drop(held))
