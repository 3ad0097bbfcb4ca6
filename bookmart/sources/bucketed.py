"""Tables kept bucketed by a key under a folder: rows of one key lie in one
bucket of every write, so grouping by the key, windows over it and joins of two
tables with as many buckets move nothing.

The number of buckets is fixed when the folder gets its first rows and kept in
``layout`` beside them. Bucketing is a property of a catalog table, so every
session that reads or writes makes an external table of its own over the
folder, under a name that follows from the folder and the columns.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

BUCKET_ROWS = 1 << 20        # rows of a bucket at the first write, about
LEAST_BUCKETS = 8
_LAYOUT = T.StructType([T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("buckets", T.IntegerType())])


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def read_if_written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A parquet table, or None if nothing has been written there. Every other
    failure is raised: an unreadable table is not an empty one."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else None


def layout(spark: SparkSession, root: str) -> tuple[list[str], int] | None:
    """(keys, buckets) of a bucketed folder; None if it is not one."""
    found = read_if_written(spark, f"{root.rstrip('/')}/layout", _LAYOUT)
    row = None if found is None else found.first()
    return None if row is None else (list(row["keys"]), row["buckets"])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _catalog_table(spark: SparkSession, root: str, schema: T.StructType, keys: list[str], buckets: int) -> str:
    path = f"{root.rstrip('/')}/rows"
    name = "bookmart_" + hashlib.md5(json.dumps([path, schema.jsonValue(), keys, buckets]).encode()).hexdigest()[:20]
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(map(_quoted, keys))
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
                  f"INTO {buckets} BUCKETS LOCATION '{place}'")
    return name


def append(df: DataFrame, root: str, keys: list[str], buckets: int | None = None) -> None:
    """Append rows; the first append fixes keys and buckets (by default from
    its number of rows). One task writes one bucket, so a bucket gains one file."""
    spark, held = df.sparkSession, layout(df.sparkSession, root)
    if held is None:
        if buckets is None:
            df = materialise(df, "first-rows")
            buckets = max(LEAST_BUCKETS, -(-df.count() // BUCKET_ROWS))
        spark.createDataFrame([(keys, buckets)], _LAYOUT).write.mode("overwrite").parquet(f"{root.rstrip('/')}/layout")
    else:
        if held[0] != keys:
            raise ValueError(f"{root} is bucketed by {held[0]}")
        buckets = held[1]
    name = _catalog_table(spark, root, df.schema, keys, buckets)
    df.repartition(buckets, *keys).write.mode("append").insertInto(name)


def read(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows of a bucketed folder (an error where there is none)."""
    keys, buckets = layout(spark, root)
    name = _catalog_table(spark, root, schema, keys, buckets)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def read_or_empty(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema) if layout(spark, root) is None else read(spark, root, schema)


def largest_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """One row: rows, and rows of the largest bucket, if ``df`` were bucketed."""
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    return df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("n_rows"), F.max("n").alias("largest"))


# --- co-location by a key with hot values (C3) ---------------------------------

SALT = "_bm_salt"


def hot_keys(df: DataFrame, key: str, limit: int) -> DataFrame:
    """(key, parts): the values of ``key`` with more than ``limit`` rows, and in
    how many parts of at most about ``limit`` rows they go. There are fewer of
    them than rows / limit, i.e. than buckets of that size."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).cast("int").alias("parts"))


def salted(df: DataFrame, key: str, hot: DataFrame, buckets: int) -> DataFrame:
    """``df`` with a salt: a hash of the row within the parts of its key; 0 for
    other keys; rows without a key, which no equality join finds, go anywhere."""
    row = F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")])
    salt = F.when(F.col(key).isNull(), F.pmod(row, F.lit(buckets))).when(
        F.col("parts").isNotNull(), F.pmod(row, F.col("parts"))).otherwise(F.lit(0))
    return df.join(F.broadcast(hot), key, "left").select(*df.columns, salt.cast("int").alias(SALT))


def replicated(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The other side of a join: rows of a hot key once for each of its parts."""
    last = F.coalesce(F.col("parts"), F.lit(1)) - 1
    return (df.join(F.broadcast(hot), key, "left")
            .select(*df.columns, F.explode(F.sequence(F.lit(0), last)).alias(SALT)))


def co_located(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join a salted and a replicated table bucketed by (key, salt): without an
    exchange where both have as many buckets."""
    return left.join(right, [key, SALT], how).drop(SALT)
