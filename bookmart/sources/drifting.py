"""Read landings whose schema drifts from file to file.

Landing folders are append-only: every batch adds files, and a column may be
absent, added, or change type from one file to the next. Spark merges the
schemas of all files in one parallel job; that covers absent and extra
columns, and the landing is read in one scan. Only where a column's types
conflict (int in one file, double in another) is the list of files cut in
halves, merged half by half side by side, until every part agrees; parts that
agree with each other are joined again. Each group of files is then one scan,
harmonised to the target types with ``try_cast``, and the groups are united by
name with typed nulls for missing columns. The files are those of the plain
scan, whatever their names, and partition folders give their columns. No file is read with a schema that
another file lent it, so no column is lost.

A landing written by ``land_batch`` has a manifest: every batch is a folder of its
own, and its schema is recorded beside it when it is whole. ``read_landing`` groups
the batches by recorded schema in one aggregate and opens no file to find out.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def harmonise(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the listed columns that are present (absent ones are left to
    the union); bad values become null rather than failing the job."""
    casts = {c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns}
    return df.withColumns(casts) if casts else df


def null_pad(df: DataFrame, schema: T.StructType) -> DataFrame:
    """S3: add absent columns as typed nulls and order columns by ``schema``;
    columns outside ``schema`` are kept after them."""
    have = set(df.columns)
    cols = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    extra = [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*cols, *extra)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name, missing columns filled with nulls."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merged_schema(spark: SparkSession, paths: list[str]) -> T.StructType | None:
    """The schema of all files together; None where types conflict."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE_SCHEMAS" in str(e):
            return None
        raise


def _plain(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("mergeSchema", "false").parquet(*paths)


def data_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """The files that a plain scan of the landing folders reads (a listing; no content)."""
    return sorted(unquote(f) for f in _plain(spark, paths).inputFiles())


def partition_folders(files: list[str], plain: T.StructType) -> tuple[dict[str, str], T.StructType]:
    """Per file the folder above its partition folders, and the partition
    columns; ``plain``: the columns of the plain scan."""
    fields = {f.name.lower(): f for f in plain.fields}
    bases, found = {}, {}
    for file in files:
        base = file.rsplit("/", 1)[0]
        while True:
            above, _, folder = base.rpartition("/")
            name = unquote(folder.partition("=")[0]).lower()
            if "=" not in folder or name not in fields:
                break
            base, found[name] = above, fields[name]
        bases[file] = base
    return bases, T.StructType([found[n] for n in fields if n in found])


def _agree(a: T.StructType, b: T.StructType) -> bool:
    types = {f.name: f.dataType for f in a.fields}
    return all(types.get(f.name, f.dataType) == f.dataType for f in b.fields)


def _joined(a: T.StructType, b: T.StructType) -> T.StructType:
    names = {f.name for f in a.fields}
    return T.StructType([*a.fields, *(f for f in b.fields if f.name not in names)])


def group_by_schema(spark: SparkSession, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Groups of files whose schemas agree, each with its merged schema."""
    schema = merged_schema(spark, files)
    if schema is not None:
        return [(schema, files)]
    if len(files) == 1:
        raise ValueError(f"the schema of {files[0]} cannot be read")
    half = len(files) // 2
    with ThreadPoolExecutor(2) as pool:
        parts = list(pool.map(lambda part: group_by_schema(spark, part), (files[:half], files[half:])))
    groups: list[tuple[T.StructType, list[str]]] = []
    for schema, members in [g for part in parts for g in part]:
        for i, (other, held) in enumerate(groups):
            if _agree(other, schema):
                groups[i] = (_joined(other, schema), held + members)
                break
        else:
            groups.append((schema, members))
    return groups


def read_drifting(spark: SparkSession, paths: list[str],
                  types: dict[str, str] | None = None) -> DataFrame:
    """One table out of drifting landing folders."""
    schema = merged_schema(spark, paths)
    if schema is not None:
        return harmonise(spark.read.schema(schema).parquet(*paths), types or {})
    found = data_files(spark, paths)
    bases, partitions = partition_folders(found, _plain(spark, paths).schema)
    landed = {f.name.lower() for f in partitions.fields}
    frames = []
    for schema, group in group_by_schema(spark, found):
        # partition columns have the types that all the folders' values give
        full = T.StructType([*(f for f in schema.fields if f.name.lower() not in landed), *partitions.fields])
        for base in sorted({bases[f] for f in group}):
            files = [f for f in group if bases[f] == base]
            frames.append(harmonise(spark.read.option("basePath", base).schema(full).parquet(*files), types or {}))
    return union_by_name(frames)


# --- landings with a manifest -----------------------------------------------------

_BATCH = T.StructType([T.StructField("folder", T.StringType()), T.StructField("schema", T.StringType()),
                       T.StructField("replaces", T.ArrayType(T.StringType()))])
PACKED_BYTES = 128 << 20      # of a file that compaction aims at


def _record(df: DataFrame, path: str, replaces: list[str], batch_rows: int | None = None) -> str:
    """Write a batch, then name it in the manifest."""
    folder = uuid.uuid4().hex
    w = df.write.option("compression", "snappy")
    (w.option("maxRecordsPerFile", batch_rows) if batch_rows else w).parquet(f"{path.rstrip('/')}/{folder}")
    row = df.sparkSession.createDataFrame([(folder, df.schema.json(), replaces)], _BATCH).coalesce(1)
    row.write.mode("append").parquet(f"{path.rstrip('/')}/_manifest")
    return folder


def _batches(spark: SparkSession, path: str) -> DataFrame:
    """(folder, schema) of the recorded batches that no other replaces."""
    rows = spark.read.schema(_BATCH).parquet(f"{path.rstrip('/')}/_manifest")
    gone = rows.select(F.explode("replaces").alias("folder"))
    return rows.select("folder", "schema").distinct().join(gone, "folder", "left_anti")


def land_batch(df: DataFrame, path: str, batch_rows: int | None = None) -> str:
    """Land one batch, in files of at most ``batch_rows`` rows, and record
    its schema; a batch that is not recorded yet is not read."""
    return _record(df, path, [], batch_rows)


def read_landing(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """All recorded batches as one table, one scan per recorded schema."""
    groups = (_batches(spark, path).groupBy("schema").agg(F.sort_array(F.collect_set("folder")).alias("folders"))
              .orderBy("schema"))
    frames = [harmonise(spark.read.schema(T.StructType.fromJson(json.loads(g["schema"])))
                        .parquet(*[f"{path.rstrip('/')}/{f}" for f in g["folders"]]), types or {})
              for g in groups.toLocalIterator()]          # as many rows as there are schemas
    return union_by_name(frames)


def compact_landing(spark: SparkSession, path: str, target_bytes: int = PACKED_BYTES) -> list[str]:
    """S4 by size: batches below ``target_bytes`` are packed, schema by schema,
    into one new batch of files of about that size, which the manifest names as
    their replacement; larger batches are not read. Until the new batch is named,
    readers see the old ones. Returns the new folders; those replaced may be
    deleted when no reader is at them any more."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)      # a listing; no content
             .select(F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("folder"), "length"))
    sizes = files.groupBy("folder").agg(F.sum("length").alias("bytes"))
    small = (_batches(spark, path).join(sizes, "folder").filter(F.col("bytes") < target_bytes).groupBy("schema")
             .agg(F.sort_array(F.collect_set("folder")).alias("folders"), F.sum("bytes").alias("bytes"))
             .filter(F.size("folders") > 1).orderBy("schema"))
    new = []
    for g in small.toLocalIterator():                     # as many rows as there are schemas
        rows = spark.read.schema(T.StructType.fromJson(json.loads(g["schema"]))).parquet(
            *[f"{path.rstrip('/')}/{f}" for f in g["folders"]])
        new.append(_record(rows.repartition(-(-g["bytes"] // target_bytes)), path, g["folders"]))
    return new
