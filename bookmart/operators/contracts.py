"""C1 key contract and C2 type / length contract: reports, and the split of a
staging into rows that meet the declared schema and rejects with their reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One reject: the row as JSON, and what is wrong with it, column by column.
REJECT = T.StructType([
    T.StructField("row_json", T.StringType()),
    T.StructField("reasons", T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("column", "reason", "value")]))),
])


def key_report(df: DataFrame, table: str, key: str) -> DataFrame:
    """One row: rows, null keys, keys held by more than one row, and the
    number of rows those duplicated keys hold. Counting per key first keeps a
    hot key to one partial row per task."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("n_null_keys"),
        F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("n_dup_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull() & (F.col("_n") > 1), F.col("_n"))),
                   F.lit(0)).alias("n_dup_rows"),
    ).select(F.lit(table).alias("table_name"), F.lit(key).alias("key_column"),
             F.col("n_rows").cast("bigint").alias("n_rows"),
             F.col("n_null_keys").cast("bigint").alias("n_null_keys"),
             F.col("n_dup_keys").cast("bigint").alias("n_dup_keys"),
             F.col("n_dup_rows").cast("bigint").alias("n_dup_rows"))


def keys_report(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    parts = [key_report(df, name, k) for name, (df, k) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def length_report(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """One row per limited column: longest value and values over the limit,
    all computed in a single aggregate pass."""
    exprs = []
    for c, n in limits.items():
        exprs += [F.max(F.length(c)).alias(f"{c}__max"),
                  F.count_if(F.length(c) > n).alias(f"{c}__over")]
    wide = df.agg(*exprs)
    stack = ", ".join(f"'{c}', {n}, `{c}__max`, `{c}__over`" for c, n in limits.items())
    return wide.selectExpr(
        f"stack({len(limits)}, {stack}) as (column_name, max_allowed, max_length, n_too_long)"
    ).select(F.lit(table).alias("table_name"), "column_name",
             F.col("max_allowed").cast("int").alias("max_allowed"),
             F.col("max_length").cast("int").alias("max_length"),
             F.col("n_too_long").cast("bigint").alias("n_too_long"))


def _is_whole(t: T.DataType) -> bool:
    return isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def misfit(c: str, held: T.DataType, declared: T.DataType) -> Column:
    """Whether a value is lost by the cast to its declared type: the cast gives
    null, or a whole number for a value that is none."""
    if held == declared or isinstance(declared, T.StringType):
        return F.lit(False)
    out = F.col(c).try_cast(declared)
    lost = F.col(c).isNotNull() & out.isNull()
    if _is_whole(declared) and isinstance(held, (T.FloatType, T.DoubleType, T.DecimalType)):
        lost = lost | F.coalesce(out.cast(held) != F.col(c), F.lit(False))
    return lost


def type_report(df: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """One row per declared column: its type here and as declared, values, and
    values that the declared type cannot hold; one aggregate pass. A column
    that is absent is reported as such, without values."""
    held = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for i, f in enumerate(schema.fields):
        if f.name in held:
            exprs += [F.count(f.name).alias(f"v{i}"), F.count_if(misfit(f.name, held[f.name], f.dataType)).alias(f"b{i}")]
        else:
            exprs += [F.lit(0).cast("bigint").alias(f"v{i}"), F.lit(0).cast("bigint").alias(f"b{i}")]
    rows = [F.struct(F.lit(f.name).alias("column_name"),
                     F.lit(held[f.name].simpleString() if f.name in held else "absent").alias("found_type"),
                     F.lit(f.dataType.simpleString()).alias("declared_type"),
                     F.col(f"v{i}").cast("bigint").alias("n_values"), F.col(f"b{i}").cast("bigint").alias("n_misfits"))
            for i, f in enumerate(schema.fields)]
    return (df.agg(*exprs).select(F.explode(F.array(*rows)).alias("r"))
            .select(F.lit(table).alias("table_name"), "r.*"))


def reasons(df: DataFrame, schema: T.StructType, limits: dict[str, int] | None = None, key: str | None = None) -> Column:
    """What is wrong with a row: values beyond their declared type or length,
    and a key that is null. An empty array: nothing."""
    held, found = {f.name: f.dataType for f in df.schema.fields}, []

    def reason(c: str, text: str, wrong: Column) -> Column:
        return F.when(wrong, F.struct(F.lit(c).alias("column"), F.lit(text).alias("reason"),
                                      F.col(c).cast("string").alias("value")))

    for f in schema.fields:
        found.append(reason(f.name, f"not {f.dataType.simpleString()}", misfit(f.name, held[f.name], f.dataType)))
        if f.name in (limits or {}):
            found.append(reason(f.name, f"longer than {limits[f.name]}", F.length(F.col(f.name).cast("string")) > limits[f.name]))
    if key:
        found.append(reason(key, "no key", F.col(key).isNull()))
    return F.filter(F.array(*found), lambda r: r.isNotNull())


def split_valid(df: DataFrame, schema: T.StructType, limits: dict[str, int] | None = None,
                key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that meet the contract, with the declared columns and types;
    rejects as ``REJECT``). A declared column that is absent is an error: no
    row could be whole."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"the staging has no column {', '.join(missing)}")
    judged = df.select(*schema.names, reasons(df, schema, limits, key).alias("_bm_reasons"))
    good = judged.filter(F.size("_bm_reasons") == 0).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    bad = judged.filter(F.size("_bm_reasons") > 0).select(
        F.to_json(F.struct(*schema.names)).alias("row_json"), F.col("_bm_reasons").alias("reasons"))
    return good, bad


def conform(df: DataFrame, schema) -> DataFrame:
    """Select the declared columns by name, cast to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
