"""JSON-in-string columns: parse, take the first key, explode, serialise.

Malformed text (for example the constant ``unknown``) parses to null, so
``explode`` drops the row; ``get`` returns null on an empty array where
``[0]`` would fail under ANSI.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_ARRAY = T.ArrayType(T.StructType([T.StructField("key", T.StringType())]))
KEY_NAME_ARRAY = T.ArrayType(T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("name", T.StringType()),
]))
STRING_ARRAY = T.ArrayType(T.StringType())
# Both link shapes seen in landed records: {"key": ..} and {"author": {"key": ..}}.
LINK_ARRAY = T.ArrayType(T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("author", T.StructType([T.StructField("key", T.StringType())])),
]))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse(c, schema) -> Column:
    return F.from_json(_col(c), schema)


# first element's key of a JSON array of {"key": ..}; [] / bad -> null.
def first_key(c, schema=KEY_ARRAY, field: str = "key") -> Column:
    return F.get(parse(c, schema), 0).getField(field)


# One row per array element (rows with null / empty arrays vanish).
def explode_json(df: DataFrame, c: str, schema, out: str) -> DataFrame:
    return df.withColumn(out, F.explode(parse(c, schema)))


# key of a link in either shape.
def link_key(element: Column) -> Column:
    return F.coalesce(element.getField("author").getField("key"),
                      element.getField("key"))


# Every struct / array / map column to JSON text.
def nested_to_json(df: DataFrame) -> DataFrame:
    nested = (T.StructType, T.ArrayType, T.MapType)
    cols = [F.to_json(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)
