"""Landed API responses to records and links.

Fetching is not part of this engine: it starts from response documents that
were landed as JSON text (one document per line), one page of records each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import jsoncols as J


def read_responses(spark: SparkSession, path: str, page_schema: T.StructType) -> DataFrame:
    """Landed JSON pages read with a declared schema (no inference pass)."""
    return spark.read.schema(page_schema).json(path)


# FIXED VALUES: the lists of records in the three kinds of response pages.
PAGE_LISTS = ("works", "entries", "subjects")


def read_pages(spark: SparkSession, path: str, record: T.StructType,
               lists: tuple[str, ...] = PAGE_LISTS) -> tuple[DataFrame, DataFrame]:
    """S9 for pages of any known shape, one JSON document per line: (records
    with ``page_list`` and the columns of ``record``, rejected pages with
    ``reason`` and ``page``). A page is held as VARIANT, so its shape is looked
    up, not declared: the first of ``lists`` that is an array gives its
    records. Text that is no JSON and pages without such a list are rejects;
    fields that a record lacks, or that do not fit their type, are null."""
    pages = spark.read.text(path).select(F.col("value").alias("page"), F.try_parse_json("value").alias("v"))
    found = F.coalesce(*[F.when(F.try_variant_get("v", f"$.{name}", "array<variant>").isNotNull(), F.lit(name)) for name in lists])
    pages = pages.withColumn("page_list", found)
    rows = F.coalesce(*[F.try_variant_get("v", f"$.{name}", "array<variant>") for name in lists])
    one = [F.try_variant_get("r", f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in record.fields]
    records = (pages.filter(F.col("page_list").isNotNull()).select("page_list", F.explode(rows).alias("r"))
               .select("page_list", *one))
    reason = F.when(F.col("v").isNull(), F.lit("no JSON")).otherwise(F.lit("no known list"))
    return records, pages.filter(F.col("page_list").isNull()).select(reason.alias("reason"), "page")


def explode_response(pages: DataFrame, array_field: str) -> DataFrame:
    """One row per record of the page's ``array_field`` (``works``,
    ``entries``, ...); pages without records give no rows."""
    return pages.select(F.explode(F.col(array_field)).alias("r")).select("r.*")


def pages_of(records: DataFrame, array_field: str, page_size: int,
             order_col: str) -> DataFrame:
    """Group records into response-like pages of at most ``page_size``
    records: ``order_col`` is a unique integer, page = order_col // page_size,
    so every page group is bounded by ``page_size``."""
    body = [c for c in records.columns if c != order_col]
    return (records.withColumn("page", F.floor(F.col(order_col) / page_size))
            .groupBy("page").agg(F.collect_list(F.struct(*body)).alias(array_field)))


def linked_keys(records: DataFrame, id_col: str, links_col: str,
                schema=J.LINK_ARRAY) -> DataFrame:
    """(record id, linked key) for a JSON links column in either shape;
    links without a key are dropped."""
    x = records.select(id_col, F.explode_outer(J.parse(links_col, schema)).alias("l"))
    return (x.select(id_col, J.link_key(F.col("l")).alias("linked_key"))
            .filter(F.col("linked_key").isNotNull()))
