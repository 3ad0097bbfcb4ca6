"""Raw catalogue landings derived from the driver tables.

The driver tables hold no nulls, so the raw works / editions / authors that
the cleaning rules expect are derived from ``part``, ``lineitem`` and
``supplier`` by a fixed recipe (FIXTURES.md section 3). The recipe injects
bad keys, nulls, junk subjects and publishers; every input row yields one raw
row, so the raw tables grow with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path
from ..sources.scan import read_parquet


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    return read_parquet(spark, table_path(sf_dir, name), columns)


def raw_works(spark: SparkSession, sf_dir: str, keep_id: bool = False) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_size", "p_brand"])
    k = F.col("p_partkey")
    subject = (F.when(k % 13 == 5, F.lit(None).cast("string"))
               .when(k % 17 == 6, F.lit("[]"))
               .otherwise(F.concat(
                   F.lit('["'), F.lower("p_type"), F.lit('", "genre:'), F.col("p_name"),
                   F.lit('", "'), F.col("p_brand"), F.lit('", "form:a & b", "'),
                   F.col("p_name"), F.lit('.com", " '),
                   F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), F.lit(' "]'))))
    authors = F.concat(
        F.lit('[{"key":"/authors/OL'), _s(k % 100), F.lit('A","name":"n"},'),
        F.lit('{"key":"/authors/OL'), _s((k * 7) % 100), F.lit('A","name":"m"}]'))
    extra = [k.alias("_pk")] if keep_id else []
    return p.select(
        *extra,
        F.when(k % 101 == 100, F.lit("bad-key"))
         .otherwise(F.concat(F.lit("/works/OL"), _s(k), F.lit("W"))).alias("key"),
        F.col("p_name").alias("title"),
        F.when(k % 11 == 3, F.lit(None).cast("string"))
         .otherwise(_s(1900 + F.col("p_size") * 2)).alias("first_publish_year"),
        F.col("p_size").cast("bigint").alias("edition_count"),
        subject.alias("subject"),
        authors.alias("authors"),
    )


def raw_editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate"])
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    null_s = F.lit(None).cast("string")
    return li.select(
        F.concat(F.lit("/books/OL"), _s(ok * 10 + ln), F.lit("M")).alias("key"),
        F.when(pk % 19 == 7, F.lit("[]"))
         .otherwise(F.concat(F.lit('[{"key":"/works/OL'), _s(pk), F.lit('W"}]'))).alias("works"),
        F.when(ok % 23 == 1, null_s).when(ok % 23 == 2, F.lit("1234"))
         .otherwise(F.concat(F.lit("Book "), _s(pk))).alias("title"),
        F.when(ok % 29 == 3, null_s).when(ok % 29 == 4, F.lit("undated"))
         .when(ok % 29 == 5, F.lit("0987"))
         .otherwise(F.concat(F.lit("March 1, "), _s(F.year("l_shipdate")))).alias("publish_date"),
        F.when(sk % 31 == 8, null_s).when(sk % 31 == 9, F.lit('["[s.n.]"]'))
         .when(sk % 31 == 10, F.lit('["printed by smith"]'))
         .otherwise(F.concat(F.lit('["supplier house '), F.col("l_returnflag"),
                             F.lit('.", "press & co '), F.col("l_linestatus"),
                             F.lit('-"]'))).alias("publishers"),
        F.when(ln == 1, null_s).when(ln == 2, F.lit('[{"key":"/languages/vie"}]'))
         .when(ln == 3, F.lit('[{"key":"/languages/lat"}]')).when(ln == 4, F.lit("[]"))
         .otherwise(F.lit('[{"key":"/languages/eng"}]')).alias("languages"),
        F.when(ok % 37 == 9, F.lit(None).cast("bigint"))
         .otherwise((F.col("l_quantity") * 10).cast("bigint")).alias("number_of_pages"),
        F.concat(F.lit('["978'), _s(pk), F.lit('"]')).alias("isbn_13"),
    )


def raw_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    k = F.col("s_suppkey")
    null_s = F.lit(None).cast("string")
    return s.select(
        F.concat(F.lit("/authors/OL"), _s(k), F.lit("A")).alias("key"),
        F.when(k % 10 == 4, null_s).when(k % 10 == 5, F.lit("n/a"))
         .otherwise(F.col("s_name")).alias("name"),
        F.when(k % 3 == 0, null_s).when(k % 3 == 1, F.lit("circa"))
         .otherwise(F.concat(F.lit("5 May "), _s(1800 + F.col("s_nationkey") * 5))).alias("birth_date"),
    )
