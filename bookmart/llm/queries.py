"""The queries of this subpackage and their DuckDB texts, where SQL can
express them. Each applies its operator with production parameters to its
whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (blocked_search, bpe, imatch, line_spread, maxscore, mixing, pii_votes, quality_rules, rans, recompress,
               simhash_cover, site_quality, whitening)
from .common import documents, table


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_report(documents(spark, sf_dir))


def op2_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.line_report(documents(spark, sf_dir))


def op3_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_report(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_simhash_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_cover.simhash_report(documents(spark, sf_dir))


def op5_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.dedup_report(documents(spark, sf_dir))


def op6_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.search(table(spark, sf_dir, "embeddings"))


def op7_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.score(documents(spark, sf_dir), table(spark, sf_dir, "labels")).drop("text_key")


def op8_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.report(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_pii_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_votes.detect(documents(spark, sf_dir))


def op10_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op13_blocked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocked_search.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_imatch, op2_line_spread, op3_bpe_transducer, op4_simhash_cover, op5_recompression,
                                   op6_maxscore, op7_site_quality, op8_rans, op9_pii_votes, op10_water_filling, op11_whitening,
                                   op12_quality_rules, op13_blocked_search)}

ORACLE = {"op2_line_spread": line_spread.ORACLE_SQL, "op5_recompression": recompress.ORACLE_SQL,
          "op6_maxscore": maxscore.ORACLE_SQL,
          "op10_water_filling": mixing.ORACLE_SQL, "op13_blocked_search": blocked_search.ORACLE_SQL}
