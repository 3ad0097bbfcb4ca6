"""The training-data pipeline: quality classifier, line dedup, SimHash
near-dedup, mixing, BPE encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet in the shared checkpoint folder and reads again for the next
stage. All stages but the last return the columns of ``documents``; the last
returns the encoded corpus: one row per document the mix takes, with its ids
and the digest of their decoding.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookmart.llm import bpe, line_spread, mixing, simhash_cover, site_quality
from bookmart.llm.common import documents, materialise, table, text_batches


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Cases: null, empty and blank texts are judged as empty ones; null source or
    lang is a site of its own; repeated rows are kept or go together; without
    usable labels all stay; very long texts are read whole; an empty table stays
    empty; other columns pass."""
    with text_batches(spark):
        return site_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines spread over many sites go but for their first place; n_chars follows.

    Cases: a null text stays null (with null n_chars); a document all of whose
    lines go stays with an empty text; blank lines stay; null sources are no site;
    of repeated rows of a doc_id the first place is that of its smallest line
    number; an empty table stays empty; other columns pass."""
    return line_spread.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays.

    Cases: null, empty and blank texts share fingerprint 0 and are one group;
    rows without doc_id stay only in a group without any doc_id; of equal
    (doc_id, text) rows the one with the smallest other columns stays; very long
    texts are read whole; an empty table stays empty; other columns pass."""
    with text_batches(spark):
        return simhash_cover.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source comes to its target; a document may be repeated.

    Cases: null, empty and blank texts have no words and are not taken; null
    source is a source; rows without doc_id, or with one doc_id and different
    texts, are told apart by their text; equal rows are taken together; an empty
    table stays empty; other columns pass."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as ids: doc_id, source, lang, n_tokens, ids and the digests
    of the ids and of the text that they decode to.

    Cases: null and empty texts have no ids; every row gives a row, repeated ones
    too; nulls in other columns pass; very long texts are encoded whole; an empty
    table stays empty; other columns are not returned."""
    return bpe.encode_corpus(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", quality), ("line dedup", line_dedup), ("SimHash near-dedup", near_dedup),
          ("mixing sources", mix), ("BPE encoding", encode)]

# The fit of the classifier, SimHash and BPE are beyond SQL; the stages are
# tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
