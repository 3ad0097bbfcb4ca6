"""Cross-site line dedup by distinct-site spread, in DataFrame operations only.

Every non-blank line is keyed by two hashes. One aggregation merges a
HyperLogLog sketch of the sites that carry the line, per line key, together
with the line's first place (smallest doc_id, then line number). Map tasks
combine the sketches of a line before the shuffle, so a line found in a third
of all documents arrives as one sketch per task. Lines whose estimate is
clearly below the threshold are done; clearly above, they are boilerplate; the
ones near it (within ``MARGIN``, many times the sketch's standard error) get
an exact distinct count, for which only their own (line, site) pairs are
shuffled. The result therefore equals that of exact counts.

A boilerplate line is removed everywhere but at its first place, so one copy
of everything stays in the corpus.

Cases: null text has no lines and stays null; blank lines (spaces, tabs,
carriage returns) are neither counted nor removed; a null site counts as no
site; null doc_id orders last; repeated rows share their lines' places, so the
first place can be kept on each of them; equal lines inside one document are
removed but for the first place; very long texts are cut into lines whole, one
row in memory at a time; an empty table gives an empty result; other columns
pass through unchanged. A key that a third of all lines share (a footer) is one
row of ``found``; in the join that marks its places AQE splits its partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, unused

MIN_SITES = 5
SKETCH_LG_K = 10          # standard error about 3 %
MARGIN = 1.5              # near the threshold: estimate within [1/1.5, 1.5] of it
_BLANK = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _identity(docs: DataFrame, doc_col: str, text_col: str) -> list[Column]:
    """What tells a row of a document from rows with other texts."""
    return [F.col(doc_col).alias("_doc"), F.xxhash64(F.col(text_col)).alias("_text_key")]


def _occurrences(docs: DataFrame, doc_col: str, text_col: str, site_col: str) -> DataFrame:
    line = F.col("l.line")
    return (docs.select(*_identity(docs, doc_col, text_col), F.col(site_col).cast("string").alias("_site"),
                        F.posexplode(_lines(F.col(text_col))).alias("_pos", "line")).alias("l")
            .filter(F.length(F.expr(f"trim(BOTH '{_BLANK}' FROM l.line)")) > 0)
            .select("_doc", "_text_key", "_site", "_pos", F.xxhash64(line).alias("_k1"),
                    F.hash(line).alias("_k2")))


def boilerplate_lines(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text",
                      site_col: str = "source", min_sites: int = MIN_SITES) -> tuple[DataFrame, DataFrame]:
    """(occurrences, boilerplate): all non-blank lines by key, and the keys
    spread over at least ``min_sites`` sites with their first place."""
    seen = materialise(_occurrences(docs, doc_col, text_col, site_col), "line-occurrences")
    place = F.struct(F.col("_doc").isNull().alias("n"), F.col("_doc").alias("d"), F.col("_pos").alias("p"))
    spread = materialise(
        seen.groupBy("_k1", "_k2")
        .agg(F.hll_sketch_agg("_site", F.lit(SKETCH_LG_K)).alias("sketch"), F.min(place).alias("first"))
        .select("_k1", "_k2", "first", F.hll_sketch_estimate("sketch").alias("sites"))
        .filter(F.col("sites") >= min_sites / MARGIN), "line-spread")
    near = spread.filter(F.col("sites") <= min_sites * MARGIN).select("_k1", "_k2")
    exact = (seen.join(near, ["_k1", "_k2"], "left_semi").filter(F.col("_site").isNotNull())
             .select("_k1", "_k2", "_site").distinct()
             .groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("exact")))
    found = (spread.join(exact, ["_k1", "_k2"], "left")
             .filter((F.col("sites") > min_sites * MARGIN) | (F.col("exact") >= min_sites))
             .select("_k1", "_k2", "first"))
    return seen, materialise(found, "line-boilerplate")


def _removed_lines(docs: DataFrame, doc_col: str, text_col: str, site_col: str, min_sites: int) -> DataFrame:
    """Per document with boilerplate: the numbers of the lines to remove."""
    seen, found = boilerplate_lines(docs, doc_col=doc_col, text_col=text_col, site_col=site_col, min_sites=min_sites)
    is_first = (F.col("first.d").eqNullSafe(F.col("_doc"))) & (F.col("first.p") == F.col("_pos"))
    return (seen.join(found, ["_k1", "_k2"]).filter(~is_first)
            .groupBy("_doc", "_text_key").agg(F.collect_set("_pos").alias("_gone")))


def remove_boilerplate(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text",
                       site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with the text cleaned, and two more columns at the end:
    ``_n_lines`` (lines of the input text) and ``_n_removed`` (names that
    ``docs`` has already are lengthened)."""
    gone = materialise(_removed_lines(docs, doc_col, text_col, site_col, min_sites), "line-removed").alias("g")
    key, lines, out = unused("_text_key", docs), unused("_lines", docs), unused("_gone", docs)
    keyed = docs.select("*", F.xxhash64(F.col(text_col)).alias(key)).alias("d")
    joined = keyed.join(gone, F.col(f"d.{doc_col}").eqNullSafe(F.col("g._doc"))
                        & (F.col(f"d.{key}") == F.col("g._text_key")), "left")
    # a column of its own: split once a row, however many lines are looked up
    cut = joined.select("d.*", F.col("g._gone").alias(out), _lines(F.col(f"d.{text_col}")).alias(lines))
    # the numbers that stay, by hash set: linear in the lines of a document
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(out))
    kept = F.when(F.col(out).isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col(lines), i)), "\n"))
    columns = [kept.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return cut.select(*columns, F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(unused("_n_lines", docs)),
                      F.coalesce(F.size(out), F.lit(0)).cast("long").alias(unused("_n_removed", docs)))


def line_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed and the kept text's sha256."""
    doc_col, text_col = options.get("doc_col", "doc_id"), options.get("text_col", "text")
    narrow = docs.select(doc_col, text_col, options.get("site_col", "source"))
    return remove_boilerplate(narrow, **options).select(
        F.col(doc_col).alias("doc_id"), F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
        F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("kept_sha256"))


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with boilerplate lines removed; all rows and columns stay."""
    return remove_boilerplate(docs, **options).select(*docs.columns)


# DuckDB text of line_report with the parameters above, on exact counts.
ORACLE_SQL = r"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
b AS (SELECT line, count(DISTINCT source) AS sites,
             min({'n': doc_id IS NULL, 'd': doc_id, 'p': pos}) AS first
      FROM l WHERE length(trim(line, chr(32) || chr(9) || chr(13))) > 0
      GROUP BY line HAVING count(DISTINCT source) >= 5),
m AS (SELECT l.doc_id, l.pos, l.line,
             b.line IS NOT NULL AND NOT (b.first.d = l.doc_id AND b.first.p = l.pos) AS gone
      FROM l LEFT JOIN b ON l.line = b.line),
k AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
      FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
"""
