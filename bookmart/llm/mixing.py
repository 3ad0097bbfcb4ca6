"""Mixing sources to target weights by capped water-filling.

Every source gets a share of ``epochs`` times all words in proportion to its
weight, but at most ``max_epochs`` times its own words; what the cap cuts off
is shared out again by weight until no target is above its cap. The level
``L`` with ``sum(min(cap, weight * L)) = total`` is found by rounds: the
sources at their cap leave the pot and the rest of the total is divided by the
weights still open. Each round is one aggregate over the table of sources;
only two sums reach the driver.

A target of ``f`` times a source's words takes every document ``floor(f)``
times and a seeded share of the documents once more: documents are ordered by
``md5(seed:doc_id:md5(text))`` and taken from the front while the middle of the
document lies within the missing words, so a source misses its target by at
most half a document. The prefix sums run over (source, leading hex digits of
the hash) groups first and inside such a group second; the number of digits
follows from the number of documents, so a source that holds a third of all
rows is spread over groups of bounded size. The result is one cut-off hash per
source, and a document is decided from its own row and its source's row alone
(texts are never shuffled).

Cases: null or blank text has size 0 and is never taken (0 words); null source
is a source of its own, ordered last; rows without doc_id, or with one doc_id
and different texts, are told apart by the text; rows equal in doc_id, text and
source are taken together, as one document of their joint size; a source at its
cap takes no document once more; very long texts are counted whole; an empty
table gives an empty result; other columns pass through unused. Reruns agree:
nothing depends on the layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import surrogate_key
from .common import materialise, unused, word_count

WEIGHTS = (3, 1, 2)
EPOCHS = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
GROUP_ROWS = 20_000         # documents of a group, about
LEAST_DIGITS = 3


def water_level(sources: DataFrame, total: float, cap: str = "cap", weight: str = "weight") -> float:
    """The level at which ``sum(min(cap, weight * level))`` is ``total`` (or
    every source is at its cap). A round adds at least one source to the
    capped ones or ends, and the level only rises."""
    weights = sources.agg(F.sum(weight)).first()[0]
    if not weights:
        return 0.0
    level = total / weights
    while True:
        full, open_ = sources.agg(
            F.coalesce(F.sum(F.when(F.col(cap) <= F.col(weight) * level, F.col(cap))), F.lit(0)),
            F.coalesce(F.sum(F.when(F.col(cap) > F.col(weight) * level, F.col(weight))), F.lit(0))).first()
        if not open_:
            return level
        raised = (total - full) / open_
        if raised <= level:
            return level
        level = raised


def _hash(doc_id, text, seed: str):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"),
                          F.coalesce(F.md5(text), F.lit("null"))))


def group_digits(rows: int) -> int:
    """Hex digits that cut ``rows`` evenly hashed rows into groups of ``GROUP_ROWS`` at most."""
    digits = LEAST_DIGITS
    while rows > GROUP_ROWS << 4 * digits:
        digits += 1
    return digits


def source_plan(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = WEIGHTS, epochs: float = EPOCHS, max_epochs: int = MAX_EPOCHS,
                seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(sized, plan): the documents' (doc_id, source, size, hash), written
    once, and one row per source: source, source_size, target, whole
    (repetitions of every document) and cut (largest hash of the documents
    taken once more; null: none)."""
    spark = docs.sparkSession
    sized = materialise(docs.select(
        F.col(doc_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), _hash(F.col(doc_col), F.col(text_col), seed).alias("h")), "mix-sized")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = surrogate_key(per_source.withColumn("_null", F.col("source").isNull()),
                             ["_null", "source"], "_k", materialised=True)
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = materialise(numbered.select(
        "source", "source_size", F.element_at(cycle, ((F.col("_k") - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap")), "mix-sources")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * epochs
    level = water_level(sources, total)
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = (sources.select("source", "source_size", target.alias("target"))
               .withColumn("whole", F.floor(ratio).cast("long"))
               .withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size")))

    grouped = sized.withColumn("g", F.substring("h", 1, group_digits(sized.count())))
    before = Window.partitionBy("source").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    starts = (grouped.groupBy("source", "g").agg(F.sum("size").alias("n"), F.max("h").alias("last"))
              .select("source", "g", "n", "last", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    s, t = starts.alias("s"), targets.alias("t")
    groups = materialise(s.join(t, F.col("s.source").eqNullSafe(F.col("t.source")))
                         .select("s.source", "g", "n", "last", "start", "missing"), "mix-groups")
    # Groups wholly within the missing words are taken; only the one group in
    # which a source's missing words end has to be ordered.
    groups = groups.filter(F.col("missing") > 0)
    taken = groups.filter(F.col("start") + F.col("n") <= F.col("missing")).select("source", F.col("last").alias("h"))
    e = groups.filter((F.col("start") <= F.col("missing")) & (F.col("start") + F.col("n") > F.col("missing"))).alias("e")
    # rows that share a hash are one document of their joint size
    joint = grouped.alias("d").join(e, F.col("d.source").eqNullSafe(F.col("e.source")) & (F.col("d.g") == F.col("e.g"))) \
        .groupBy("d.source", "d.g", "h", "start", "missing").agg(F.sum("size").alias("size"))
    inner = Window.partitionBy("source", "g").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    split = (joint.withColumn("within", F.coalesce(F.sum("size").over(inner), F.lit(0)))
             .filter(F.col("start") + F.col("within") + F.col("size") / 2 <= F.col("missing")).select("source", "h"))
    c = taken.unionByName(split).groupBy("source").agg(F.max("h").alias("cut")).alias("c")
    plan = materialise(t.join(c, F.col("t.source").eqNullSafe(F.col("c.source")), "left")
                       .select("t.source", "source_size", "target", "whole", "cut"), "mix-plan")
    return sized, plan


def _repeats(h) -> F.Column:
    return F.col("plan.whole") + F.when(h <= F.col("plan.cut"), F.lit(1)).otherwise(F.lit(0))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target (its source's) and
    taken (words the mix takes, repeats counted)."""
    sized, plan = source_plan(docs, **options)
    joined = sized.alias("d").join(plan.alias("plan"), F.col("d.source").eqNullSafe(F.col("plan.source")))
    return joined.select("d.doc_id", "d.size", "plan.source_size", "plan.target",
                         (_repeats(F.col("d.h")) * F.col("d.size")).alias("taken"))


def mix_documents(docs: DataFrame, *, doc_col: str = "doc_id", source_col: str = "source", seed: str = SEED,
                  **options) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, one row per repetition taken
    (documents without words are never taken)."""
    _, plan = source_plan(docs, doc_col=doc_col, source_col=source_col, seed=seed, **options)
    text = F.col("d." + options.get("text_col", "text"))
    repeats = F.when(word_count(text) > 0, _repeats(_hash(F.col(f"d.{doc_col}"), text, seed))).otherwise(F.lit(0))
    joined = docs.alias("d").join(plan.alias("plan"), F.col(f"d.{source_col}").eqNullSafe(F.col("plan.source")))
    copy = unused("_copy", docs)
    return joined.select("d.*", F.explode(F.array_repeat(F.lit(1), repeats.cast("int"))).alias(copy)).drop(copy)


# DuckDB text of mix_report with the parameters above.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null')) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
      FROM d GROUP BY source),
o AS (SELECT *, 2 * source_size AS cap,
             sum(2 * source_size) OVER w - 2 * source_size AS full_before,
             sum(weight) OVER () - sum(weight) OVER w + weight AS open_weight,
             sum(source_size) OVER () * CAST(1.5 AS DOUBLE) AS total
      FROM s WINDOW w AS (ORDER BY 2 * source_size / CAST(weight AS DOUBLE), source NULLS LAST
                          ROWS UNBOUNDED PRECEDING)),
lv AS (SELECT max((total - full_before) / open_weight) AS level FROM o),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * level) AS target FROM o, lv),
p AS (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole FROM t),
j AS (SELECT source, h, sum(size) AS size FROM d GROUP BY source, h),
c AS (SELECT j.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM j),
k AS (SELECT c.source, max(c.h) AS cut FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source
      WHERE p.target > p.whole * p.source_size
        AND c.before + c.size / CAST(2 AS DOUBLE) <= p.target - p.whole * p.source_size GROUP BY c.source)
SELECT d.doc_id, d.size, p.source_size, p.target,
       CAST((p.whole + CASE WHEN d.h <= k.cut THEN 1 ELSE 0 END) * d.size AS BIGINT) AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source
"""
