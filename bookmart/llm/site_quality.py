"""Quality classifier by hierarchical empirical Bayes.

1. *Document evidence.* Surface features of the whole text go through a
   logistic regression. It is fitted on the driver (Newton steps on a small
   matrix) on at most ``SAMPLE_ROWS`` labelled rows, the ones with the smallest
   hash of doc_id: the bound keeps the fit independent of the corpus size.
2. *Host and path posteriors.* Grouped aggregation over **all** documents sums
   the evidence probabilities per path (host and section) and host. A Beta
   prior over hosts is estimated from the hosts themselves by the method of
   moments; a host's posterior mean shrinks towards the global mean by its
   strength. The strength of a host as the prior of its paths is estimated in
   the same way, from the spread of the paths around their hosts. Sparse sites
   therefore stay near the global prior, large sites follow their own record.
3. *Decision.* The document's log-odds are shifted by the log-odds of its path
   against the global mean; it is kept at ``KEEP_AT`` or more.

Cases: null or blank text has the features of an empty text (all zero);
null host or path is a group of its own; repeated rows count as often as they
occur; labels that are null, or whose document is missing, are not used; with
no usable labels, or labels of one class only, the evidence is 0.5 for every
document and all are kept; very long texts are read whole; an empty table gives
an empty result; other columns pass through unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import materialise, unused

SAMPLE_ROWS = 20_000
KEEP_AT = 0.5
MAX_STRENGTH = 1000.0     # of a prior, in documents
_CLIP = 1e-4

FEATURES = ("log_words", "word_length", "upper", "digits", "symbols", "trailing_symbols", "bars", "stops",
            "distinct_words", "adjacent_repeats", "distinct_lines", "short_words")
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_STOPS = b".,;:?!"
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in _STOPS)


def features(text: bytes | None) -> list[float]:
    """Shares and counts of one text's surface, in the order of FEATURES."""
    words = (text or b"").split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(text)
    lines = [x for x in text.split(b"\n") if x.strip()]

    def share(characters: bytes) -> float:
        return (size - len(text.translate(None, characters))) / size

    ends = bytes(w[-1] for w in words)
    return [math.log1p(n), min(sum(map(len, words)) / n, 50.0) / 10, share(_UPPER), share(_DIGITS), share(_SYMBOLS),
            (n - len(ends.translate(None, _SYMBOLS + b"!"))) / n, text.count(b"|") / n, share(_STOPS),
            len(set(words)) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
            len(set(lines)) / max(1, len(lines)), sum(len(w) <= 3 for w in words) / n]


def _with_features(docs: DataFrame, text_col: str) -> DataFrame:
    """The other columns of ``docs`` and ``_x``, the text's features."""
    rest = docs.drop(text_col)
    schema = StructType([*rest.schema.fields, StructField("_x", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            x = pa.array([features(t) for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], x], names=[*batch.schema.names[1:], "_x"])

    return docs.select(F.col(text_col), *rest.columns).mapInArrow(run, schema)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray | None:
    """Weights on the raw features, intercept last; None without both classes."""
    if len(y) == 0 or y.min() == y.max():
        return None
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w, penalty = np.zeros(z.shape[1]), np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def train(docs: DataFrame, labels: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> np.ndarray | None:
    """Fit the document evidence on a bounded sample of the labelled rows."""
    chosen = (labels.filter(F.col(label_col).isNotNull() & F.col(doc_col).isNotNull())
              .groupBy(F.col(doc_col).alias("_doc")).agg(F.max(label_col).alias("_y"))
              .orderBy(F.xxhash64("_doc"), "_doc").limit(sample_rows))
    # at most sample_rows small rows: a proven bound, so the texts stay in place
    texts = docs.select(F.col(doc_col).alias("_doc"), F.col(text_col).alias("_text"))
    rows = texts.join(F.broadcast(chosen), "_doc")
    sample = _with_features(rows, "_text").groupBy("_doc").agg(F.min("_x").alias("x"), F.max("_y").alias("y")).collect()
    if not sample:
        return None
    sample.sort(key=lambda r: r["_doc"])
    return fit_logistic(np.array([r["x"] for r in sample]), np.array([float(r["y"]) for r in sample]))


def _logit(p):
    return F.log(p / (1 - p))


def _clip(p):
    return F.least(F.greatest(p, F.lit(_CLIP)), F.lit(1 - _CLIP))


def _strength(within: float, spread: float, excess: int, weight: float) -> float:
    """Strength of a Beta prior over groups, in documents, by the method of
    moments. ``spread``: sum over the groups of size times squared distance from
    what they shrink to; ``excess``: groups less the means taken; ``weight``: the
    factor of the variance between groups in the expectation of ``spread``."""
    between = max((spread - excess * within) / weight, 0.0) if weight > 0 else 0.0
    return min(within / between, MAX_STRENGTH) if between > 0 else MAX_STRENGTH


def site_posteriors(evidence: DataFrame) -> DataFrame:
    """One row per (_host, _path): p_host and p_path, the posterior means, and
    p_global. ``evidence`` has _host, _path, p_doc."""
    paths = (evidence.groupBy("_host", "_path")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("p_doc").alias("s"), F.sum(F.col("p_doc") ** 2).alias("q")))
    paths = materialise(paths, "quality-paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    total = paths.agg(F.sum("n"), F.sum("s"), F.sum("q")).first()
    if not total[0]:
        return paths.select("_host", "_path", F.lit(0.5).alias("p_host"), F.lit(0.5).alias("p_path"),
                            F.lit(0.5).alias("p_global"))
    mean = total[1] / total[0]
    within = max(total[2] / total[0] - mean * mean, 1e-9)       # variance of one document's evidence
    h = hosts.agg(F.sum(F.col("hn") * (F.col("hs") / F.col("hn") - mean) ** 2), F.count(F.lit(1)),
                  F.sum(F.col("hn") * F.col("hn"))).first()
    of_hosts = _strength(within, h[0], h[1] - 1, total[0] - h[2] / total[0])
    placed = paths.alias("p").join(hosts.alias("h"), F.col("p._host").eqNullSafe(F.col("h._host")))
    p = placed.agg(F.sum(F.col("n") * (F.col("s") / F.col("n") - F.col("hs") / F.col("hn")) ** 2), F.count(F.lit(1)),
                   F.sum(F.col("n") * F.col("n") / F.col("hn")), F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n"))).first()
    inside = max(p[3] / (total[0] - p[1]), 1e-9) if total[0] > p[1] else within
    of_paths = _strength(inside, p[0], p[1] - h[1], total[0] - p[2])
    p_host = (F.col("hs") + of_hosts * mean) / (F.col("hn") + of_hosts)
    return materialise(placed.select(
        "p._host", "p._path", p_host.alias("p_host"),
        ((F.col("s") + of_paths * p_host) / (F.col("n") + of_paths)).alias("p_path"),
        F.lit(mean).alias("p_global")), "quality-sites")


def _evidence(weights: np.ndarray | None):
    if weights is None:
        return F.lit(0.5)
    z = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        z = z + F.lit(float(w)) * F.col("_x")[i]
    return _clip(1 / (1 + F.exp(-z)))


def score(docs: DataFrame, labels: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", path_col: str = "lang", label_col: str = "quality",
          sample_rows: int = SAMPLE_ROWS, keep_at: float = KEEP_AT) -> DataFrame:
    """Per document: doc_id, a key of its text, p_doc, p_host, p_path, p_final, keep."""
    weights = train(docs, labels, doc_col=doc_col, text_col=text_col, label_col=label_col, sample_rows=sample_rows)
    narrow = docs.select(F.col(text_col).alias("_text"), F.col(doc_col).alias("doc_id"),
                         F.xxhash64(F.col(text_col)).alias("text_key"),
                         F.col(host_col).cast("string").alias("_host"), F.col(path_col).cast("string").alias("_path"))
    evidence = materialise(_with_features(narrow, "_text").withColumn("p_doc", _evidence(weights)).drop("_x"),
                           "quality-evidence")
    sites = site_posteriors(evidence)
    e, s = evidence.alias("e"), sites.alias("s")
    final = 1 / (1 + F.exp(-(_logit(F.col("p_doc")) + _logit(_clip(F.col("p_path"))) - _logit(_clip(F.col("p_global"))))))
    return (e.join(s, F.col("e._host").eqNullSafe(F.col("s._host")) & F.col("e._path").eqNullSafe(F.col("s._path")))
            .select("e.doc_id", "e.text_key", F.col("e._host").alias("host"), F.col("e._path").alias("path"),
                    "e.p_doc", "s.p_host", "s.p_path", final.alias("p_final"),
                    F.when(final >= keep_at, F.lit(1)).otherwise(F.lit(0)).alias("keep")))


def keep_good(docs: DataFrame, labels: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text",
              **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. The rejected
    (doc_id, text key) pairs are anti-joined, so a kept row is never lost."""
    rejected = materialise(score(docs, labels, doc_col=doc_col, text_col=text_col, **options)
                           .filter("keep = 0").select("doc_id", "text_key").distinct(), "quality-rejected").alias("r")
    key = unused("_text_key", docs)
    keyed = docs.select("*", F.xxhash64(F.col(text_col)).alias(key)).alias("d")
    kept = keyed.join(rejected, F.col(f"d.{doc_col}").eqNullSafe(F.col("r.doc_id"))
                      & (F.col(f"d.{key}") == F.col("r.text_key")), "left_anti")
    return kept.select(*docs.columns)
