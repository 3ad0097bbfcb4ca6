"""Exact top-k by integer inner product with MaxScore.

Components become ``floor(256 * x)``. Candidates are dealt over shards by a
hash of vec_id; the queries are packed into blocks and every block is sent to
every shard (a stated query set against all rows, in blocks). A task holds one
shard and one block at a time.

Inside a shard a dimension is a term with two posting lists: by value
descending for positive query weights, ascending for negative ones. Relative
to the end of the list that a query weight dislikes, the contribution of a
posting is at least 0 and at most ``|q_j| * (max_j - min_j)``, the term's score
bound. For each query

1. heads of the longest-bound terms' posting lists are scored in full and
   give the first threshold (the k-th best score so far);
2. terms are sorted by bound; the ones whose bounds together cannot lift a
   document to the threshold are non-essential;
3. the essential postings are traversed and summed per document;
4. non-essential terms are probed, largest bound first, only for documents
   whose sum plus the remaining bounds reaches the threshold.

Documents whose bound equals the threshold stay (ties go to the smaller
vec_id). Every shard returns its k best per query, and a window merges them.

All sums are exact: floating point is used only while every partial sum is an
integer below 2^53, 64-bit integers while they stay far below 2^63. Beyond
that (*wide* vectors, with a component of ``LIMIT`` or more after scaling, or
very long ones) floating-point scores with their rounding bounds leave the
candidates that may be among the k best, and those are scored in Python
integers. A score that a long cannot hold is an error where it is returned.

Cases: vectors that are null or hold null or non-finite components take no
part, nor do rows without vec_id; vectors of different lengths are compared as if the shorter ended in zeros; repeated rows are one vector; rows
with one vec_id and different vectors are separate queries, and none of them is
a candidate for another; fewer than k candidates give fewer rows; empty tables
and tables without a query give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, shuffle_width

K = 5
EVERY = 50                 # queries: vec_ids divisible by this
SCALE = 256
LIMIT = 1 << 27
SHARD_ROWS = 32_768        # most candidates of a shard, about
LEAST_SHARD = 1_024        # smaller shards are not worth a task
BLOCK_QUERIES = 1_024
_SEEDS, _SEED_TERMS, _PROBE = 16, 4, 8
_FAR = 1 << 60             # sums below it, and their bounds, are safe in 64 bits


class Shard:
    """Candidates of one shard, sorted by vec_id, with their bounds."""

    def __init__(self, ids: np.ndarray, rows: list[np.ndarray]):
        order = np.argsort(ids, kind="stable")
        width = max(map(len, rows), default=0)
        c = np.zeros((len(rows), width), np.int64)
        for at, i in enumerate(order):
            c[at, :len(rows[i])] = rows[i]
        self.ids, self.c = ids[order], c
        self.hi = c.max(0, initial=-LIMIT) if len(c) else np.zeros(width, np.int64)
        self.lo = c.min(0, initial=LIMIT) if len(c) else np.zeros(width, np.int64)
        heads = min(_SEEDS, len(c))
        by_value = np.argsort(c, axis=0, kind="stable") if heads else np.empty((0, width), np.int64)
        self.best_low, self.best_high = by_value[:heads], by_value[len(by_value) - heads:]
        self.exact_float = c.astype(np.float64)
        self.most = int(np.abs(c).max(initial=0))

    def exact_top(self, query_id: int, q: list[int], k: int) -> list[tuple[int, int]]:
        """The k best by Python integers, for sums that may leave 64 bits."""
        return _exact_top(self.ids, self.exact_float, lambda i: self.c[i].tolist(), query_id, q, k)

    def top(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        width = self.c.shape[1]
        q = np.concatenate([q, np.zeros(max(0, width - len(q)), np.int64)])[:width]
        size = np.abs(q)
        reach = int(size.max(initial=0)) * self.most * max(1, width)
        if reach >= _FAR:
            return self.exact_top(query_id, q.tolist(), k)
        small = reach < 1 << 53
        c, w = (self.exact_float, q.astype(np.float64)) if small else (self.c, q)
        own = np.searchsorted(self.ids, query_id), np.searchsorted(self.ids, query_id, "right")
        bound = size * (self.hi - self.lo)
        floor = int((np.where(q > 0, self.lo, self.hi) * q).sum())
        terms = np.argsort(-bound, kind="stable")

        # 1. first threshold from the heads of the strongest posting lists
        seeds = np.unique(np.concatenate([(self.best_high if q[j] > 0 else self.best_low)[:, j]
                                          for j in terms[:_SEED_TERMS]] or [np.empty(0, np.int64)]))
        seeds = seeds[(seeds < own[0]) | (seeds >= own[1])]
        scores = c[seeds] @ w
        threshold = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else None

        # 2. non-essential terms: their bounds cannot reach the threshold
        rest = np.concatenate([np.cumsum(bound[terms][::-1])[::-1], [0]])
        split = len(terms) if threshold is None else int(np.argmax(floor + rest < threshold)) \
            if np.any(floor + rest < threshold) else len(terms)

        # 3. essential postings; what the others give at least is added
        essential, others = terms[:split], terms[split:]
        least = int((np.where(q[others] > 0, self.lo[others], self.hi[others]) * q[others]).sum())
        sums = c[:, essential] @ w[essential]
        alive = np.ones(len(sums), bool)
        alive[own[0]:own[1]] = False
        if threshold is not None:
            alive &= sums + least + rest[split] >= threshold
        docs = np.flatnonzero(alive)
        sums = sums[docs]

        # 4. probe the others while competitive
        for at in range(0, len(others), _PROBE):
            if not len(docs):
                break
            part = others[at:at + _PROBE]
            sums = sums + c[np.ix_(docs, part)] @ w[part]
            after = others[at + _PROBE:]
            least = int((np.where(q[after] > 0, self.lo[after], self.hi[after]) * q[after]).sum())
            keep = sums + least + rest[min(split + at + _PROBE, len(terms))] >= threshold
            docs, sums = docs[keep], sums[keep]
        best = np.lexsort((docs, -sums))[:k]
        return [(int(self.ids[docs[i]]), int(sums[i])) for i in best]


class Wide:
    """Wide candidates of one shard, as ``_scaled`` writes them."""

    def __init__(self, ids: list[int], rows: list[list[float]], scale: int):
        self.ids, self.rows, self.scale = np.array(ids, np.int64), rows, scale
        self.c = np.zeros((len(rows), max((len(r) // 2 for r in rows), default=0)))
        for at, r in enumerate(rows):
            self.c[at, :len(r) // 2] = r[:len(r) // 2]

    def top(self, query_id: int, q: list[int], k: int) -> list[tuple[int, int]]:
        return _exact_top(self.ids, self.c, lambda i: _integers(self.rows[i], self.scale), query_id, q, k)


def _integers(wide: list[float], scale: int) -> list[int]:
    """The scaled components of a wide vector."""
    n = len(wide) // 2
    return [int(y) if np.isfinite(y) else int(x) * scale for y, x in zip(wide[:n], wide[n:])]


def _float(x: int) -> float:
    try:
        return float(x)
    except OverflowError:
        return float("inf") if x > 0 else float("-inf")


def _exact_top(ids: np.ndarray, c: np.ndarray, exact, query_id: int, q: list[int], k: int) -> list[tuple[int, int]]:
    """The k best of candidates whose components ``c`` holds as floats and
    ``exact(i)`` gives as integers. The rounding bound of a float score is
    below ``slack``; what cannot be told (overflow) is scored too."""
    docs = np.flatnonzero(ids != query_id)
    f = np.zeros(c.shape[1])
    f[:len(q)] = [_float(x) for x in q[:len(f)]]
    with np.errstate(all="ignore"):
        scores = c[docs] @ f
        slack = (np.abs(c[docs]) @ np.abs(f)) * ((len(f) + 4) * 2.0 ** -50)
        low, high = scores - slack, scores + slack
    if len(docs) > k:
        low[np.isnan(low)] = -np.inf
        threshold = np.partition(low, len(low) - k)[len(low) - k]
        docs = docs[~(high < threshold)]
    best = sorted((-sum(x * y for x, y in zip(q, exact(i))), int(ids[i])) for i in docs.tolist())[:k]
    return [(i, -s) for s, i in best]


def _long(score: int) -> int | None:
    """A score too small for a long is null, it may yet lose to other shards'
    candidates; one too large is sure to be, or to be below, a returned one."""
    if score >= 1 << 63:
        raise OverflowError("a returned score cannot be a long")
    return score if score >= -(1 << 63) else None


def _scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v, wide): the distinct valid vectors, scaled, as arrays of long.
    Wide ones have null for v; ``wide`` holds their scaled components as doubles
    (integers, or infinite), followed by the components themselves where the
    scaled ones are infinite and 0 elsewhere."""
    def whole(y):
        return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)

    def over(x):
        return F.when(F.abs(x * scale) == float("inf"), x).otherwise(0.0)

    doubles = F.transform(vector_col, lambda x: x.cast("double"))
    taken = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    narrow = F.forall("x", lambda x: F.abs(x * scale) < LIMIT)
    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(taken)
            .select(F.col(id_col).cast("long").alias("vec_id"), doubles.alias("x"))
            .select("vec_id", F.when(narrow, F.transform("x", lambda x: F.floor(x * scale).cast("long"))).alias("v"),
                    F.when(~narrow, F.concat(F.transform("x", lambda x: whole(x * scale)), F.transform("x", over))).alias("wide"))
            .distinct())


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (vec_id, v, wide) into blocks of queries, those of wide ones by
    themselves (kind 2): ids, and the vectors' lengths and components, as bytes."""
    for batch in batches:
        for kind, column, dtype in ((1, 1, "<i8"), (2, 2, "<f8")):
            chosen = batch.filter(batch.column(column).is_valid())
            for at in range(0, chosen.num_rows, BLOCK_QUERIES):
                part = chosen.slice(at, BLOCK_QUERIES)
                rows = [np.array(r, dtype) for r in part.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind], pa.int32()),
                     pa.array([part.column(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()]),
                     pa.array([np.array([len(r) for r in rows], "<i8").tobytes()]),
                     pa.array([np.concatenate(rows).tobytes()])], names=["kind", "ids", "lengths", "values"])


def _search(k: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, rows, wide_ids, wide_rows, shard, wide = None, [], [], [], [], None, None
        for batch in batches:
            for s, kind, vec_id, v, w, q_ids, lengths, values in zip(*(c.to_pylist() for c in batch.columns)):
                if s != number:
                    number, ids, rows, wide_ids, wide_rows, shard, wide = s, [], [], [], [], None, None
                if kind == 0:
                    if v is None:
                        wide_ids.append(vec_id)
                        wide_rows.append(w)
                    else:
                        ids.append(vec_id)
                        rows.append(np.array(v, np.int64))
                    continue
                if shard is None:
                    shard, rows = Shard(np.array(ids, np.int64), rows), []
                    wide, wide_rows = Wide(wide_ids, wide_rows, scale), []
                out = []
                ends = np.cumsum(np.frombuffer(lengths, "<i8"))
                queries = np.split(np.frombuffer(values, "<i8" if kind == 1 else "<f8"), ends[:-1])
                for query_id, q in zip(np.frombuffer(q_ids, "<i8").tolist(), queries):
                    key = _key(q)
                    if kind == 1:
                        found = shard.top(query_id, q, k) if len(shard.ids) else []
                        if len(wide.ids):
                            found = found + wide.top(query_id, q.tolist(), k)
                    else:
                        q = _integers(q.tolist(), scale)
                        found = shard.exact_top(query_id, q, k) + wide.top(query_id, q, k)
                    if len(found) > k:
                        found = sorted(found, key=lambda r: (-r[1], r[0]))[:k]
                    out += [(query_id, key, i, _long(score)) for i, score in found]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                     names=["query_id", "q", "vec_id", "score"])
    return run


def _key(q: np.ndarray) -> int:
    """Tells vectors of one vec_id apart."""
    return xxhash.xxh64_intdigest(q.tobytes()) - (1 << 63)


def search(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
           every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best."""
    spark = vectors.sparkSession
    scaled = materialise(_scaled(vectors, id_col, vector_col, scale), "maxscore-vectors")
    n = scaled.count()
    shards = max(1, -(-n // SHARD_ROWS), min(2 * shuffle_width(spark), n // LEAST_SHARD))
    none = [F.lit(None).cast("binary").alias(c) for c in ("ids", "lengths", "values")]
    rows = scaled.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), F.lit(0).alias("kind"),
                         "vec_id", "v", "wide", *none)
    queries = scaled.filter(F.col("vec_id") % every == 0)
    blocks = queries.mapInArrow(_pack, "kind int, ids binary, lengths binary, values binary")
    sent = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                         "kind", F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("array<long>").alias("v"),
                         F.lit(None).cast("array<double>").alias("wide"), "ids", "lengths", "values")
    dealt = rows.unionByName(sent).repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    found = dealt.mapInArrow(_search(k, scale), "query_id long, q long, vec_id long, score long")
    best = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc_nulls_last(), "vec_id")
    score = F.coalesce("score", F.raise_error(F.lit("a returned score cannot be a long")).cast("long"))
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score")))


# DuckDB text of the query.
ORACLE_SQL = r"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: CAST(p[1] AS HUGEINT) * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
