"""SimHash near-duplicates by anchor-point covering.

*Fingerprints.* Words are lower-cased (A-Z), three consecutive words joined by
a space are a shingle, and a bit of the 64-bit fingerprint is set if it is set
in more than half of the shingles' XXH64 values (seed 42), repeats included.

*Links.* Fingerprints at ``DISTANCE`` = 3 or fewer differing bits link. Of the
two 32-bit halves of such a pair at least one differs in at most one bit
(threshold 1 per half). The anchors of a half are the words of the Hamming
code on 31 of its bits, a perfect covering code of radius 1: every point has
an anchor within 1. A fingerprint is sent to every anchor within radius plus
threshold = 2 of either half (at most 16 each), so the anchor nearest to
one fingerprint of a pair also gets the other. Only full distances decide.

*Compare per anchor.* Anchors with one fingerprint are dropped after a count.
An anchor with more than ``BLOCK`` of them is cut into blocks, and every pair
of blocks is a group of its own, so no task holds more than two blocks however
large an anchor gets, and no pair is left out. A group gives the edges of a
spanning forest of its links (fewer than its members), never all pairs.

*Components.* The edges go through rounds of large-star and small-star steps on
Spark until they stand still; nothing but counts and tables of ``BROADCAST_ROWS``
reaches the driver.

Exact copies meet before all this: one row per distinct fingerprint.

Cases: null, empty or wordless text has fingerprint 0 and is linked like any
other; fewer than three words are one shingle; long texts are hashed in
blocks of shingles; repeated rows get the same result each; a null doc_id is
never the smallest (a component of nulls only has component_id null); an empty
table gives an empty result; other columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.keys import one_per_key
from .common import materialise, unused

SHINGLE = 3
DISTANCE = 3
SEED = 42
BLOCK = 1024
TASK_ROWS = 1 << 18          # narrow rows (two longs) that a task of the components takes, at most about
BROADCAST_ROWS = 1 << 16     # narrow rows of a table that goes through the driver to all tasks, at most (8 MB there)
_ANCHORS = 32                # of a fingerprint, at most
_HASHES_AT_ONCE = 1 << 16


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text (bytes.lower is A-Z only)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    spans = list(zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()))
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(spans), _HASHES_AT_ONCE):
        part = spans[at:at + _HASHES_AT_ONCE]
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in part), np.uint64, len(part))
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(spans)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, *, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc columns but the text) and ``fp``, the fingerprint as a signed long."""
    rest = docs.drop(text_col)
    schema = StructType([*rest.schema.fields, StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            fp = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fp)], names=[*batch.schema.names[1:], "fp"])

    return docs.select(F.col(text_col), *rest.columns).mapInArrow(run, schema)


# --------------------------------------------------------------------- anchors

def _syndrome(x: np.ndarray) -> np.ndarray:
    """Hamming-code syndrome of 31-bit points: the xor of the 1-based
    positions of their set bits; 0 for the words of the code."""
    s = np.zeros(len(x), np.int64)
    for j in range(31):
        s ^= np.where((x >> j) & 1, j + 1, 0)
    return s


def anchors_within_two(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(point index, anchor) for every code word within distance 2 of every
    31-bit point. A point with syndrome s is at distance 1 from the word that
    flips position s, and at distance 2 from those that flip a pair of
    positions whose xor is s; a code word has itself only."""
    s, index = _syndrome(x), np.arange(len(x))
    own, near = index[s == 0], index[s > 0]
    points, words = [own, near], [x[own], x[near] ^ (np.int64(1) << (s[near] - 1))]
    for j in range(1, 32):
        other = s[near] ^ j
        ok = other > j                      # each pair once; other = 0 is the single flip
        i = near[ok]
        points.append(i)
        words.append(x[i] ^ (np.int64(1) << (j - 1)) ^ (np.int64(1) << (other[ok] - 1)))
    return np.concatenate(points), np.concatenate(words)


def _placements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        unsigned = fp.view(np.uint64)
        for half in (0, 1):
            # 31 of the half's 32 bits: leaving one out only brings points closer
            x = ((unsigned >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)).astype(np.int64)
            i, word = anchors_within_two(x)
            yield pa.RecordBatch.from_arrays([pa.array(word | (half << 31)), pa.array(fp[i])], names=["anchor", "fp"])


# ---------------------------------------------------------- compare per anchor

def _forest(x: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct fingerprints."""
    open_, edges = np.ones(len(x), bool), []
    for i in range(len(x)):
        if not open_[i]:
            continue
        open_[i] = False
        todo = [i]
        while todo:
            at = todo.pop()
            rest = np.flatnonzero(open_)
            if not len(rest):
                break
            hit = rest[np.bitwise_count(x[rest] ^ x[at]) <= distance]
            open_[hit] = False
            todo += hit.tolist()
            edges += [(at, h) for h in hit.tolist()]
    return edges


def _link_groups(distance: int):
    """Sorted rows (anchor, b1, b2, fp): the forest edges of each group. Rows
    arrive in group order; a group's tail waits for the next batch."""
    def edges_of(keys: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(fp)]])
        sizes, x = ends - starts, fp.view(np.uint64)
        a, b = [], []
        two = starts[sizes == 2]
        near = np.bitwise_count(x[two] ^ x[two + 1]) <= distance
        a.append(fp[two[near]])
        b.append(fp[two[near] + 1])
        for s, e in zip(starts[sizes > 2].tolist(), ends[sizes > 2].tolist()):
            found = _forest(x[s:e], distance)
            if found:
                pair = np.array(found) + s
                a.append(fp[pair[:, 0]])
                b.append(fp[pair[:, 1]])
        return np.concatenate(a), np.concatenate(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fp = np.empty((0, 3), np.int64), np.empty(0, np.int64)

        def out(k, f):
            a, b = edges_of(k, f)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
            keys = np.concatenate([keys, np.stack(cols[:3], axis=1)])
            fp = np.concatenate([fp, cols[3]])
            last = len(fp) and np.flatnonzero(np.any(keys != keys[-1], axis=1))
            done = int(last[-1]) + 1 if len(fp) and len(last) else 0
            if done:
                yield out(keys[:done], fp[:done])
                keys, fp = keys[done:], fp[done:]
        if len(fp):
            yield out(keys, fp)

    return run


def fingerprint_links(fps: DataFrame, *, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Edges (a < b) that connect every pair of distinct fingerprints (column
    ``fp``) within ``distance`` = 3, as forests of the anchors' groups."""
    if distance > 3:
        raise ValueError("two halves with threshold 1 each cover distances up to 3")
    n = fps.count()
    placed = fps.select("fp").mapInArrow(_placements, "anchor long, fp long")
    busy = materialise(placed.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                       .select("anchor", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
                       .coalesce(_tasks(fps, _ANCHORS * n)), "simhash-anchors")
    # one row for each pair of blocks that the fingerprint's block is part of
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = (placed.join(_sized(busy), "anchor").select("anchor", "fp", own.alias("own"), other.alias("other"))
            .select("anchor", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "fp"))
    grouped = (rows.repartition("anchor", "b1", "b2").sortWithinPartitions("anchor", "b1", "b2", "fp"))
    return materialise(grouped.mapInArrow(_link_groups(distance), "a long, b long").distinct().coalesce(_tasks(fps, n)), "simhash-edges")


# ----------------------------------------------------------------- table sizes

def _sized(right: DataFrame, within: DataFrame | None = None) -> DataFrame:
    """``right`` as the right side of a join: broadcast if it (or ``within``, a table
    of as many rows or more) has few rows, else merged. Left alone, Spark takes the bytes
    of the files below a side for its size: 32 placements of a fingerprint count as one,
    and such a side may go through the driver's memory, the left one too."""
    few = (right if within is None else within).count() <= BROADCAST_ROWS
    return F.broadcast(right) if few else right.hint("merge")


def _tasks(df: DataFrame, rows: int) -> int:
    """Tasks for ``rows`` narrow rows: as many as their number needs, and no fewer
    than the cluster runs at once."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


# ------------------------------------------------------------------ components

def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge, root = the smallest node of its
    component. ``edges`` has a, b. Large-star: every neighbour that is larger
    than a node moves to the smallest of the node and its neighbours;
    small-star: the smaller neighbours of a node move to the smallest of
    them. Both keep components whole; at the fixed point each is a star.

    A round is a dozen small shuffles. Their reading ends are joined to the
    number of tasks that the edges need, which only fall in number: otherwise
    a round costs as many tasks and files as the session has shuffle partitions,
    a dozen times, however few the edges are."""
    tasks = _tasks(edges, edges.count())
    now = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                      .distinct().coalesce(tasks), "stars")
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
                            .filter("m < u").coalesce(tasks), "stars-least")
        # nodes that are their own least (the hubs) leave their edges as they are
        large = (now.join(_sized(least.withColumnRenamed("u", "lo")), "lo", "left")
                 .select("hi", F.coalesce("m", "lo").alias("lo")).distinct())
        large = materialise(large.coalesce(tasks), "stars-large")
        small_least = materialise(large.groupBy("hi").agg(F.min("lo").alias("m"), F.count(F.lit(1)).alias("n"))
                                  .filter("n > 1").select("hi", "m").coalesce(tasks), "stars-small")
        moved = large.join(_sized(small_least), "hi").filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        stay = large.groupBy("hi").agg(F.min("lo").alias("lo")).coalesce(tasks)
        after = materialise(stay.unionByName(moved).distinct().coalesce(tasks), "stars")
        # a star forest: no node is both a child and a parent, one parent per child
        parents = after.select(F.col("lo").alias("hi")).distinct().coalesce(tasks)
        if not after.join(_sized(parents, after), "hi", "left_semi").limit(1).count() and \
                not after.groupBy("hi").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").coalesce(tasks).limit(1).count():
            return after.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                after.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct().coalesce(tasks))
        now = after


def near_duplicates(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, text_key (hash of the text), fp (signed long), root
    (smallest fingerprint of its component) and component_id (smallest doc_id
    reachable, itself included)."""
    narrow = docs.select(F.col(text_col).alias("_text"), F.col(doc_col).alias("doc_id"),
                         F.xxhash64(F.col(text_col)).alias("text_key"))
    marked = materialise(with_fingerprint(narrow, text_col="_text", shingle=shingle), "simhash-docs")
    tasks = _tasks(marked, marked.count())
    fps = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")).coalesce(tasks), "simhash-fps")
    roots = materialise(components(fingerprint_links(fps, distance=distance, block=block)), "simhash-roots")
    rooted = materialise(fps.join(_sized(roots.withColumnRenamed("node", "fp")), "fp", "left")
                         .select("fp", F.coalesce("root", "fp").alias("root"), "least").coalesce(tasks), "simhash-rooted")
    smallest = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")).coalesce(tasks),
                           "simhash-components")
    named = materialise(rooted.join(_sized(smallest), "root").select("fp", "root", "component_id").coalesce(tasks), "simhash-named")
    return marked.join(_sized(named), "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def simhash_report(docs: DataFrame, **options) -> DataFrame:
    return near_duplicates(docs, **options).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component stays: the row whose doc_id is the
    component_id (of a component of rows without doc_id: the one with the smallest
    text key), with the columns of ``docs``. Repeated rows of the document that stays are
    reduced to the one whose other columns are smallest, in their order."""
    found = materialise(near_duplicates(docs, doc_col=doc_col, text_col=text_col, **options), "simhash-found")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("text_key").alias("t"))
    best = (found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("root")).alias("alone"))
            .agg(F.min(order).alias("o")).select(F.col("o.d").alias("_d"), F.col("o.t").alias("_t")))
    best = materialise(best, "simhash-kept").alias("b")
    key = unused("_text_key", docs)
    keyed = docs.select("*", F.xxhash64(F.col(text_col)).alias(key)).alias("d")
    kept = keyed.join(best, F.col(f"d.{doc_col}").eqNullSafe(F.col("b._d")) & (F.col(f"d.{key}") == F.col("b._t")),
                      "left_semi")
    repeated = found.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        kept = one_per_key(kept, [doc_col, key], [c for c in docs.columns if c not in (doc_col, text_col)])
    return kept.select(*docs.columns)
