"""Ranked lexical search over posting lists in geometric blocks.

Terms are the maximal runs of letters, digits and characters beyond ASCII, A-Z
in lower case. A document's *impact* for a term is the integer
``w * (10^9 tf div (1000 tf + 8 m))``, and its score for an item is the sum of
its impacts for the item's terms, once each.

1. One pass over the texts gives, per document, its length and the numbers and
   counts of the query terms in it (the forward index, written once); its
   counts give N, L and the document frequencies.
2. Tasks read the forward index and take documents in shards of bounded size.
   In a shard every term has a posting list. The list is cut into *blocks* by
   similarity: evenly spaced postings are representatives, and each
   posting goes to the one whose impact vector (as a short signed sketch) is
   nearest. A block stores the coordinatewise maximum of its documents' impacts.
3. An item's terms are taken from the rarest on. A document met for the first
   time in a list has none of the earlier terms, so its score is at most the
   sum of its block's maxima over the terms from here on. A block is skipped
   only when that sum, in the same integers, is below the k-th best score so
   far; blocks that reach it are scored exactly, best bound first. When the
   maxima of the remaining lists together cannot reach it, the item is done.
4. Every task returns its k best per item, and a window merges them.

Summaries of a list are made when an item first comes to it and kept for the
items after it. Sketches steer what is skipped, never what is returned.

Items are taken in groups of at most ``VOCABULARY`` (item, term) pairs, so what
is sent to the tasks has a bound; there is one pass over the texts per group.

Cases: null, empty and termless texts are no documents (they count in nothing);
an item is an item_id (null: one more), with the terms of all its rows, and an
item without terms has no result; repeated rows are separate documents;
documents without doc_id take part and come after all others of equal score;
very long texts are read whole; with an empty table on either side the result
is empty; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

K = 10
VOCABULARY = 1_000_000        # (item, term) pairs sent to the tasks at a time
SHARD_DOCS = 16_384
SHARD_POSTINGS = 2_000_000
BLOCK = 64                    # postings of a block, on average
SKETCH = 32
_CHUNK = 256                  # documents scored before the threshold is looked at again

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BYTES = bytes(c | 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return text.translate(_BYTES).split()


def item_terms(items: DataFrame, *, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term): the distinct terms of every item."""
    lower = F.translate(F.col(text_col), _UPPER, _LOWER)
    return (items.select(F.col(item_col).cast("long").alias("item_id"),
                         F.explode(F.regexp_extract_all(lower, F.lit(_TERM), F.lit(0))).alias("term")).distinct())


def _groups(pairs: DataFrame, limit: int) -> list[DataFrame]:
    """The items dealt into groups of at most ``limit`` pairs; an item beyond
    it is a group by itself in the end."""
    total = pairs.count()
    if total <= limit:
        return [pairs]
    parts = -(-total // limit)
    while True:
        group = F.pmod(F.xxhash64("item_id"), F.lit(parts))
        # one row per group: as many as the driver then runs passes
        sizes = (pairs.groupBy(group.alias("g"), "item_id").agg(F.count(F.lit(1)).alias("n"))
                 .groupBy("g").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("items")).collect())
        if all(r["n"] <= limit or r["items"] == 1 for r in sizes):
            return [pairs.filter(group == r["g"]) for r in sizes]
        parts *= 2


def forward_index(docs: DataFrame, vocabulary: list[str], *, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (terms with repeats), terms (numbers in the vocabulary),
    counts; one row per document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = {w.encode(): i for i, w in enumerate(shared.value)}.get
        for batch in batches:
            lengths, ends, found, counts, keep = [], [0], [], [], []
            for at, text in enumerate(batch.column(1).cast(pa.binary())):
                words = terms(text.as_py())
                if not words:
                    continue
                seen = Counter(map(find, words))
                seen.pop(None, None)
                keep.append(at)
                lengths.append(len(words))
                found.extend(seen.keys())
                counts.extend(seen.values())
                ends.append(len(found))
            if keep:
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(keep)), pa.array(lengths, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))],
                    names=["doc_id", "n", "terms", "counts"])

    narrow = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("text <> ''")
    return narrow.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


def statistics(index: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and the document frequency of every vocabulary term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(held[seen])], names=["term", "df"])

    df = np.zeros(size, np.int64)
    for r in index.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    total = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return total[0], total[1], df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Best:
    """The k best (score, doc_id) of an item so far; no doc_id comes last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.none, self.doc = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    @property
    def threshold(self) -> int:
        """What a document has to reach (ties go by doc_id)."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, none: np.ndarray, doc: np.ndarray) -> None:
        chosen = score >= self.threshold
        if chosen.any():
            score, none, doc = (np.concatenate(p) for p in ((self.score, score[chosen]), (self.none, none[chosen]),
                                                            (self.doc, doc[chosen])))
            first = np.lexsort((doc, none, -score))[:self.k]
            self.score, self.none, self.doc = score[first], none[first], doc[first]


class Shard:
    """Documents of one shard: impacts by document (terms ranked from the
    rarest on) and by term, and the blocks of the lists met so far."""

    def __init__(self, none: np.ndarray, doc: np.ndarray, ends: np.ndarray, rank: np.ndarray, impact: np.ndarray, ranks: int):
        self.none, self.doc = none, doc
        owner = np.repeat(np.arange(len(doc)), np.diff(ends))
        order = np.lexsort((rank, owner))
        self.start, self.rank, self.impact = ends[:-1], rank[order], impact[order]
        self.end = ends[1:]
        by_term = np.lexsort((owner, self.rank))            # owner is sorted already, so it fits the ordered ranks
        self.list_at = np.searchsorted(self.rank[by_term], np.arange(ranks + 1))
        self.entry, self.owner = by_term, owner
        self.most = np.zeros(ranks, np.int64)
        np.maximum.at(self.most, self.rank, self.impact)
        mixed = (self.rank.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        sign = np.where(mixed >> np.uint64(63), -1.0, 1.0)
        slot = (mixed >> np.uint64(40)).astype(np.int64) % SKETCH
        flat = np.bincount(owner * SKETCH + slot, weights=sign * self.impact, minlength=len(doc) * SKETCH)
        self.sketch = flat.reshape(len(doc), SKETCH).astype(np.float32)
        self.sketch /= np.linalg.norm(self.sketch, axis=1, keepdims=True) + 1e-9
        self.blocks: dict[int, tuple] = {}

    def block(self, t: int) -> tuple:
        """Of a term's list: documents by block, block ends, the terms of the
        summaries, and the summaries (blocks x terms)."""
        if t not in self.blocks:
            entries = self.entry[self.list_at[t]:self.list_at[t + 1]]
            docs = self.owner[entries]
            parts = -(-len(docs) // BLOCK)
            if parts > 1:
                chosen = docs[np.arange(parts) * len(docs) // parts]
                nearest = (self.sketch[docs] @ self.sketch[chosen].T).argmax(1)
                order = np.argsort(nearest, kind="stable")
                docs, entries, nearest = docs[order], entries[order], nearest[order]
                parts, nearest = len(np.unique(nearest)), np.unique(nearest, return_inverse=True)[1]
            else:
                nearest = np.zeros(len(docs), np.int64)
            sizes = self.end[docs] - entries                # the document's impacts from this term on
            at = _spans(entries, sizes)
            kinds, column = np.unique(self.rank[at], return_inverse=True)
            summary = np.zeros((parts, len(kinds)), np.int64)
            np.maximum.at(summary, (np.repeat(nearest, sizes), column), self.impact[at])
            self.blocks[t] = docs, np.searchsorted(nearest, np.arange(parts + 1)), kinds, summary
        return self.blocks[t]

    def score(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        sizes = self.end[docs] - self.start[docs]
        at = _spans(self.start[docs], sizes)
        return np.add.reduceat(self.impact[at] * wanted[self.rank[at]], np.concatenate([[0], np.cumsum(sizes)[:-1]]))

    def search(self, query: np.ndarray, best: Best, wanted: np.ndarray) -> None:
        """``query``: ranks, ascending; ``wanted``: 1 at these, else 0."""
        rest = np.cumsum(self.most[query][::-1])[::-1]
        seen = np.zeros(len(self.doc), bool)
        for i, t in enumerate(query):
            if rest[i] < best.threshold:
                return
            if self.list_at[t] == self.list_at[t + 1]:
                continue
            docs, ends, kinds, summary = self.block(int(t))
            column = np.searchsorted(kinds, query[i:])
            column = column[(column < len(kinds)) & (kinds[np.minimum(column, len(kinds) - 1)] == query[i:])]
            bound = summary[:, column].sum(1)
            queue = np.argsort(-bound, kind="stable")
            at = 0
            while at < len(queue) and bound[queue[at]] >= best.threshold:
                took, parts = 0, []
                while at < len(queue) and took < _CHUNK and bound[queue[at]] >= best.threshold:
                    b = queue[at]
                    parts.append(docs[ends[b]:ends[b + 1]])
                    took += len(parts[-1])
                    at += 1
                new = np.concatenate(parts)
                new = new[~seen[new]]
                if len(new):
                    seen[new] = True
                    best.add(self.score(new, wanted), self.none[new], self.doc[new])


def _spans(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every span, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - sizes), sizes)


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs, n_terms, weight, rank_of, queries = shared.value
        best = [Best(k) for _ in queries]
        wanted = np.zeros(len(rank_of), np.int64)
        held, docs, postings = [], 0, 0

        def flush():
            none, doc, n, sizes, term, tf = (np.concatenate(c) for c in zip(*held))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            m = 10 + (90 * n * n_docs) // n_terms
            impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes)))
            shard = Shard(none, doc, ends, rank_of[term], impact, len(rank_of))
            for query, found in zip(queries, best):
                wanted[query] = 1
                shard.search(query, found, wanted)
                wanted[query] = 0

        for batch in batches:
            filled = batch.filter(pa.compute.greater(pa.compute.list_value_length(batch.column(2)), 0))
            step = 2048
            for first in range(0, filled.num_rows, step):
                part = filled.slice(first, step)
                doc = part.column(0)
                held.append((doc.is_null().to_numpy(zero_copy_only=False), doc.fill_null(0).to_numpy(zero_copy_only=False),
                             part.column(1).to_numpy(zero_copy_only=False),
                             part.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64),
                             part.column(2).flatten().to_numpy(zero_copy_only=False),
                             part.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)))
                docs, postings = docs + part.num_rows, postings + len(held[-1][4])
                if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    flush()
                    held, docs, postings = [], 0, 0
        if held:
            flush()
        sizes = [len(b.score) for b in best]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(best), dtype=np.int32), sizes)),
                 pa.array(np.concatenate([b.doc for b in best]), mask=np.concatenate([b.none for b in best])),
                 pa.array(np.concatenate([b.score for b in best]))], names=["item", "doc_id", "score"])
    return run


def _one_group(docs: DataFrame, pairs: DataFrame, k: int, columns: dict) -> DataFrame:
    spark = docs.sparkSession
    # at most VOCABULARY pairs, counted in _groups
    listed = sorted(((r["item_id"], r["term"]) for r in pairs.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vocabulary = sorted({t for _, t in listed})
    number = {t: i for i, t in enumerate(vocabulary)}
    index = materialise(forward_index(docs, vocabulary, **columns), "blocked-index")
    n_docs, n_terms, df = statistics(index, len(vocabulary))
    rank_of = np.empty(len(vocabulary), np.int64)
    rank_of[np.argsort(df, kind="stable")] = np.arange(len(vocabulary))
    by_item: dict = {}
    for item, term in listed:
        by_item.setdefault(item, []).append(rank_of[number[term]])
    items = list(by_item)
    queries = [np.sort(np.array(q, np.int64)) for q in by_item.values()]
    shared = spark.sparkContext.broadcast((n_docs, n_terms, weights(n_docs, df), rank_of, queries))
    found = index.mapInArrow(_search(shared, k), "item int, doc_id long, score long")
    names = spark.createDataFrame(list(enumerate(items)), "item int, item_id long")    # as long as the group
    return found.join(F.broadcast(names), "item").select("item_id", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = K, vocabulary: int = VOCABULARY) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of each item's k best documents."""
    pairs = materialise(item_terms(items, item_col=item_col, text_col=item_text_col), "blocked-items")
    columns = {"doc_col": doc_col, "text_col": text_col}
    found = reduce(DataFrame.unionByName, [_one_group(docs, g, k, columns) for g in _groups(pairs, vocabulary)])
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


# DuckDB text of the query.
ORACLE_SQL = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS row_id, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents WHERE text IS NOT NULL),
words AS (
  SELECT row_id, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM lowered),
lengths AS (SELECT row_id, doc_id, count(*) AS n FROM words GROUP BY row_id, doc_id),
total AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM lengths),
item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL),
tf AS (SELECT row_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM item_terms) GROUP BY row_id, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * max(big_n) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, total GROUP BY term),
impact AS (
  SELECT tf.row_id, lengths.doc_id, tf.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))) AS impact
  FROM tf JOIN lengths USING (row_id) JOIN weight USING (term), total),
scored AS (
  SELECT item_id, row_id, doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM item_terms JOIN impact USING (term) GROUP BY item_id, row_id, doc_id HAVING sum(impact) > 0),
ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scored)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
