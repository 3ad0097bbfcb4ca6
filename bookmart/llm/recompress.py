"""Substring dedup by recompression.

A window is ``WINDOW`` = 13 consecutive words of one document. Every word
covered by a window that also starts in a document with a smaller doc_id goes;
windows are judged on the input.

*Recompression.* The words of a document are symbols. A round names the
maximal runs of equal symbols, then the pairs (left, right) of neighbours, a
symbol being left or right by one bit of a seeded hash. A name is a hash of
what it names, so equal runs and pairs get equal names wherever they occur, on
any machine. Whether a symbol stands in the parse depends on its neighbours
only; each symbol carries the stretch of words (its context) that settles it.
A symbol whose context lies inside a window is found in every occurrence of
that window. ``ROUNDS`` rounds give symbols of one to eight words; higher
ones have contexts beyond 13 words.

*Rounds on Spark.* The texts are packed into chunks of about ``CHUNK_BYTES``,
written once, compressed, in the shared folder. Then

1. every window picks, of the symbols settled inside it, the one with the most
   bytes (ties by name); a chunk sends the distinct picks to their name's
   bucket, where those found in two documents or more are shared; every chunk
   gets back the ones of its picks that are shared;
2. windows with a shared pick (or with no settled symbol at all) are
   candidates: a chunk sends their distinct hashes over all 13 words with the
   smallest and largest doc_id that holds each; the bucket finds the smallest
   doc_id of all, and answers where a chunk holds a larger one;
3. the chunk marks the words to remove.

No repeat is missed: both occurrences of a repeated window pick the same
symbol. Only equal hashes of the whole window count, so a shared symbol alone
removes nothing (64-bit word hashes, 64-bit window hashes: two different
windows among 10^9 candidates agree with probability 3 %, among the 10^7 here
with 3 * 10^-6).

A key arrives once per chunk however often the chunk holds it, so a passage in
a third of all documents costs one entry per chunk, in buckets spread by hash.
A task holds one bucket at a time; the number of buckets grows with the text
(``BUCKET_BYTES`` each).

Cases: null and empty texts have no words; documents of fewer than 13 words
lose nothing; null doc_ids order last; repeated rows of one doc_id do not
remove each other (no smaller doc_id), each gets the same result; very long
texts make a chunk of their own size; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, shuffle_width

WINDOW = 13
ROUNDS = 3
CHUNK_BYTES = 4 << 20
CHUNK_DOCS = 1 << 16
BUCKET_BYTES = 16 << 20      # text whose keys one bucket gets, on average
_FAR = 1 << 40
_LAST = (1 << 63) - 1
_U = np.uint64
_RANDOM = np.array([xxhash.xxh64_intdigest(b"recompress", i) | 1 for i in range(64)], _U)


# --------------------------------------------------------------- recompression

def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ _RANDOM[salt]) * _U(0x9E3779B97F4A7C15)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(29))


def symbols(words: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> Iterator[tuple]:
    """Per round (name, context start, context end, bytes) of all symbols.
    ``words``: hashes; ``sizes``: their bytes; ``first``: begins a document.
    A context that a document's border leaves open is far away."""
    sym, new, size = words, first, sizes.astype(np.int64)
    cs = np.arange(len(words), dtype=np.int64)
    ce = cs + 1
    for r in range(ROUNDS):
        # runs of equal symbols; settled once both neighbours are
        start = new.copy()
        start[1:] |= sym[1:] != sym[:-1]
        at = np.flatnonzero(start)
        after = np.append(at[1:], len(sym))
        count = after - at
        open_end = np.append(new, True)[after]
        run_cs = np.where(new[at], -_FAR, cs[at - 1])
        run_ce = np.where(open_end, _FAR, np.append(ce, 0)[after])
        name = sym[at]
        many = count > 1
        name[many] = _mix(name[many] + count[many].astype(_U) * _RANDOM[40 + r], 3 * r)
        size = np.add.reduceat(size, at)
        new = new[at]
        # pairs of a left and a right symbol
        left = (_mix(name, 3 * r + 1) >> _U(63)).astype(bool)
        joined = np.zeros(len(name), bool)             # with the one before
        joined[1:] = left[:-1] & ~left[1:] & ~new[1:]
        at = np.flatnonzero(~joined)
        pair = np.append(joined, False)[at + 1]
        last = at + pair
        # a lone left symbol is settled by the next, a lone right one by the one before
        cs = run_cs[at]
        back = ~pair & ~left[at] & ~new[at]
        cs[back] = run_cs[at[back] - 1]
        ce = run_ce[last]
        ahead = ~pair & left[at] & ~np.append(new, True)[at + 1]
        ce[ahead] = run_ce[at[ahead] + 1]
        sym = name[at]
        sym[pair] = _mix(sym[pair] * _RANDOM[50 + r] + name[last[pair]], 3 * r + 2)
        size = np.add.reduceat(size, at)
        new = new[at]
        yield sym, cs, ce, size


def picks(words: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For the window starting at each word the pick: the settled symbol with
    the most bytes (0: none settled)."""
    best = np.zeros(len(words), _U)
    for name, cs, ce, size in symbols(words, sizes, first):
        rank = (np.minimum(size, 255).astype(_U) << _U(56)) | (name >> _U(8))
        fits = ce - cs <= WINDOW
        cs, ce, rank = cs[fits], ce[fits], rank[fits]
        for shift in range(WINDOW):
            ok = (ce - cs <= WINDOW - shift) & (cs >= shift)
            np.maximum.at(best, cs[ok] - shift, rank[ok])
    return (best << _U(8)) | (best >> _U(56))


def window_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of the 13 words from each word on (len - 12 of them)."""
    n = max(0, len(words) - WINDOW + 1)
    total = np.zeros(n, _U)
    for j in range(WINDOW):
        total += words[j:j + n] * _RANDOM[10 + j]
    return _mix(total, 63)


class Chunk:
    """The documents of a chunk with at least 13 words, as one word sequence."""

    def __init__(self, doc_ids: list, texts: list[bytes]):
        self.doc_ids = np.array([_LAST if d is None else d for d in doc_ids], np.int64)
        self.split = [t.split() for t in texts]
        self.counts = np.array([len(w) for w in self.split], np.int64)
        self.long = np.flatnonzero(self.counts >= WINDOW)
        words = [w for i in self.long.tolist() for w in self.split[i]]
        digest = xxhash.xxh64_intdigest
        self.words = np.fromiter(map(digest, words), _U, len(words))
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(self.counts[self.long])
        self.begins = self.ends - self.counts[self.long]
        n = self.counts[self.long]
        # windows: start word and document
        valid = np.ones(len(words), bool)
        for back in range(1, WINDOW):
            valid[self.ends - back] = False
        self.starts = np.flatnonzero(valid)
        self.doc = np.repeat(np.arange(len(self.long)), n - WINDOW + 1)
        self.ids = self.doc_ids[self.long]

    def window_picks(self) -> np.ndarray:
        first = np.zeros(len(self.words), bool)
        first[self.begins] = True
        return picks(self.words, self.sizes, first)[self.starts] if len(self.words) else np.empty(0, _U)

    def window_hashes(self) -> np.ndarray:
        return window_hashes(self.words)[self.starts] if len(self.starts) else np.empty(0, _U)


# ------------------------------------------------------------------- messages

def _squeeze(x: np.ndarray, z) -> bytes:
    """64-bit numbers, byte plane by byte plane, compressed."""
    return z.compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _widen(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1).astype(_U)


def _sorted_out(keys: np.ndarray, z) -> bytes:
    """Ascending keys as differences."""
    return _squeeze(np.diff(keys, prepend=_U(0)), z)


def _sorted_in(data: bytes) -> np.ndarray:
    return np.cumsum(_widen(data), dtype=_U)


def _by_bucket(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of ascending keys; buckets are ranges of the keys."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], _U)
    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    return [(b, lo, hi) for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if hi > lo]


_MESSAGE = "bucket int, chunk long, keys binary, a binary, b binary"
_ANSWER = "chunk long, keys binary, a binary"


def _message(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["bucket", "chunk", "keys", "a", "b"])


def _answer(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["chunk", "keys", "a"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[list]]]:
    """Rows of sorted batches by their first column."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != key:
                if rows:
                    yield key, rows
                key, rows = row[0], []
            rows.append(row)
    if rows:
        yield key, rows


# --------------------------------------------------------------------- rounds

def pack(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of documents: chunk, doc_ids, texts (compressed), size (bytes of text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(6)

        def out(ids, texts, held):
            sizes = np.array([len(t) for t in texts], "<u8").tobytes()
            data = z.compress(len(texts).to_bytes(8, "little") + sizes + b"".join(texts))
            return pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh64_intdigest(data + repr(ids).encode()) - (1 << 63)]), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([data], pa.binary()), pa.array([held], pa.int64())], names=["chunk", "doc_ids", "texts", "size"])

        ids, texts, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                ids.append(doc)
                texts.append(text or b"")
                held += len(texts[-1])
                if held >= chunk_bytes or len(ids) >= CHUNK_DOCS:
                    yield out(ids, texts, held)
                    ids, texts, held = [], [], 0
        if ids:
            yield out(ids, texts, held)

    narrow = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "chunk long, doc_ids array<long>, texts binary, size long")


def _load(doc_ids: list, data: bytes) -> Chunk:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:8], "little")
    ends = np.cumsum(np.frombuffer(raw, "<u8", n, 8).astype(np.int64)) + 8 + 8 * n
    begins = np.concatenate([[8 + 8 * n], ends[:-1]]) if n else ends
    return Chunk(doc_ids, [raw[a:b] for a, b in zip(begins.tolist(), ends.tolist())])


def _send_picks(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(1)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                chunk = _load(row.column(1)[0].as_py(), row.column(2)[0].as_py())
                key, doc = chunk.window_picks(), chunk.doc
                if not len(key):
                    continue
                change = np.ones(len(key), bool)           # neighbours mostly pick the same
                change[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                key, doc = key[change], doc[change]
                order = np.argsort(key, kind="stable")
                key, doc = key[order], doc[order]
                begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                end = np.append(begin[1:], len(key)) - 1
                many = doc[begin] != doc[end]
                key = key[begin]
                if key[0] == 0:
                    key, many = key[1:], many[1:]
                rows = [(b, row.column(0)[0].as_py(), _sorted_out(key[lo:hi], z), np.packbits(many[lo:hi]).tobytes(), None)
                        for b, lo, hi in _by_bucket(key, buckets)]
                if rows:
                    yield _message(rows)
    return run


def _runs(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the concatenated keys, begin of each run of equal ones, and the
    run's number per sorted entry."""
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    begin = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    number = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(ranked))))
    return order, begin, number


def _share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted messages of picks: each chunk's picks found in several documents."""
    z = zstandard.ZstdCompressor(1)
    for _, rows in _groups(batches):
        keys = [_sorted_in(r[2]) for r in rows]
        many = np.concatenate([np.unpackbits(np.frombuffer(r[3], np.uint8), count=len(k)) for r, k in zip(rows, keys)])
        order, begin, number = _runs(keys)
        several = (np.diff(np.append(begin, len(order))) > 1) | (np.maximum.reduceat(many[order], begin) > 0)
        shared = np.empty(len(order), bool)
        shared[order] = several[number]
        at, out = 0, []
        for r, k in zip(rows, keys):
            own = k[shared[at:at + len(k)]]
            at += len(k)
            if len(own):
                out.append((r[1], _sorted_out(own, z), None))
        if out:
            yield _answer(out)


def _chunk_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list, bytes]]:
    """(chunk, answers, doc_ids, texts): rows come sorted by chunk, answers
    before texts; equal chunks (repeated rows) get the same answers."""
    number, answers = None, []
    for batch in batches:
        for chunk, kind, doc_ids, texts, keys, a in zip(*(c.to_pylist() for c in batch.columns)):
            if chunk != number:
                number, answers = chunk, []
            if kind == 0:
                answers.append((keys, a))
            else:
                yield chunk, answers, doc_ids, texts


def _merged(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    none = F.lit(None)
    texts = chunks.select("chunk", F.lit(1).alias("kind"), "doc_ids", "texts", none.cast("binary").alias("keys"),
                          none.cast("binary").alias("a"))
    told = answers.select("chunk", F.lit(0).alias("kind"), none.cast("array<long>").alias("doc_ids"),
                          none.cast("binary").alias("texts"), "keys", "a")
    return (texts.unionByName(told).repartition(shuffle_width(chunks.sparkSession), "chunk")
            .sortWithinPartitions("chunk", "kind"))


def _is_in(sorted_keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)
    return sorted_keys[at] == x, at


def _send_windows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(1)
        for number, answers, doc_ids, texts in _chunk_groups(batches):
            chunk = _load(doc_ids, texts)
            shared = np.sort(np.concatenate([np.empty(0, _U), *(_sorted_in(k) for k, _ in answers)]))
            key = chunk.window_picks()
            found = _is_in(shared, key)[0] | (key == 0)
            h, ids = chunk.window_hashes()[found], chunk.ids[chunk.doc[found]]
            if not len(h):
                continue
            order = np.argsort(h, kind="stable")
            h, ids = h[order], ids[order]
            begin = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            least, most = np.minimum.reduceat(ids, begin), np.maximum.reduceat(ids, begin)
            h = h[begin]
            yield _message([(b, number, _sorted_out(h[lo:hi], z), _squeeze(least[lo:hi].view(_U), z),
                             _squeeze(most[lo:hi].view(_U) - least[lo:hi].view(_U), z)) for b, lo, hi in _by_bucket(h, buckets)])
    return run


def _smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted messages of windows: each chunk's windows that start in a document
    with a smaller doc_id than its largest, with the smallest of all."""
    z = zstandard.ZstdCompressor(1)
    for _, rows in _groups(batches):
        keys = [_sorted_in(r[2]) for r in rows]
        least = np.concatenate([_widen(r[3]) for r in rows])
        most = (least + np.concatenate([_widen(r[4]) for r in rows])).view(np.int64)
        least = least.view(np.int64)
        order, begin, number = _runs(keys)
        smallest = np.empty(len(order), np.int64)
        smallest[order] = np.minimum.reduceat(least[order], begin)[number]
        told = smallest < most
        at, out = 0, []
        for r, k in zip(rows, keys):
            part = slice(at, at + len(k))
            own = told[part]
            at += len(k)
            if own.any():
                out.append((r[1], _sorted_out(k[own], z), _squeeze(smallest[part][own].view(_U), z)))
        if out:
            yield _answer(out)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, answers, doc_ids, texts in _chunk_groups(batches):
        chunk = _load(doc_ids, texts)
        gone = np.zeros(len(chunk.words), bool)
        if answers:
            keys = np.concatenate([_sorted_in(k) for k, _ in answers])
            smallest = np.concatenate([_widen(a) for _, a in answers]).view(np.int64)
            order = np.argsort(keys)
            keys, smallest = keys[order], smallest[order]
            hit, at = _is_in(keys, chunk.window_hashes())
            hit &= smallest[at] < chunk.ids[chunk.doc]
            edge = np.zeros(len(chunk.words) + 1, np.int64)
            np.add.at(edge, chunk.starts[hit], 1)
            np.add.at(edge, chunk.starts[hit] + WINDOW, -1)
            gone = np.cumsum(edge)[:-1] > 0
        place = {i: (a, b) for i, a, b in zip(chunk.long.tolist(), chunk.begins.tolist(), chunk.ends.tolist())}
        kept, removed = [], []
        for i, words in enumerate(chunk.split):
            a, b = place.get(i, (0, 0))
            out = gone[a:b]
            edges = np.flatnonzero(np.diff(out, prepend=False, append=False)).tolist() if out.any() else []
            removed.append([{"start": x, "end": y} for x, y in zip(edges[::2], edges[1::2])])
            kept.append(b" ".join([words[j] for j in np.flatnonzero(~out).tolist()] if edges else words))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(chunk.counts), pa.array(kept, pa.binary()), pa.array(removed, _SPANS)],
            names=["doc_id", "n_words", "kept", "removed"])


def dedup(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text",
          chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The documents without their repeats: doc_id, n_words (of the input), kept
    (the kept words joined by one space) and removed (spans of the input's
    words, counted from 0, ends exclusive). The buckets are as many as the text
    needs, so the keys that a task holds at a time do not grow with the corpus."""
    width = shuffle_width(docs.sparkSession)
    chunks = materialise(pack(docs, doc_col=doc_col, text_col=text_col, chunk_bytes=chunk_bytes), "recompress-chunks")
    size = chunks.agg(F.sum("size")).first()[0] or 0
    buckets = max(4 * width, -(-size // bucket_bytes))
    chunks = chunks.drop("size")

    def answers(messages: DataFrame, settle) -> DataFrame:
        dealt = messages.repartition(width, "bucket").sortWithinPartitions("bucket", "chunk")
        return dealt.mapInArrow(settle, _ANSWER)

    shared = answers(chunks.mapInArrow(_send_picks(buckets), _MESSAGE), _share)
    windows = _merged(chunks, shared).mapInArrow(_send_windows(buckets), _MESSAGE)
    removed = _merged(chunks, answers(windows, _smallest))
    found = removed.mapInArrow(_remove, "doc_id long, n_words long, kept binary, removed array<struct<start:long,end:long>>")
    return found.withColumn("kept", F.col("kept").cast("string"))


def dedup_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_words, n_removed and the sha256 of the kept words
    joined by one space, from the documents that ``dedup`` gives."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return dedup(docs, **options).select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


# DuckDB text of the query.
ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
x AS (SELECT doc_id, unnest(range(1, greatest(len(words) - 11, 1))) AS pos, words FROM w),
k AS (SELECT doc_id, pos, sha256(array_to_string(words[pos:pos + 12], chr(32))) AS h FROM x),
m AS (SELECT h, min(doc_id) AS first FROM k GROUP BY h),
g AS (SELECT DISTINCT k.doc_id, unnest(range(k.pos, k.pos + 13)) AS spot FROM k JOIN m USING (h) WHERE m.first < k.doc_id),
l AS (SELECT doc_id, list(spot) AS gone FROM g GROUP BY doc_id),
r AS (SELECT w.doc_id, words, len(words) AS n,
             [words[i] FOR i IN range(1, len(words) + 1) IF NOT list_contains(coalesce(gone, []), i)] AS kept
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(kept) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(kept, chr(32)), '')) AS kept_sha256 FROM r
"""
