"""Document fingerprints by I-Match with randomised lexicon subsets.

*Lexicon.* Document frequencies of all lower-cased words are counted over all
documents. The lexicon keeps the words whose inverse document frequency lies
in a band, i.e. that occur in a share of the documents between ``LEAST`` and
``MOST``. At most (mean distinct words per document) / ``LEAST`` words can
have a share of ``LEAST`` or more, so the lexicon has a size that does not grow
with the corpus. The tasks get its words' 64-bit hashes, eight bytes each (2.4 MB
where a document has 300 distinct words on average).

*Fingerprint.* The distinct lexicon words of a text are sorted. Randomised
subsets of the lexicon come in densities 1, 1/2, 1/4, ... (a word belongs to
subset k of density 2^-d if its k-th seeded hash falls in the lowest 2^-d of
the range); a text uses the density at which a subset holds about one of its
words and the next sparser one, ``SUBSETS`` subsets each. Per subset, the hash
of the sorted words that belong to it is one signature (words in no subset
leave it empty). The fingerprint is the densities with their signatures.

*Likeness* of two fingerprints: on the densities both have, the share of equal
signatures among the subsets in which one of them is not empty; it estimates
the overlap of the two sets of lexicon words. Without a common density it is 0
(the texts' lexicon words differ in number by a factor of two or more).

Texts with fewer than ``FEW`` lexicon words take all their distinct words
instead, marked as such; the two kinds are never alike.

Cases: null counts as empty; texts without any word have a fingerprint of
their own, alike (1.0) to each other and to nothing else; equal texts have
equal fingerprints; repeated rows of one doc_id follow each other ordered by
text; null doc_ids come first, in one block; doc_ids are whole numbers (others
end the job in a cast error); the only document is its own next; very long
texts are taken whole; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BREAK, materialise, shuffle_width
from .ordered import block_of, bounds, constants

LEAST, MOST = 0.001, 0.1      # band of document shares: idf between ln 10 and ln 1000
SUBSETS = 24
FEW = 4
BLOCK_ROWS = 8_192            # documents of a range block, about, where there are many
_DENSITIES = 40
_SPARK_SEED = 42              # of Spark's xxhash64


def lexicon(docs: DataFrame, *, text_col: str = "text", least: float = LEAST, most: float = MOST) -> np.ndarray:
    """The hashes of the words of the band, sorted. Distinct words per document
    are counted with map-side combination; only the band reaches the driver."""
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower(text_col), WORD_BREAK))).alias("w")).filter("w <> ''")
    counts = words.groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    n = docs.count()
    band = counts.filter((F.col("df") >= max(2, least * n)) & (F.col("df") <= max(2, most * n)))
    # written first, so that the shuffle of the words is gone before that of the texts
    held = materialise(band.select(F.xxhash64("w").alias("h")), "imatch-lexicon")
    return np.unique(held.toArrow().column(0).to_numpy().view(np.uint64))


class Fingerprinter:
    def __init__(self, hashes: np.ndarray, subsets: int = SUBSETS):
        self.lexicon = hashes
        self.multipliers = np.array([xxhash.xxh64_intdigest(b"subset", k) | 1 for k in range(subsets)], np.uint64)
        self.subsets = subsets

    def of(self, text: str) -> str:
        distinct = sorted(set(text.lower().encode().split()))
        if not distinct:
            return "none"
        x = np.array([xxhash.xxh64_intdigest(w, _SPARK_SEED) for w in distinct], np.uint64)
        at = np.searchsorted(self.lexicon, x)
        known = at < len(self.lexicon)
        known[known] = self.lexicon[at[known]] == x[known]
        kind = "l"
        if known.sum() >= FEW:
            x = x[known]
        else:
            kind = "a"
        depth = max(0, min(_DENSITIES, round(np.log2(len(x)))))
        return kind + ";".join(f"{d}:" + ",".join(self._signatures(x, d)) for d in (depth, depth + 1))

    def _signatures(self, x: np.ndarray, depth: int) -> list[str]:
        mixed = x[None, :] * self.multipliers[:, None]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        member = (mixed >> np.uint64(64 - depth)) == 0 if depth else np.ones(mixed.shape, bool)
        return [f"{xxhash.xxh32_intdigest(x[m].tobytes()):08x}" if m.any() else "" for m in member]


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if a == "none" or b == "none" or a[0] != b[0]:
        return 0.0
    one, two = ({k: v.split(",") for k, v in (p.split(":") for p in f[1:].split(";"))} for f in (a, b))
    same = used = 0
    for depth in one.keys() & two.keys():
        for x, y in zip(one[depth], two[depth]):
            used += bool(x or y)
            same += bool(x and x == y)
    return same / used if used else 0.0


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by as many leading code points of
    the following text (or all of them)."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def in_order(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and ``guard`` in range blocks (``block``), each block
    sorted. The first row of every block also closes the block before it as a
    guard, and the first of all closes the last."""
    narrow = docs.select(F.col(doc_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    wanted = max(2 * shuffle_width(docs.sparkSession), -(-narrow.count() // BLOCK_ROWS))
    cuts = bounds(narrow, "doc_id", wanted)
    placed = narrow.withColumn("block", block_of(F.col("doc_id"), cuts))
    # the smallest (doc_id, text) of each block: as many rows as there are blocks
    order = F.struct(F.col("doc_id").isNotNull().alias("k"), F.col("doc_id").alias("d"))
    starts = {r["block"]: r["d"] for r in placed.select("block", "doc_id").groupBy("block")
              .agg(F.min(order).getField("d").alias("d")).collect()}
    blocks = sorted(starts)
    if not blocks:
        return placed.select("block", F.lit(False).alias("guard"), "doc_id", "text")
    # by block number; blocks without documents are never looked up
    prior = dict(zip(blocks, [blocks[-1], *blocks[:-1]]))
    before = constants([prior.get(b, -1) for b in range(blocks[-1] + 1)])
    first = constants([-1 if starts.get(b) is None else starts[b] for b in range(blocks[-1] + 1)])
    is_first = F.when(F.col("doc_id").isNull(), F.col("block") == blocks[0]).otherwise(
        F.col("doc_id") == F.get(first, F.col("block")))
    if starts[blocks[0]] is None:
        is_first = F.when(F.col("block") == blocks[0], F.col("doc_id").isNull()).otherwise(is_first)
    own = F.struct(F.col("block").alias("block"), F.lit(False).alias("guard"))
    guard = F.struct(F.get(before, F.col("block")).cast("int").alias("block"), F.lit(True).alias("guard"))
    rows = placed.select(F.explode(F.when(is_first, F.array(own, guard)).otherwise(F.array(own))).alias("r"), "doc_id", "text")
    return (rows.select("r.block", "r.guard", "doc_id", "text").repartitionById(blocks[-1] + 1, "block")      # a task a block
            .sortWithinPartitions("block", "guard", F.col("doc_id").asc_nulls_first(), "text"))


_OUT = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def fingerprint_report(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text",
                       least: float = LEAST, most: float = MOST) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and the likeness
    of the first to the second and to the next document's."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(docs, text_col=text_col, least=least, most=most))
    rows = in_order(docs, doc_col=doc_col, text_col=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer = Fingerprinter(shared.value)
        held = None                                   # (block, doc_id, text, fingerprint) awaiting its next

        def result(item, text, fp):
            _, doc, own, own_fp = item
            changed = edited(own, text)
            changed_fp = printer.of(changed)
            return (doc, len(own), hashlib.sha256(changed.encode()).hexdigest(), own_fp, changed_fp,
                    likeness(own_fp, changed_fp), likeness(own_fp, fp))

        for batch in batches:
            out = []
            for block, guard, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None and guard:            # a further row of the guarding document
                    continue
                fp = printer.of(text)
                if held is not None:
                    out.append(result(held, text, fp))
                held = None if guard else (block, doc, text, fp)
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], batch.schema.field(2).type), pa.array(columns[1], pa.int64()),
                     *(pa.array(c, pa.string()) for c in columns[2:5]), *(pa.array(c, pa.float64()) for c in columns[5:])],
                    names=list(_OUT))

    kind = docs.schema[doc_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")
