"""Quality rules: fixed limits on counts, then a calibrated classifier of
hashed word and character n-grams.

*Counts.* Words, their code points, symbols, repeated lines and words in
repeated 3-word windows are counted exactly over the whole text. Texts below
``LEAST_WORDS`` words or with more than ``MOST_REPEATED`` percent of their words
in repeated windows fail.

*Classifier.* A text has four families of features: its words, pairs of
adjacent words, and runs of 3 and of 5 bytes. Each is hashed into
``2^BITS`` columns; a family's features are its shares, scaled. The logistic
regression is trained by AdaGrad steps on the labelled rows with the smallest
hashes of doc_id, at most ``SAMPLE_ROWS`` of them and at most ``SAMPLE_COLUMNS``
hashed columns together (the bounds keep the fit, and what it needs of the
driver, independent of the corpus), each collected as its hashed columns, not
as text.

*Calibration.* The rows are dealt into ``FOLDS``; each fold is scored by a model
of the other folds, and a logistic curve through these held-out scores (Platt)
turns the score of the final model into the probability of good quality.

*Verdict.* Texts are scored in Arrow batches; a text stays if it passes the
limits and its probability is ``KEEP_AT`` or more.

Cases: a null text counts as one without words; equal texts have equal results,
so do repeated rows; null labels and labels without a document are not used,
several labels of one doc_id count as the largest, several texts of one doc_id
give one training row; rows without doc_id are scored like others; with no
labels, labels of one class only, or held-out scores that do not rise with the
label, the probability is the same for every text and the limits alone decide;
very long texts are hashed in slices; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

LEAST_WORDS = 50
MOST_REPEATED = 50            # percent of the words
KEEP_AT = 0.5
SAMPLE_ROWS = 4_000
SAMPLE_COLUMNS = 6_000_000    # of eight bytes each
FOLDS = 4
BITS = 18
EPOCHS = 6
_SCALE = 20.0                 # of a family's shares
_RATE, _SURE = 0.5, 0.01      # a row predicted this well gives no step
_SLICE = 1 << 20              # bytes hashed at a time
_SYMBOLS = b"#*$%&|<>"
_BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
_FAMILIES = ("word", "pair", "run 3", "run 5")
_SALT = [np.uint64(xxhash.xxh64_intdigest(f) | 1) for f in _FAMILIES]


# --------------------------------------------------------------------- counts

def _repeated(ids: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(ids) < 4:
        return 0
    pairs = np.unique(ids[:-1].astype(np.int64) * (int(ids.max()) + 1) + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1] * (int(ids.max()) + 1) + ids[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    twice = times[which] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k:len(ids) - 2 + k] |= twice
    return int(covered.sum())


class Text:
    """A text's words as numbers (in order of first occurrence) and its counts."""

    def __init__(self, text: bytes | None):
        self.text = text or b""
        words = self.text.split()
        number: dict[bytes, int] = defaultdict(count().__next__)
        self.ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        self.distinct = list(number)

    def counts(self) -> tuple[int, int, int, int, int]:
        text = self.text
        lines = [x for x in text.split(b"\n") if x.strip()]
        points = len(text.decode("utf-8", "replace")) if not text.isascii() else len(text)
        blank = len(text) - len(text.translate(None, _BLANK))
        return (len(self.ids), points - blank, len(text) - len(text.translate(None, _SYMBOLS)),
                len(lines) - len(set(lines)), _repeated(self.ids))

    def columns(self) -> Iterator[tuple[int, np.ndarray]]:
        """(family, hashed columns with repeats), in slices."""
        if len(self.ids):
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.distinct), np.uint64, len(self.distinct))[self.ids]
            yield 0, _column(hashes, 0)
            yield 1, _column(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:], 1)
        for first in range(0, len(self.text), _SLICE):
            piece = np.frombuffer(self.text, np.uint8, min(_SLICE + 4, len(self.text) - first), first).astype(np.uint64)
            for family, size in ((2, 3), (3, 5)):
                starts = min(_SLICE, len(piece) - size + 1)
                if starts > 0:
                    code = piece[:starts].copy()
                    for k in range(1, size):
                        code |= piece[k:starts + k] << np.uint64(8 * k)
                    yield family, _column(code, family)


def _column(code: np.ndarray, family: int) -> np.ndarray:
    mixed = (code ^ (code >> np.uint64(31))) * _SALT[family]
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.int64)


# ------------------------------------------------------------------ the model

@dataclass(frozen=True)
class Model:
    """Weights of the hashed columns, intercept, and the calibration curve."""
    weights: np.ndarray
    intercept: float
    slope: float
    offset: float

    def score(self, text: Text) -> float:
        sums, sizes = [0.0] * len(_FAMILIES), [0] * len(_FAMILIES)
        for family, columns in text.columns():
            sums[family] += float(self.weights[columns].sum())
            sizes[family] += len(columns)
        return self.intercept + _SCALE * sum(s / n for s, n in zip(sums, sizes) if n)

    def probability(self, text: Text) -> float:
        z = self.offset + (self.slope * self.score(text) if self.slope else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def sparse(text: Text) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed columns of a text and the values there."""
    held, sizes = [[] for _ in _FAMILIES], [0] * len(_FAMILIES)
    for family, columns in text.columns():
        held[family].append(np.unique(columns, return_counts=True))
        sizes[family] += len(columns)
    parts = [(c, _SCALE * n / sizes[f]) for f, pieces in enumerate(held) for c, n in pieces]
    if not parts:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    columns, where = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return columns.astype(np.int32), np.bincount(where, np.concatenate([v for _, v in parts])).astype(np.float32)


def _logistic(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> tuple[np.ndarray, float]:
    """AdaGrad over the rows in their order, ``EPOCHS`` times."""
    w, h = np.zeros(1 << BITS, np.float64), np.full(1 << BITS, 1e-2)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    b, hb = float(np.log(share / (1 - share))), 1e-2
    for _ in range(EPOCHS):
        for (columns, values), target in zip(rows, y):
            z = b + float(w[columns] @ values)
            error = 1 / (1 + math.exp(-min(max(z, -30), 30))) - target
            if abs(error) < _SURE:
                continue
            step = error * values
            squares = h[columns] + step * step
            h[columns] = squares
            w[columns] -= _RATE * step / np.sqrt(squares)
            hb += error * error
            b -= _RATE * error / math.sqrt(hb)
    return w, b


def platt(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through (score, label); targets
    are drawn in by one row of each class."""
    good, bad = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    middle, spread = scores.mean(), scores.std() + 1e-9
    x = np.stack([(scores - middle) / spread, np.ones(len(scores))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target) + 1e-6 * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / spread), float(w[1] - w[0] * middle / spread)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, folds: int = FOLDS) -> Model:
    """``rows``: columns and values; the folds are every ``folds``-th row."""
    share = (float(y.sum()) + 1) / (len(y) + 1) if len(y) else 1.0      # constant: the limits alone decide
    constant = Model(np.zeros(1 << BITS), 0.0, 0.0, float(np.log(max(share, 0.5) / max(1 - max(share, 0.5), 1e-3))))
    if not len(y) or y.min() == y.max():
        return constant
    scores, held = np.zeros(len(y)), np.arange(len(y)) % folds
    for k in range(folds):
        inner = np.flatnonzero(held != k)
        w, b = _logistic([rows[i] for i in inner], y[inner])
        for i in np.flatnonzero(held == k):
            scores[i] = b + float(w[rows[i][0]] @ rows[i][1])
    slope, offset = platt(scores, y)
    if slope <= 0:
        return constant
    w, b = _logistic(rows, y)
    return Model(w, b, slope, offset)


def train(docs: DataFrame, labels: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, sample_columns: int = SAMPLE_COLUMNS) -> Model:
    """Fit on the labelled rows with the smallest hashes, ``sample_rows`` and
    ``sample_columns`` at most (but one row of each class, where there is one)."""
    chosen = (labels.filter(F.col(label_col).isNotNull() & F.col(doc_col).isNotNull())
              .groupBy(F.col(doc_col).alias("doc")).agg(F.max(label_col).alias("y"))
              .join(docs.select(F.col(doc_col).alias("doc")).distinct(), "doc", "left_semi")
              .orderBy(F.xxhash64("doc"), "doc").limit(sample_rows))
    # at most sample_rows (id, label) rows: a proven bound, so the texts stay in place
    texts = docs.select(F.col(doc_col).alias("doc"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc").select("doc", "y", F.xxhash64("text").alias("tie"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [sparse(Text(t.as_py())) for t in part.column(3).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([c.astype("<i4").tobytes() for c, _ in found], pa.binary()),
                     pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())],
                    names=["doc", "y", "tie", "columns", "values"])

    kinds = dict(rows.dtypes)
    hashed = rows.mapInArrow(run, f"doc {kinds['doc']}, y {kinds['y']}, tie long, columns binary, values binary")
    once = materialise(hashed.groupBy("doc").agg(
        F.min_by(F.struct("columns", "values"), F.struct("tie", "columns")).alias("x"), F.first("y").alias("y"),
        F.xxhash64("doc").alias("k")), "rules-sample")
    # at most sample_rows rows of a few bytes
    sizes = sorted((r["k"], r["doc"], r["n"], r["y"] > 0) for r in once.select(
        "k", "doc", (F.octet_length("x.columns") / 4).cast("long").alias("n"), "y").collect())
    total, held, chosen = 0, set(), []
    for k, doc, n, good in sizes:
        if total + n <= sample_columns or good not in held:
            total, chosen = total + n, [*chosen, doc]
            held.add(good)
    sample = once.filter(F.col("doc").isin(chosen)).select("k", "doc", "y", "x.columns", "x.values").collect()
    sample.sort(key=lambda r: (r["k"], r["doc"]))
    y = np.array([float(r["y"] > 0) for r in sample])
    return fit([(np.frombuffer(r["columns"], "<i4"), np.frombuffer(r["values"], "<f4")) for r in sample], y)


def judge(docs: DataFrame, labels: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", keep_at: float = KEEP_AT,
          least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED, **training) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, probability and kept."""
    model = train(docs, labels, doc_col=doc_col, text_col=text_col, **training)
    shared = docs.sparkSession.sparkContext.broadcast(model)              # 2^BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            counts, probability = [], []
            for t in batch.column(1).cast(pa.binary()):
                text = Text(t.as_py())
                counts.append(text.counts())
                probability.append(held.probability(text))
            words, chars, symbols, lines, repeated = (pa.array(c, pa.int64()) for c in zip(*counts)) if counts else \
                (pa.array([], pa.int64()) for _ in range(5))
            n, r, p = words.to_numpy(), repeated.to_numpy(), np.array(probability)
            failed = (n < least_words) | (100 * r > most_repeated * n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), words, chars, symbols, lines, repeated, pa.array(failed), pa.array(p, pa.float64()),
                 pa.array(~failed & (p >= keep_at))],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       "probability", "kept"])

    kind = docs.schema[doc_col].dataType.simpleString()
    return docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, probability double, kept boolean")
