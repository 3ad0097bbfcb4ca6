"""Byte-level BPE: a bounded-lookahead streaming transducer and its decoder.

*Encoding.* For every prefix of a piece there is exactly one token that ends
its encoding: the one that may stand after the token ending the shorter
prefix. Two tokens may stand side by side if no merge crosses their border,
which their spines (the tokens that touch the border while they are built, in
merge order) decide. The transducer thus keeps, per position, the last token of
the prefix ending there. Whatever follows, the whole encoding has a boundary
within every ``lookahead`` bytes (the longest token of the merge list), so it
extends one of the last ``lookahead`` prefix encodings: the tokens that all of
those share are stable. They are emitted and forgotten; the state holds the
open window, not the text.

Pieces come from the tokenizer's split pattern. Their ids are kept in a table
of bounded size (``MEMO`` pieces), which is emptied when full. Code points that
the library and the regex module hold for different classes (letters of a newer
Unicode version) are split as the library does (``stand_ins``).

*Decoding.* Token bytes are fed in blocks to an incremental byte-to-text state
machine (UTF-8; malformed bytes become U+FFFD), which holds at most three
bytes between blocks.

Special tokens in a text are encoded as themselves, as the tokenizers library
does; nothing is added.

Cases: null and empty texts have no ids and decode to the empty text; repeated
rows are encoded each; long texts stream through the window; an empty table
gives an empty result; other columns of the table are not read by
``encode_report`` and pass through ``encode_documents`` unchanged (new columns
take names that the caller gives).
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

# Fixed value: the split pattern of byte-level BPE.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")
MEMO = 700_000               # pieces kept with their ids, per worker
PAIRS = 700_000              # pairs of tokens kept with their verdict
_FEED = 1 << 12
_NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others follow from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def load_vocabulary(path: str) -> dict:
    """A byte-level tokenizer file as plain lists: small and of fixed size, so
    it can travel with the tasks."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    of, vocab = byte_alphabet(), spec["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {"tokens": {i: bytes(of[c] for c in t) for t, i in vocab.items() if t not in specials},
            "merges": [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], "specials": specials,
            "stand_ins": stand_ins()}


@lru_cache(maxsize=1)
def stand_ins() -> dict[int, str]:
    """The code points that the library and the regex module split differently,
    as their Unicode versions differ, each with a character of the class (letter,
    number, space, other) that it has in the library."""
    from tokenizers.pre_tokenizers import ByteLevel
    library, pieces = ByteLevel(add_prefix_space=False, use_regex=True), regex.compile(PIECES)

    def cuts(codes) -> tuple[list, list]:
        text = "".join(f"a{c}1{c}'s" for c in map(chr, codes))
        return [span for _, span in library.pre_tokenize_str(text)], [m.span() for m in pieces.finditer(text)]

    of_class = {tuple(cuts([ord(c)])[0]): c for c in "\u00e9\u00b2\u2003\u00a7"}
    # planes 4 to 13 are empty, 15 and 16 private; no surrogates
    planes = [*range(0, 0xD800, 64), *range(0xE000, 0x40000, 64), *range(0xE0000, 0xE1000, 64)]
    found, todo = {}, [range(lo, lo + 64) for lo in planes]
    while todo:
        codes = todo.pop()
        theirs, ours = cuts(codes)
        if theirs != ours and len(codes) > 1:
            todo += [range(c, c + 1) for c in codes]
        elif theirs != ours:
            found[codes[0]] = of_class[tuple(theirs)]
    return found


@lru_cache(maxsize=1)
def plane_zero_pieces() -> re.Pattern:
    """``PIECES`` for texts of the basic plane, with its classes spelled out for the
    standard library's engine, which takes half the time. Only an apostrophe
    starts a contraction, so letters may be tried before them."""
    def ranges(one: str) -> str:
        found: list[list[int]] = []
        for c in filter(regex.compile(one).match, map(chr, [*range(0xD800), *range(0xE000, 0x10000)])):
            if found and ord(c) == found[-1][1] + 1:
                found[-1][1] += 1
            else:
                found.append([ord(c), ord(c)])
        return "".join(f"\\u{lo:04x}-\\u{hi:04x}" for lo, hi in found)

    letter, number, space = map(ranges, (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(f" ?[{letter}]+|'(?:s|t|re|ve|m|ll|d)| ?[{number}]+| ?[^{space}{letter}{number}]+"
                      f"|[{space}]+(?![^{space}])|[{space}]+")


class MergeList:
    """Tables of a merge list: merge ranks, spines, lookahead."""

    def __init__(self, vocabulary: dict):
        tokens = vocabulary["tokens"]
        self.bytes_of = dict(tokens)
        self.rank = {}
        right, left = {}, {}          # spine towards the right or left border: (token, rank of its birth)
        for i, t in tokens.items():
            if len(t) == 1:
                right[i] = left[i] = ((i, -1),)
        self.id_of = {t: i for i, t in tokens.items() if len(t) == 1}
        for r, (a, b, new) in enumerate(vocabulary["merges"]):
            self.rank.setdefault((a, b), r)
            if new not in right:      # the first merge that gives a token is the one that makes it
                right[new] = (*right[b], (new, r))
                left[new] = (*left[a], (new, r))
                self.id_of[tokens[new]] = new
        self.right, self.left = right, left
        self.lookahead = max(map(len, self.id_of))
        # a token that its own bytes do not encode to can never be emitted
        self.beside_memo: dict[int, bool] = {}
        for a, b, new in vocabulary["merges"]:
            if self.id_of.get(tokens[new]) == new and not self._own_split(a, b, new):
                self.id_of.pop(tokens[new], None)
        # the longest token that ends with these four bytes; a shorter token has three at most
        self.reach: dict[bytes, int] = {}
        for t in self.id_of:
            if len(t) > 3:
                self.reach[t[-4:]] = max(len(t), self.reach.get(t[-4:], 0))

    def _own_split(self, a: int, b: int, new: int) -> bool:
        return self.id_of.get(self.bytes_of[a]) == a and self.id_of.get(self.bytes_of[b]) == b \
            and self.beside(a, b, self.rank[a, b])

    def beside(self, a: int, b: int, before: int = _NEVER) -> bool:
        """No merge of a rank below ``before`` crosses the border of a and b."""
        u, v, rank = self.right[a], self.left[b], self.rank
        i = j = 0
        while True:
            next_u = u[i + 1][1] if i + 1 < len(u) else _NEVER
            next_v = v[j + 1][1] if j + 1 < len(v) else _NEVER
            cross = rank.get((u[i][0], v[j][0]), _NEVER)
            # of equal ranks the leftmost merge comes first
            if cross < before and cross < next_u and cross <= next_v:
                return False
            if next_u == next_v == _NEVER:
                return True
            if next_u <= next_v:
                i += 1
            else:
                j += 1


class Transducer:
    """Encodes one piece fed in blocks. ``feed`` and ``finish`` return the ids
    that became stable."""

    def __init__(self, merges: MergeList):
        self.m = merges
        self.tail = b""              # bytes of the open window
        self.last = [-1]             # last token at each boundary of the window; -1: start
        self.back = [0]              # its length

    def feed(self, block: bytes) -> list[int]:
        self._extend(block)
        return self._stable() if len(self.tail) > 4 * self.m.lookahead else []

    def finish(self) -> list[int]:
        ids = self._path(len(self.tail), 0)
        self.__init__(self.m)
        return ids

    def _extend(self, block: bytes) -> None:
        m, n = self.m, len(self.tail)
        self.tail += block
        tail, last, back, token_of, reach = self.tail, self.last, self.back, m.id_of.get, m.reach.get
        memo, beside = m.beside_memo, m.beside
        for end in range(n + 1, len(tail) + 1):
            far = end - reach(tail[end - 4:end], 3) if end > 3 else 0
            for start in range(far if far > 0 else 0, end):
                token = token_of(tail[start:end])
                if token is None:
                    continue
                before = last[start]
                if before >= 0:
                    key = before << 20 | token
                    ok = memo.get(key)
                    if ok is None:
                        if len(memo) >= PAIRS:
                            memo.clear()
                        ok = memo[key] = beside(before, token)
                    if not ok:
                        continue
                last.append(token)
                back.append(end - start)
                break
            else:
                raise ValueError("no token ends here: the merge list lacks single bytes")

    def _path(self, end: int, start: int) -> list[int]:
        ids = []
        while end > start:
            ids.append(self.last[end])
            end -= self.back[end]
        return ids[::-1]

    def _stable(self) -> list[int]:
        """Emit what the encodings of the last ``lookahead`` prefixes share."""
        n = len(self.tail)
        ends = set(range(max(0, n - self.m.lookahead + 1), n + 1))
        while len(ends) > 1:         # walk the furthest back until all meet
            far = max(ends)
            ends.discard(far)
            ends.add(far - self.back[far])
        meet = ends.pop()
        ids = self._path(meet, 0)
        self.tail, self.last, self.back = self.tail[meet:], self.last[meet:], self.back[meet:]
        self.back[0] = 0
        return ids


class Codec:
    """Text to ids and back for one vocabulary."""

    def __init__(self, vocabulary: dict):
        self.merges = MergeList(vocabulary)
        self.pieces, self.plain_pieces = regex.compile(PIECES), plane_zero_pieces()
        self.specials = vocabulary["specials"]
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) \
            if self.specials else None
        self.bytes_of = self.merges.bytes_of | {i: t.encode() for t, i in self.specials.items()}
        self.names = {i: str(i) for i in self.bytes_of}      # of the ids, for their digest
        self.memo: dict[str, bytes] = {}
        self.stand_ins = vocabulary["stand_ins"]
        self.odd = frozenset(map(chr, self.stand_ins))
        self.from_odd = re.compile(f"[{min(self.odd)}-\U0010ffff]") if self.odd else None

    def _split(self, text: str) -> list[str]:
        if text.isascii() or not self.odd or not self.from_odd.search(text) or self.odd.isdisjoint(text):
            plain = text.isascii() or not _ASTRAL.search(text)
            return (self.plain_pieces if plain else self.pieces).findall(text)
        return [text[m.start():m.end()] for m in self.pieces.finditer(text.translate(self.stand_ins))]

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece as little-endian 32-bit integers."""
        data = piece.encode()
        whole = self.merges.id_of.get(data)
        if whole is not None:        # the only token that spans all of it: nothing to work out
            return whole.to_bytes(4, "little")
        machine, ids = Transducer(self.merges), []
        for at in range(0, len(data), _FEED):
            ids += machine.feed(data[at:at + _FEED])
        return np.array(ids + machine.finish(), "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        memo, pieces = self.memo, self._split(text)
        for piece in set(pieces).difference(memo):
            if len(piece) <= 64:
                if len(memo) >= MEMO:
                    memo.clear()
                memo[piece] = self._piece(piece)
        try:
            return b"".join(map(memo.__getitem__, pieces))
        except KeyError:             # long pieces, or the table was emptied on the way
            return b"".join([memo[p] if p in memo else self._piece(p) for p in pieces])

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if self.cut is None or not self.cut.search(text):
            return np.frombuffer(self._plain(text), "<u4")
        parts, at = [], 0
        for found in self.cut.finditer(text):
            parts += [self._plain(text[at:found.start()]), np.array([self.specials[found[0]]], "<u4").tobytes()]
            at = found.end()
        return np.frombuffer(b"".join([*parts, self._plain(text[at:])]), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        machine, out = codecs.getincrementaldecoder("utf-8")("replace"), []
        for at in range(0, len(ids), _FEED):
            out.append(machine.decode(b"".join(map(self.bytes_of.__getitem__, ids[at:at + _FEED].tolist()))))
        out.append(machine.decode(b"", True))
        return "".join(out)


_CODECS: dict[str, Codec] = {}


def codec(key: str, vocabulary: dict) -> Codec:
    """One codec per vocabulary and Python worker."""
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(vocabulary)
    return _CODECS[key]


def _shared(spark: SparkSession, path: str):
    vocabulary = load_vocabulary(path)
    key = hashlib.sha256(repr(sorted(vocabulary["tokens"].items())).encode()).hexdigest()
    return key, spark.sparkContext.broadcast(vocabulary)


def ids_digest(ids: np.ndarray, names: dict[int, str]) -> str:
    return hashlib.sha256(",".join(map(names.__getitem__, ids.tolist())).encode()).hexdigest()


def encode_report(docs: DataFrame, path: str, *, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (decimal ids joined by
    commas) and decoded_sha256 (the ids decoded, UTF-8)."""
    key, shared = _shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(key, shared.value)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                ids = c.encode(text or "")
                n.append(len(ids))
                ids_sha.append(ids_digest(ids, c.names))
                text_sha.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                                              pa.array(text_sha, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {narrow.schema[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return narrow.mapInArrow(run, schema)


PART_ROWS = 512              # texts whose ids a task holds at a time


def encode_corpus(docs: DataFrame, path: str, *, doc_col: str = "doc_id", text_col: str = "text",
                  keep: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """The encoded corpus: doc_id, the columns in ``keep``, n_tokens, ids, and
    the digests of ``encode_report``; one row per row of ``docs``."""
    key, shared = _shared(docs.sparkSession, path)
    narrow = docs.select(F.col(text_col).alias("_text"), F.col(doc_col).alias("doc_id"), *keep)
    schema = StructType([*narrow.schema.fields[1:], StructField("n_tokens", LongType()),
                         StructField("ids", ArrayType(IntegerType())), StructField("ids_sha256", StringType()),
                         StructField("decoded_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(key, shared.value)
        for part in (batch.slice(at, PART_ROWS) for batch in batches for at in range(0, batch.num_rows, PART_ROWS)):
            ids = [c.encode(t or "") for t in part.column(0).to_pylist()]
            columns = [pa.array([len(x) for x in ids], pa.int64()),
                       pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                       pa.array([ids_digest(x, c.names) for x in ids], pa.string()),
                       pa.array([hashlib.sha256(c.decode(x).encode()).hexdigest() for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], names=schema.names)

    return narrow.mapInArrow(run, schema)


def encode_documents(docs: DataFrame, path: str, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with a column of ids (array of int) added."""
    if ids_col in docs.columns:
        raise ValueError(f"the table already has a column {ids_col}")
    key, shared = _shared(docs.sparkSession, path)
    schema = StructType([*docs.schema.fields, StructField(ids_col, ArrayType(IntegerType()))])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(key, shared.value)
        for batch in batches:
            ids = [c.encode(t or "").astype(np.int32) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))],
                                             names=[*batch.schema.names, ids_col])

    return docs.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str, *, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the ids' text added."""
    if text_col in encoded.columns:
        raise ValueError(f"the table already has a column {text_col}")
    key, shared = _shared(encoded.sparkSession, path)
    schema = StructType([*encoded.schema.fields]).add(text_col, "string")
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(key, shared.value)
        for batch in batches:
            texts = [c.decode(np.array(x if x is not None else [], "<u4")) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, text_col])

    return encoded.mapInArrow(run, schema)
