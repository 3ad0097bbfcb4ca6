"""Token ids in a binary format coded with static range asymmetric numerals.

*Files.* Documents are brought into ascending doc_id order in range blocks,
encoded with the tokenizers library (each followed by an end id) and cut into
packs of whole documents. The ids of all packs are counted; the counts, scaled
to 2^20, are the frequency table that all packs share. A pack is coded by
itself with ``LANES`` interleaved states, and its bytes are

    magic, version, lanes, number of ids, crc32 of the frequency table,
    crc32 of the ids, number of words, number of checkpoints,
    per checkpoint (every ``CHECK_STEPS`` steps): word position, lane states,
    the 32-bit words, crc32 of all bytes before

so packs decode on their own, and the stretches between checkpoints of one pack
decode side by side. The files are a Parquet table in the shared folder, one
row per pack, as Spark's writers are what reaches it from every executor; the
frequency table is stored beside them.

*Reading back.* ``read`` decodes every pack, checks the checksums and gives per
document its ids' place, number and crc32.

Encoding works word by word: the tokenizer never looks across a space or line
break, so the ids of the pieces between them are kept in a table of bounded
size and joined. The texts of a group are cut together: every piece is looked up
once a group, however often it comes.

Cases: null and empty texts have only the end id; repeated rows of one doc_id
follow each other, ordered by a hash of the text; doc_ids are whole numbers
(others end the job in a cast error); null doc_ids come first; very long texts
make one pack of their own size; an empty table gives no pack and an empty
result; other columns are not read.
"""

from __future__ import annotations

import gc
import os
import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .common import materialise, shuffle_width
from .ordered import block_of, bounds

LANES = 2048
CHECK_STEPS = 128
PACK_IDS = 1 << 19
SCALE_BITS = 20
BLOCK_ROWS = 8_192               # documents of a range block, about, where there are many
MEMO = 1_200_000                 # pieces of text kept with their ids, per worker
GROUP_CHARS = 1 << 22            # characters of texts cut together, about
END_ID = 2
_LOW = 1 << 31                 # lane states stay in [2^31, 2^63)
_MAGIC = b"RANS"
_HEAD = struct.Struct("<4sHHQIIII")
_ID = attrgetter("id")
# U+001C to U+001F are blank for this module, but not for the library
_SIGN_STOP = re.compile(r"(?:[^\w\s]|[_\x1c-\x1f])[.,](?:[ \n]|$)")
_STOP_PAIRS = ("..", ".,", ",.", ",,")
_WIDE = re.compile("[^\x00-\u012f\u0131-\u024f]")
_BYTE_CHARS = {b: c for c, b in byte_alphabet().items()}


# ------------------------------------------------------------------- the code

class Frequencies:
    """Counts of all symbols scaled to sum to 2^SCALE_BITS, at least 1 for each
    symbol that occurs."""

    def __init__(self, scaled: np.ndarray):
        self.freq = scaled.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(scaled)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(scaled), dtype=np.uint32), scaled)
        self.crc = zlib.crc32(scaled.astype("<u4").tobytes())

    @staticmethod
    def scale(counts: np.ndarray) -> np.ndarray:
        total, room = counts.sum(), 1 << SCALE_BITS
        if not total:
            return np.zeros(len(counts), np.int64)
        if (counts > 0).sum() > room:
            raise ValueError("more symbols than slots")
        scaled = np.where(counts > 0, np.maximum(1, counts * room // total), 0)
        order = np.argsort(-scaled, kind="stable")
        over = int(scaled.sum()) - room
        if over <= 0:
            scaled[order[0]] -= over
        for i in order:                 # take the excess from the largest
            if over <= 0:
                break
            cut = min(over, int(scaled[i]) // 2)
            scaled[i] -= cut
            over -= cut
        return scaled


def encode_pack(ids: np.ndarray, table: Frequencies) -> bytes:
    n = len(ids)
    lanes = max(1, min(LANES, n))
    steps = -(-n // lanes)
    x = np.full(lanes, _LOW, np.uint64)
    words, marks = [], []
    bits, shift = np.uint64(SCALE_BITS), np.uint64(32)
    limit = np.uint64((_LOW >> SCALE_BITS) << 32)
    for t in range(steps - 1, -1, -1):
        s = ids[t * lanes:(t + 1) * lanes]
        f, y = table.freq[s], x[:len(s)]
        full = y >= limit * f
        spill = y[full]
        words.append(spill.astype("<u4"))              # the low 32 bits
        y[full] = spill >> shift
        quotient = y // f
        x[:len(s)] = (quotient << bits) + (y - quotient * f) + table.start[s]
        if t % CHECK_STEPS == 0:
            marks.append((len(words), x.astype("<u8").tobytes()))
    sizes = np.cumsum([len(w) for w in words])
    total = int(sizes[-1]) if steps else 0
    body = [_HEAD.pack(_MAGIC, 1, lanes, n, table.crc, zlib.crc32(ids.astype("<u4").tobytes()), total, len(marks))]
    for count, state in reversed(marks):    # position of the first word that the stretch reads
        body += [struct.pack("<Q", total - int(sizes[count - 1])), state]
    body += [w.tobytes() for w in reversed(words)]
    data = b"".join(body)
    return data + struct.pack("<I", zlib.crc32(data))


def decode_pack(data: bytes, table: Frequencies) -> np.ndarray:
    if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("the pack's bytes fail their checksum")
    magic, version, lanes, n, table_crc, ids_crc, total, marks = _HEAD.unpack_from(data)
    if (magic, version) != (_MAGIC, 1) or table_crc != table.crc:
        raise ValueError("not a pack of this table")
    at, size = _HEAD.size, 8 + 8 * lanes
    position = np.array([struct.unpack_from("<Q", data, at + i * size)[0] for i in range(marks)], np.int64)
    x = np.stack([np.frombuffer(data, "<u8", lanes, at + i * size + 8) for i in range(marks)]).astype(np.uint64) \
        if marks else np.empty((0, lanes), np.uint64)
    words = np.frombuffer(data, "<u4", total, at + marks * size).astype(np.uint64)
    steps = -(-n // lanes) if lanes else 0
    ids = np.zeros((marks, CHECK_STEPS, lanes), np.uint32)
    low, mask, bits, shift = np.uint64(_LOW), np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
    for t in range(min(CHECK_STEPS, steps)):
        # stretches that still have a step t; the last step may have fewer lanes
        live = int(np.sum(np.arange(marks) * CHECK_STEPS + t < steps))
        y = x[:live]
        slot = y & mask
        s = table.symbol[slot]
        z = table.freq[s] * (y >> bits) + slot - table.start[s]
        if (live - 1) * CHECK_STEPS + t == steps - 1:
            idle = n - (steps - 1) * lanes
            z[live - 1, idle:] = y[live - 1, idle:]
            s[live - 1, idle:] = 0
        need = z < low
        for row in range(live):                        # a stretch reads its words in order
            rows = np.flatnonzero(need[row])
            begin = position[row]
            position[row] += len(rows)
            z[row, rows] = (z[row, rows] << shift) | words[begin:begin + len(rows)]
        x[:live], ids[:live, t] = z, s
    out = ids.reshape(-1)[:n]
    if zlib.crc32(out.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("the decoded ids fail their checksum")
    return out


# ------------------------------------------------------------------ tokenizing

class WordEncoder(dict):
    """Ids of texts by the tokenizers library, piece by piece, as bytes; the
    dictionary holds the ids of the pieces met.

    Texts of letters up to U+024F without a special token are put in lower case
    first, as the tokenizer does, and stops and commas before a space are cut
    off as pieces of their own, as it does after a letter or digit; a text with
    other signs before them goes to the library whole."""

    def __init__(self, spec: str):
        super().__init__({"": b""})
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        # plain letters pass the normalizer and the split unchanged, so their
        # bytes can go to the library's model itself, if that is what it does
        self.model = self.tokenizer.model.tokenize
        probe = ["a", "hello", "überstraße", "éçñ", "zyxwvutsrqponml"]
        self.direct = [self._plain(w) for w in probe] == self._ids(probe) == self._ids([w.upper() for w in probe[:2]] + probe[2:])
        # signs that the split parts from a word they stand around; none of a special token
        special = "'" + "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.around = "".join(c for c in string.punctuation if c not in special)
        if any(self._ids([f"{c}hello{c}"])[0] != self._ids([c])[0] + self._ids(["hello"])[0] + self._ids([c])[0] for c in self.around):
            self.around = ""

    def _ids(self, pieces: list[str]) -> list[bytes]:
        return [array(self.kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _plain(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_CHARS)
        return array(self.kind, map(_ID, self.model(word))).tobytes()

    def _spaced(self, text: str) -> str:
        """The text with a space wherever it is cut."""
        text = text.replace("\n", " ")
        if not self.direct or "<|" in text or not _narrow(text):
            return text
        return (text.lower() + " ").replace(". ", " . ").replace(", ", " , ")

    def __missing__(self, piece: str) -> bytes:
        word = piece.strip(self.around) if self.direct else ""
        if word.isalpha() and word.islower() and (word.isascii() or max(word) < "\u0250"):
            if len(word) == len(piece):
                ids = self._plain(word)
            else:
                at = piece.index(word)
                ids = self[piece[:at]] + self[word] + self[piece[at + len(word):]]
        else:
            ids = self._ids([piece])[0]
        if len(self) >= MEMO:
            self.clear()
            self[""] = b""
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def encode(self, texts: list[str], end: bytes = b"") -> Iterator[bytes]:
        """Little-endian ids of each text, ``end`` appended."""
        group, chars = [], 0
        for text in texts:
            group.append(text)
            chars += len(text)
            if chars >= GROUP_CHARS:
                yield from self._uncollected(group, end)
                group, chars = [], 0
        if group:
            yield from self._uncollected(group, end)

    def _uncollected(self, texts: list[str], end: bytes) -> list[bytes]:
        """A group's many small objects have no cycles: looking for some, past the
        whole table each time, took a fifth of the time."""
        on = gc.isenabled()
        gc.disable()
        try:
            return self._group(texts, end)
        finally:
            if on:
                gc.enable()

    def _group(self, texts: list[str], end: bytes) -> list[bytes]:
        cut = pc.split_pattern(pa.array(map(self._spaced, texts), pa.large_string()), " ")
        coded = cut.values.dictionary_encode()
        pieces, place, cuts = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), cut.offsets.to_numpy()
        found = [self[piece] for piece in pieces]
        # ends in a sign other than a stop or comma that was cut off
        sign = np.array([piece != "" and not piece[-1].isalnum() and piece not in (".", ",") for piece in pieces], np.int64)
        signs = np.concatenate([[0], np.cumsum(sign[place])])[cuts]
        size = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.concatenate([[0], np.cumsum(size[place])])[cuts].tolist()
        kept = pa.array(np.frombuffer(b"".join(found), f"u{array(self.kind).itemsize}"))
        starts = np.concatenate([[0], np.cumsum(size)]) // array(self.kind).itemsize
        ids = pa.LargeListArray.from_arrays(pa.array(starts), kept).take(coded.indices).flatten().to_numpy().tobytes()
        out = []
        for i, (text, signed) in enumerate(zip(texts, (np.diff(signs) > 0).tolist())):
            if (signed or any(x in text for x in _STOP_PAIRS)) and _SIGN_STOP.search(text):
                out.append(self._ids([text])[0] + end)
            else:
                out.append(ids[ends[i]:ends[i + 1]] + end)
        return out


def _narrow(text: str) -> bool:
    """All characters up to U+024F, but for the one whose lower case is two."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return not _WIDE.search(text)


_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(spec: str) -> WordEncoder:
    key = zlib.crc32(spec.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(spec)
    return _ENCODERS[key]


_PACK_COLUMNS = "block int, pack int, start long, doc_ids array<long>, sizes array<long>, ids binary"


def _pack_rows(block, pack, start, docs, parts, width, squeeze) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([pack], pa.int32()), pa.array([start], pa.int64()),
         pa.array([docs], pa.list_(pa.int64())), pa.array([[len(p) // width for p in parts]], pa.list_(pa.int64())),
         pa.array([bytes([width]) + squeeze.compress(b"".join(parts))], pa.binary())],
        names=["block", "pack", "start", "doc_ids", "sizes", "ids"])


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), f"<u{data[0]}")


def tokenize(docs: DataFrame, path: str, *, doc_col: str = "doc_id", text_col: str = "text",
             end_id: int = END_ID) -> DataFrame:
    """Packs of ids in document order: block, pack, start (ids of the block
    before the pack), doc_ids, sizes, ids."""
    spark = docs.sparkSession
    with open(path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    narrow = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = bounds(narrow, "doc_id", max(2 * shuffle_width(spark), -(-narrow.count() // BLOCK_ROWS)))
    placed = narrow.select(block_of(F.col("doc_id"), cuts).alias("block"), "doc_id", F.xxhash64("text").alias("tie"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, z = _encoder(spec.value), zstandard.ZstdCompressor(1)
        end = array(encoder.kind, [end_id]).tobytes()
        width = len(end)
        block, pack, start, ids, parts, held = None, 0, 0, [], [], 0
        for batch in batches:
            b, d, texts = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for this, doc, found in zip(b, d, encoder.encode(texts, end)):
                if parts and (this != block or held >= PACK_IDS):
                    yield _pack_rows(block, pack, start, ids, parts, width, z)
                    pack, start, ids, parts, held = pack + 1, start + held, [], [], 0
                if this != block:
                    block, pack, start = this, 0, 0
                ids.append(doc)
                parts.append(found)
                held += len(found) // width
        if parts:
            yield _pack_rows(block, pack, start, ids, parts, width, z)

    dealt = (placed.repartitionById(len(cuts) + 1, "block")          # a task a block
             .sortWithinPartitions("block", F.col("doc_id").asc_nulls_first(), "tie"))
    return dealt.mapInArrow(run, _PACK_COLUMNS)


def frequencies(packs: DataFrame) -> np.ndarray:
    """Scaled frequencies of all ids of all packs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                found = np.bincount(_unpack(data), minlength=len(counts))
                found[:len(counts)] += counts
                counts = found
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["id", "n"])

    rows = packs.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)    # as long as the vocabulary
    for r in rows:
        counts[r["id"]] = r["n"]
    return Frequencies.scale(counts)


def write(docs: DataFrame, path: str, **options) -> tuple[DataFrame, DataFrame]:
    """(files, table): one row per pack with its ``data``, and the frequency
    table as (id, freq); both written in the shared folder and read again."""
    spark = docs.sparkSession
    packs = materialise(tokenize(docs, path, **options), "rans-ids")
    scaled = frequencies(packs)
    table = materialise(spark.createDataFrame([(i, int(f)) for i, f in enumerate(scaled)], "id long, freq long"), "rans-table")
    shared = spark.sparkContext.broadcast(scaled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = Frequencies(shared.value)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                data = encode_pack(_unpack(row.column(5)[0].as_py()), freq)
                yield pa.RecordBatch.from_arrays([*row.columns[:5], pa.array([data], pa.binary())],
                                                 names=["block", "pack", "start", "doc_ids", "sizes", "data"])

    files = packs.mapInArrow(run, "block int, pack int, start long, doc_ids array<long>, sizes array<long>, data binary")
    return materialise(files, "rans-files"), table


def load_table(table: DataFrame) -> np.ndarray:
    return np.array([r["freq"] for r in table.orderBy("id").collect()], np.int64)   # as long as the vocabulary


def read(files: DataFrame, table: DataFrame) -> DataFrame:
    """Per document: block, doc_id, start (in its block), n_tokens, ids_crc32."""
    shared = files.sparkSession.sparkContext.broadcast(load_table(table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = Frequencies(shared.value)
        for batch in batches:
            for block, start, docs, sizes, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                ids = decode_pack(data, freq).astype("<u4")
                ends = np.cumsum(sizes)
                begins = ends - sizes
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sizes), block, np.int32)), pa.array(docs, pa.int64()), pa.array(begins + start),
                     pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())],
                    names=["block", "doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("block", "start", "doc_ids", "sizes", "data").mapInArrow(
        run, "block int, doc_id long, start long, n_tokens long, ids_crc32 long")


def report(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write the files, read them back, and give per document doc_id, start
    (ids of all documents before it), n_tokens and ids_crc32."""
    files, table = write(docs, path, **options)
    # one row per range block: as many as there are partitions
    sizes = sorted((r["block"], r["n"]) for r in files.select(
        "block", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
        .groupBy("block").agg(F.sum("n").alias("n")).collect())
    offsets, before = [], 0
    for block, n in sizes:
        offsets.append((block, before))
        before += n
    first = docs.sparkSession.createDataFrame(offsets, "block int, before long")
    return (read(files, table).join(F.broadcast(first), "block")
            .select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))
