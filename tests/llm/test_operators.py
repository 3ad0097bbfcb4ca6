"""The operators against brute force on small tables, and the hard cases."""

import hashlib
import math
import random
import re
import zlib
from array import array
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F

from bookmart.llm import (bpe, imatch, line_spread, maxscore, mixing, ordered, pii_votes, rans, recompress,
                          simhash_cover, site_quality)

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ----------------------------------------------------------------- 1 I-Match

def test_imatch_equal_edited_and_next(small):
    rows = sorted((r["doc_id"], r["text"]) for r in small.collect())
    got = {r["doc_id"]: r for r in imatch.fingerprint_report(small).collect()}
    assert len(got) == len(rows)
    by_text = defaultdict(set)
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        k = len(text) // 4
        r = got[doc]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == sha(text[:len(text) - k] + following[:k])
        assert r["near_next"] == imatch.likeness(r["fingerprint"], got[rows[(i + 1) % len(rows)][0]]["fingerprint"])
        by_text[text].add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    mean = lambda c: sum(r[c] for r in got.values()) / len(got)
    assert mean("near_edited") > 0.3 and mean("near_next") < 0.1


def brute_fingerprint(text, lexicon):
    """By the definition, in whole numbers; ``lexicon``: words."""
    distinct = sorted(set(text.lower().encode().split()))
    if not distinct:
        return "none"
    hashed = [(xxhash.xxh64_intdigest(w, 42), w.decode() in lexicon) for w in distinct]
    known = [h for h, k in hashed if k]
    kind, h = ("l", known) if len(known) >= 4 else ("a", [x for x, _ in hashed])
    depth, full = max(0, min(40, round(math.log2(len(h))))), (1 << 64) - 1

    def signature(k, d):
        out = b""
        for v in h:
            x = v * (xxhash.xxh64_intdigest(b"subset", k) | 1) & full
            x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 & full
            if x >> (64 - d) == 0:
                out += v.to_bytes(8, "little")
        return f"{xxhash.xxh32_intdigest(out):08x}" if out else ""

    return kind + ";".join(f"{d}:" + ",".join(signature(k, d) for k in range(24)) for d in (depth, depth + 1))


def brute_likeness(a, b):
    if a == b or "none" in (a, b) or a[0] != b[0]:
        return float(a == b)
    one, two = (dict(p.split(":") for p in f[1:].split(";")) for f in (a, b))
    pairs = [(x, y) for d in one.keys() & two.keys() for x, y in zip(one[d].split(","), two[d].split(",")) if x or y]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0


def test_imatch_brute_force(small, hard):
    for table in (small, hard.filter("doc_id is not null").dropDuplicates(["doc_id"])):
        rows = sorted((r["doc_id"], r["text"] or "") for r in table.collect())
        df = Counter(w for _, t in rows for w in set(t.lower().encode().split()))
        lexicon = {w.decode() for w, n in df.items() if max(2, 0.001 * len(rows)) <= n <= max(2, 0.1 * len(rows))}
        got = {r["doc_id"]: r for r in imatch.fingerprint_report(table).collect()}
        fp = [brute_fingerprint(t, lexicon) for _, t in rows]
        for i, (doc, text) in enumerate(rows):
            after = (i + 1) % len(rows)
            k = len(text) // 4
            changed = brute_fingerprint(text[:len(text) - k] + rows[after][1][:k], lexicon)
            r = got[doc]
            assert (r["fingerprint"], r["edited_fingerprint"]) == (fp[i], changed)
            assert r["near_edited"] == brute_likeness(fp[i], changed) and r["near_next"] == brute_likeness(fp[i], fp[after])


def test_imatch_hard_cases(hard, empty):
    rows = imatch.fingerprint_report(hard).collect()
    assert len(rows) == hard.count()
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert {r["fingerprint"] for r in rows if r["n_chars"] == 0} == {"none"}
    assert imatch.fingerprint_report(empty).count() == 0


# ------------------------------------------------------------- 2 line spread

def brute_lines(rows, min_sites):
    sites, first = defaultdict(set), {}
    for doc, text, site in rows:
        for i, line in enumerate(text.split("\n") if text is not None else []):
            if line.strip(" \t\r"):
                sites[line] |= {site} - {None}
                place = (doc is None, doc, i)
                first[line] = min(first.get(line, place), place, key=lambda p: (p[0], p[1] or 0, p[2]))
    out = []
    for doc, text, _ in rows:
        if text is None:
            out.append((doc, 0, 0, sha("")))
            continue
        lines = text.split("\n")
        gone = [bool(x.strip(" \t\r")) and len(sites[x]) >= min_sites and first[x] != (doc is None, doc, i)
                for i, x in enumerate(lines)]
        out.append((doc, len(lines), sum(gone), sha("\n".join(x for x, g in zip(lines, gone) if not g))))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_line_spread_brute_force(spark, hard, empty):
    rnd = random.Random(4)
    lines = [f"line {i}" for i in range(40)] + ["", "  ", "footer"]
    rows = [(i, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 8))), f"s{rnd.randint(0, 7)}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert order(tuple(r) for r in line_spread.line_report(df, min_sites=4).collect()) == order(brute_lines(rows, 4))
    many = hard.select("doc_id", "text", "source").collect()
    assert order(tuple(r) for r in line_spread.line_report(hard, min_sites=2).collect()) == order(brute_lines(many, 2))
    assert line_spread.dedup_lines(hard, min_sites=2).columns == hard.columns
    assert line_spread.line_report(empty).count() == 0


def test_line_spread_many_lines_of_one_document(spark):
    lines = [f"menu {i}" for i in range(30_000)]
    docs = spark.createDataFrame([(i, "\n".join(lines), f"s{i}") for i in range(5)] + [(9, "menu 7\nown\n\nmenu 8", "s0")],
                                 "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["text"] for r in line_spread.dedup_lines(docs).collect()}
    assert kept == {0: "\n".join(lines), 1: "", 2: "", 3: "", 4: "", 9: "own\n"}


# --------------------------------------------------------------------- 3 BPE

def test_bpe_equals_library(small, hard, empty):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTE)
    for table in (small, hard):
        texts = [(r["doc_id"], r["text"] or "") for r in table.collect()]
        want = order((d, len(e.ids), sha(",".join(map(str, e.ids))), sha(t.decode(e.ids, skip_special_tokens=False)))
                     for d, e in zip((d for d, _ in texts), t.encode_batch([x for _, x in texts], add_special_tokens=False)))
        assert order(tuple(r) for r in bpe.encode_report(table, BYTE).collect()) == want
    assert bpe.encode_report(empty, BYTE).count() == 0


def test_bpe_splits_code_points_of_any_unicode_version_as_the_library():
    from tokenizers import Tokenizer
    t, codec = Tokenizer.from_file(BYTE), bpe.Codec(bpe.load_vocabulary(BYTE))
    rng = random.Random(5)
    odd = sorted(codec.odd) or ["\u00e9"]
    for c in [rng.choice(odd) for _ in range(300)] + [chr(rng.randrange(0xE000, 0x110000)) for _ in range(3000)]:
        text = f"a{c}b {c}'s 1{c}2{c}'re\n{c} \u00e9"
        ids = codec.encode(text)
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids
        assert codec.decode(ids) == text


def test_bpe_streams_long_pieces_in_a_window():
    from tokenizers import Tokenizer
    t, codec = Tokenizer.from_file(BYTE), bpe.Codec(bpe.load_vocabulary(BYTE))
    rnd = random.Random(1)
    for piece in ["a" * 50_000, "".join(rnd.choice("abcde") for _ in range(20_000)), "é" * 3_000, " " * 9_000]:
        machine, ids, most = bpe.Transducer(codec.merges), [], 0
        data = piece.encode()
        for at in range(0, len(data), 500):
            ids += machine.feed(data[at:at + 500])
            most = max(most, len(machine.tail))
        ids += machine.finish()
        assert ids == t.encode(piece, add_special_tokens=False).ids
        assert most < 500 + 8 * codec.merges.lookahead or len(set(piece)) == 1


def test_bpe_documents_round_trip(hard):
    encoded = bpe.encode_documents(hard, BYTE, ids_col="token_ids")
    back = bpe.decode_documents(encoded, BYTE, ids_col="token_ids", text_col="again").collect()
    assert all(r["again"] == (r["text"] or "") for r in back)
    with pytest.raises(ValueError):
        bpe.encode_documents(hard, BYTE)


# ----------------------------------------------------------------- 4 SimHash

def brute_simhash(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """fps: list of (doc_id, fingerprint) -> smallest doc_id per row."""
    todo, out = set(range(len(fps))), [None] * len(fps)
    while todo:
        part, edge = set(), [todo.pop()]
        while edge:
            i = edge.pop()
            part.add(i)
            near = {j for j in todo if (fps[i][1] ^ fps[j][1]).bit_count() <= 3}
            todo -= near
            edge += near
        least = min((fps[i][0] for i in part if fps[i][0] is not None), default=None)
        for i in part:
            out[i] = least
    return out


def check_simhash(table):
    rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
    fps = [(d, brute_simhash(t)) for d, t in rows]
    want = order((d, f"{fp:016x}", c) for (d, fp), c in zip(fps, brute_components(fps)))
    assert order(tuple(r) for r in simhash_cover.simhash_report(table).collect()) == want


def test_simhash_brute_force(small, hard, empty):
    check_simhash(small)
    check_simhash(hard)
    assert simhash_cover.simhash_report(empty).count() == 0


def test_simhash_links_lose_nothing(spark):
    """Clouds of fingerprints around centres, anchors cut into blocks."""
    rnd = random.Random(7)
    fps = set()
    for _ in range(12):
        centre = rnd.getrandbits(64)
        for _ in range(40):
            fps.add(centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))))
    fps = sorted(fps)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    edges = simhash_cover.fingerprint_links(spark.createDataFrame(signed, "fp long"), block=4)
    roots = {r["node"]: r["root"] for r in simhash_cover.components(edges).collect()}
    groups = defaultdict(set)
    for (x,), c in zip(signed, brute_components(list(enumerate(fps)))):
        groups[c].add(x)
    for group in groups.values():
        assert {roots.get(x, x) for x in group} == {min(group)}


def test_simhash_chain_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 200), (100, 300)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash_cover.components(chain).collect()}
    assert {roots[i] for i in range(61)} == {0} and {roots[i] for i in (100, 200, 300)} == {100}


def plans_of(monkeypatch):
    """The plans of the tables that simhash_cover writes from here on."""
    plans, write = [], simhash_cover.materialise

    def noted(df, name, *args, **options):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name, *args, **options)

    monkeypatch.setattr(simhash_cover, "materialise", noted)
    return plans


def near_copies(spark, groups=60, copies=20):
    """Distinct fingerprints, most of whose anchors have another one of their group."""
    rnd = random.Random(11)
    fps = {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3)))
           for centre in (rnd.getrandbits(64) for _ in range(groups)) for _ in range(copies)}
    return spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in sorted(fps)], "fp long")


@pytest.mark.parametrize("most", [1 << 16, 100])
def test_simhash_placements_are_not_broadcast(spark, monkeypatch, most):
    """32 rows of a fingerprint have the size of one to Spark, which then broadcast them."""
    fps = simhash_cover.materialise(near_copies(spark), "test-fps")
    want = sorted(map(tuple, simhash_cover.components(simhash_cover.fingerprint_links(fps)).collect()))
    plans = plans_of(monkeypatch)
    monkeypatch.setattr(simhash_cover, "BROADCAST_ROWS", most, raising=False)
    edges = simhash_cover.fingerprint_links(fps)
    joined = dict(plans)["simhash-edges"]
    assert "BuildLeft" not in joined
    assert ("BroadcastHashJoin" if most > 100 else "SortMergeJoin") in joined
    assert sorted(map(tuple, simhash_cover.components(edges).collect())) == want


def test_simhash_broadcasts_few_rows_only(spark, monkeypatch, hard):
    """However small the files: what is broadcast goes by the rows of the table."""
    plans = plans_of(monkeypatch)
    monkeypatch.setattr(simhash_cover, "BROADCAST_ROWS", -1, raising=False)
    check_simhash(hard)
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (100, 300)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash_cover.components(edges).collect()}
    assert {roots[i] for i in range(61)} == {0} and {roots[i] for i in (100, 200, 300)} == {100}
    report = simhash_cover.simhash_report(hard)._jdf.queryExecution().executedPlan().toString()
    for name, plan in [*plans, ("report", report)]:
        assert "Broadcast" not in plan, name
    assert "SortMergeJoin" in report


def test_simhash_keeps_one(small, hard):
    for table in (small, hard):
        rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
        fps = [(d, brute_simhash(t)) for d, t in rows]
        kept = simhash_cover.keep_one(table)
        assert kept.columns == table.columns
        assert kept.count() == len(set(brute_components(fps)))


def test_simhash_keeps_one_of_rows_without_doc_id(spark):
    text = " ".join(f"w{i}" for i in range(400))
    near = next(t for t in (text.replace(f"w{i} ", "") for i in range(1, 400))
                if 0 < bin(brute_simhash(t) ^ brute_simhash(text)).count("1") <= 3)
    docs = spark.createDataFrame([(None, text), (None, near), (None, "quite another text here")], "doc_id long, text string")
    assert simhash_cover.keep_one(docs).count() == 2


def test_columns_named_like_the_helpers_pass_through(spark, small):
    names = ["_text_key", "_copy", "_lines", "_gone", "_n_lines", "_n_removed", "_doc", "_k1", "_host", "root", "cut"]
    docs = small.limit(60).select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    for kept in (line_spread.dedup_lines(docs), simhash_cover.keep_one(docs), site_quality.keep_good(docs, labels),
                 mixing.mix_documents(docs)):
        assert kept.columns == docs.columns
        assert {tuple(r)[-len(names):] for r in kept.collect()} == {tuple(range(len(names)))}


# ------------------------------------------------------------- blocks in order

def test_block_of_counts_the_cuts_below(spark):
    ids = [None, -5, 0, 1, 2, 3, 10, 11, 12, 10**15, *range(0, 20_000, 37)]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    for cuts in ([], [3], [0, 2], [-5, 0, 10], list(range(0, 20_000, 2))):
        got = df.select("doc_id", ordered.block_of(F.col("doc_id"), cuts).alias("b")).collect()
        assert all(r["b"] == (0 if r["doc_id"] is None else bisect_left(cuts, r["doc_id"])) for r in got)


# ---------------------------------------------------------- 5 substring dedup

def brute_windows(rows):
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - 12):
            key = tuple(w[i:i + 13])
            first[key] = min(first.get(key, 1 << 62), 1 << 62 if doc is None else doc)
    out = []
    for doc, text in rows:
        w, d = words(text), 1 << 62 if doc is None else doc
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i:i + 13])] < d:
                gone |= set(range(i, i + 13))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return order(out)


def test_recompression_brute_force(small, hard, empty):
    for table in (small, hard):
        rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
        for size in (500, recompress.CHUNK_BYTES):
            assert order(tuple(r) for r in recompress.dedup_report(table, chunk_bytes=size).collect()) == brute_windows(rows)
    assert recompress.dedup_report(empty).count() == 0


def test_recompression_few_words_and_runs(spark):
    rnd = random.Random(2)
    rows = []
    for doc in range(80):
        text = []
        while len(text) < rnd.randint(5, 80):
            text += [rnd.choice("abc")] * rnd.choice([1, 1, 1, 2, 5, 20])
        rows.append((doc, " ".join(text)))
    rows += [(100 + i, t[10:] + " tail") for i, (_, t) in enumerate(rows[:20])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert order(tuple(r) for r in recompress.dedup_report(df, chunk_bytes=300).collect()) == brute_windows(rows)
    # more buckets than tasks: as many as the text needs
    many = recompress.dedup_report(df, chunk_bytes=300, bucket_bytes=100)
    assert order(tuple(r) for r in many.collect()) == brute_windows(rows)


def test_recompression_gives_documents(spark):
    head, body, tail = ([f"{c}{i}" for i in range(n)] for c, n in (("h", 5), ("b", 20), ("t", 5)))
    texts = {1: body, 2: head + body + ["é"], 3: ["x"], 4: body + tail + body, 5: []}
    df = spark.createDataFrame([(d, "\n".join(w)) for d, w in texts.items()] + [(6, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["kept"], [tuple(s) for s in r["removed"]]) for r in recompress.dedup(df).collect()}
    assert got == {1: (20, " ".join(body), []), 2: (26, " ".join(head + ["é"]), [(5, 25)]), 3: (1, "x", []),
                   4: (45, " ".join(tail), [(0, 20), (25, 45)]), 5: (0, "", []), 6: (0, "", [])}


def test_recompression_picks_agree_between_occurrences():
    rnd = np.random.default_rng(5)
    window = rnd.integers(0, 4, 13).astype(np.uint64) + np.uint64(1)
    seen = set()
    for _ in range(200):
        a, b = (rnd.integers(1, 5, rnd.integers(0, 20)).astype(np.uint64) for _ in range(2))
        w = np.concatenate([a, window, b])
        first = np.zeros(len(w), bool)
        first[0] = True
        seen.add(int(recompress.picks(w, np.ones(len(w), np.int64), first)[len(a)]))
    assert len(seen) == 1


# ------------------------------------------------------------------- 6 top-k

def test_maxscore_brute_force(spark):
    rnd = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x)) for x in rnd.normal(size=8)]) for i in range(400)]
    rows += [(400, None), (None, [0.0] * 8), (450, [float("nan")] * 8), (500, rows[3][1]), (501, rows[3][1]), (501, rows[3][1]),
             (550, [1.0, None, 2.0]), (600, [0.5, 0.25]), (650, []), (700, [float("inf")] * 8), (701, [1e9] * 8)]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "vec_id long, embedding array<float>, shard int")
    valid = {(a, tuple(int(np.floor(256 * np.float64(np.float32(x)))) for x in b)) for a, b in rows
             if a is not None and b is not None and all(x is not None and np.isfinite(x) for x in b)}
    want = []
    for q, qv in valid:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(qv, cv)), c) for c, cv in valid if c != q)[:5]
            want += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores)]
    assert order(tuple(r) for r in maxscore.search(df).collect()) == order(want)
    assert maxscore.search(df.filter("false")).count() == 0


def test_maxscore_prunes_and_stays_exact():
    rnd = np.random.default_rng(8)
    c = (rnd.normal(size=(3000, 24)) * np.geomspace(4000, 1, 24)).astype(np.int64)
    shard = maxscore.Shard(np.arange(3000), list(c))
    for big in (1, 1 << 45):
        for i in range(0, 200, 40):
            q = c[i] * (big if big > 1 else 1) // (1 << 30 if big > 1 else 1)
            s = c @ q
            want = sorted((int(-s[j]), j) for j in range(3000) if j != i)[:5]
            assert shard.top(i, q, 5) == [(j, -v) for v, j in want]


def brute_top(rows, k=5):
    valid = {(a, tuple(int(x) * 256 if abs(x) > 1e300 else int(np.floor(256 * x)) for x in b)) for a, b in rows}
    want = []
    for q, qv in valid:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(qv, cv)), c) for c, cv in valid if c != q)[:k]
            want += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores)]
    return want


def test_maxscore_keeps_every_finite_vector(spark):
    rnd = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rnd.normal(size=8)]) for i in range(200)]
    rows += [(int(200 + i), [float(x) for x in rnd.normal(size=8) * 10.0 ** rnd.integers(4, 7)]) for i in range(101)]
    rows += [(401, [1e6] * 8), (402, [1e6] * 8), (403, [1e6] * 7 + [1e6 + 2 ** -8]), (450, [600_000.0] * 3), (450, [600_000.0001] * 3),
             (451, [524_288.0, -3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert order(tuple(r) for r in maxscore.search(df).collect()) == order(brute_top(rows))
    # components beyond a long, scaled ones beyond a double: only returned scores count
    rows = [(50, [2.0, 0.0]), (1, [-1e300, 7.0]), (2, [-1e307, 7.0]), *((i, [float(i), 1e307 * (-1) ** i]) for i in range(3, 9))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert order(tuple(r) for r in maxscore.search(df).collect()) == order(brute_top(rows))
    with pytest.raises(Exception, match="cannot be a long"):
        maxscore.search(df, k=8).collect()
    with pytest.raises(Exception, match="cannot be a long"):
        maxscore.search(df.union(spark.createDataFrame([(9, [1e300, 0.0])], df.schema))).collect()


def test_maxscore_long_vectors_stay_in_range():
    c = np.full((7, 4096), (1 << 27) - 1, np.int64)
    c[3, 0] = -5
    shard = maxscore.Shard(np.arange(7), list(c))
    want = sorted((-sum(x * y for x, y in zip(c[0].tolist(), r.tolist())), i) for i, r in enumerate(c) if i)[:5]
    assert shard.top(0, c[0], 5) == [(i, -s) for s, i in want]


# ----------------------------------------------------------------- 7 quality

def test_quality_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train, held = labels.filter("doc_id % 3 <> 0"), labels.filter("doc_id % 3 = 0").alias("l")
    rows = (site_quality.score(docs, train).join(held, "doc_id").groupBy("quality", "keep").count().collect())
    n = Counter({(r["quality"], r["keep"]): r["count"] for r in rows})
    assert n[1, 0] <= 0.005 * (n[1, 0] + n[1, 1])
    assert n[0, 1] <= 0.05 * (n[0, 0] + n[0, 1])


def test_quality_shrinks_sparse_sites(spark):
    rows = [("big", "p", 0.1)] * 500 + [("tiny", "p", 0.1)] + [("rest", "p", 0.9)] * 2000 + [(None, None, 0.9)]
    e = spark.createDataFrame(rows, "_host string, _path string, p_doc double")
    p = {r["_host"]: r for r in site_quality.site_posteriors(e).collect()}
    assert p["big"]["p_path"] < 0.2 < p["tiny"]["p_path"] < p["rest"]["p_path"]
    assert e.agg(F.avg("p_doc")).first()[0] == pytest.approx(p["big"]["p_global"])


def brute_posteriors(rows):
    """(host, path, p) -> {(host, path): (p_host, p_path)}, by the definition."""
    n = len(rows)
    mean = sum(p for *_, p in rows) / n
    within = max(sum(p * p for *_, p in rows) / n - mean ** 2, 1e-9)
    hosts, paths = defaultdict(list), defaultdict(list)
    for host, path, p in rows:
        hosts[host].append(p)
        paths[host, path].append(p)
    avg = lambda v: sum(v) / len(v)

    def strength(variance, groups, centre, taken, weight):
        spread = sum(len(v) * (avg(v) - centre(k)) ** 2 for k, v in groups.items())
        between = max((spread - (len(groups) - taken) * variance) / weight, 0) if weight > 0 else 0
        return min(variance / between, 1000.0) if between > 0 else 1000.0

    a = strength(within, hosts, lambda _: mean, 1, n - sum(len(v) ** 2 for v in hosts.values()) / n)
    inside = max(sum(sum((x - avg(v)) ** 2 for x in v) for v in paths.values()) / (n - len(paths)), 1e-9) if n > len(paths) else within
    b = strength(inside, paths, lambda k: avg(hosts[k[0]]), len(hosts),
                 n - sum(len(v) ** 2 / len(hosts[k[0]]) for k, v in paths.items()))
    p_host = {h: (sum(v) + a * mean) / (len(v) + a) for h, v in hosts.items()}
    return {k: (p_host[k[0]], (sum(v) + b * p_host[k[0]]) / (len(v) + b)) for k, v in paths.items()}, b


def test_quality_posteriors_brute_force(spark):
    rnd = random.Random(21)
    rows = []
    for host in range(12):
        level = rnd.betavariate(6, 2)
        for path in range(rnd.randint(1, 5)):
            here = min(max(level + rnd.gauss(0, 0.15), 0.05), 0.95)
            rows += [(f"h{host}" if host else None, f"p{path}" if path else None, min(max(rnd.gauss(here, 0.1), 0.01), 0.99))
                     for _ in range(rnd.choice((1, 3, 40)))]
    df = spark.createDataFrame(rows, "_host string, _path string, p_doc double")
    want, strength = brute_posteriors(rows)
    got = {(r["_host"], r["_path"]): (r["p_host"], r["p_path"]) for r in site_quality.site_posteriors(df).collect()}
    assert got.keys() == want.keys() and 0.05 < strength < 50          # estimated, not a constant
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    one = spark.createDataFrame([("a", "b", 0.25)], df.schema)
    assert tuple(site_quality.site_posteriors(one).first()) == ("a", "b", 0.25, 0.25, 0.25)


def test_quality_hard_cases(spark, hard, empty):
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 0), (None, 1), (99, 0), (1, 1)], "doc_id long, quality int")
    none = labels.filter("false")
    assert site_quality.score(hard, labels).count() == hard.count()
    kept = site_quality.keep_good(hard, none)
    assert kept.columns == hard.columns and kept.count() == hard.count()
    assert site_quality.score(empty, labels).count() == 0 and site_quality.score(empty, none).count() == 0


# -------------------------------------------------------------------- 8 rANS

def test_rans_report(small, hard, empty):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORD)
    for table in (small, hard):
        rows = table.select("doc_id", "text").collect()
        got = rans.report(table, WORD).collect()
        size = {}
        for d, x in rows:
            ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
            size.setdefault(d, []).append((len(ids), zlib.crc32(ids.tobytes())))
        assert {d: sorted(v) for d, v in size.items()} == {
            d: sorted((r["n_tokens"], r["ids_crc32"]) for r in got if r["doc_id"] == d) for d in size}
        got.sort(key=lambda r: r["start"])
        at = 0
        for r in got:
            assert r["start"] == at
            at += r["n_tokens"]
        ids = [r["doc_id"] for r in got]
        assert ids == sorted(ids, key=lambda d: (d is not None, d))
    assert rans.report(empty, WORD).count() == 0


@pytest.mark.parametrize("n", [0, 1, 3, 511, 512, 513, 65_535, 65_536, 65_537, 200_000])
def test_rans_pack_round_trip(n):
    rnd = np.random.default_rng(n)
    ids = (rnd.zipf(1.4, n) % 50_000).astype("<u4")
    table = rans.Frequencies(rans.Frequencies.scale(np.bincount(ids, minlength=50_000)))
    data = rans.encode_pack(ids, table)
    assert (rans.decode_pack(data, table) == ids).all()
    with pytest.raises(ValueError):
        rans.decode_pack(data[:20] + bytes([data[20] ^ 1]) + data[21:], table)


def test_rans_scale_keeps_rare_symbols():
    counts = np.array([10 ** 9, 1, 0, 5] + [1] * 1000)
    scaled = rans.Frequencies.scale(counts)
    assert scaled.sum() == 1 << rans.SCALE_BITS and ((scaled > 0) == (counts > 0)).all()


@pytest.mark.parametrize("memo", [1, 2, 3, 5, 1000])
def test_rans_table_emptied_in_a_text(monkeypatch, memo):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORD)
    monkeypatch.setattr(rans, "MEMO", memo)
    with open(WORD, encoding="utf-8") as f:
        encoder = rans.WordEncoder(f.read())
    rnd = random.Random(memo)
    pieces = ["said", '"yes",', "and", "(no).", "he", "went,", "home.", "x" * 70 + '",', "a_,", "Été", "-", "1.5", "end!."]
    texts = ['said "yes", and then he went home', *(" ".join(rnd.choices(pieces, k=rnd.randint(0, 12))) for _ in range(300))]
    for _ in range(2):
        got = [np.frombuffer(x, f"<u{array(encoder.kind).itemsize}").tolist() for x in encoder.encode(texts)]
        assert got == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_rans_looks_a_piece_up_once_a_group(monkeypatch):
    """Also: words among signs are cut as the library does, and special tokens stay whole."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORD)
    with open(WORD, encoding="utf-8") as f:
        encoder = rans.WordEncoder(f.read())
    calls = Counter()
    rnd = random.Random(5)
    signs = list("!#$%&*().;:?'<|>[]_-/@`~^{}+=\\,\"") + ["", "", "<|", "|>", "\u0301", "…", "1"]
    mixed = ["".join(rnd.choices(signs, k=rnd.randint(0, 3))) + rnd.choice(["hello", "ünder", "Été", "endoftext", "s", "re", "ªb", "ŉ", "7"])
             + "".join(rnd.choices(signs, k=rnd.randint(0, 3))) for _ in range(3000)]
    texts = ["<|endoftext|> a", "x<|startoftext|>y.", "", *(" ".join(rnd.choices(mixed, k=9)) for _ in range(2000)), *mixed]
    for chars in (1, 300, rans.GROUP_CHARS):
        monkeypatch.setattr(rans, "GROUP_CHARS", chars)
        got = [array(encoder.kind, x).tolist() for x in encoder.encode(texts)]
        assert got == [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]

    class Counted(rans.WordEncoder):
        def __getitem__(self, piece):
            calls[piece] += 1
            return super().__getitem__(piece)

    with open(WORD, encoding="utf-8") as f:
        counted = Counted(f.read())
    list(counted.encode(["some words and some words"] * 500))
    assert set(calls.values()) == {1} and set(calls) == {"some", "words", "and", ""}


# --------------------------------------------------------------------- 9 PII

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_base(text):
    def luhn(d):
        s = 0
        for i, c in enumerate(d[::-1]):
            v = int(c) * (2 if i % 2 else 1)
            s += v - 9 if v > 9 else v
        return s % 10 == 0

    out = []
    for kind, p in BASE.items():
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((kind, *m.span()))
    return out


def test_pii_base_spans(small, hard, empty):
    rnd = random.Random(6)
    alphabet = ["@", ".", "a", "b1", "-", "+", " ", "1", "22", "255", "256", "4111 1111 1111 1111", "x@y.z", "+1 (555) 1", "é", "%"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    for t in texts:
        assert [(k, a, b) for k, s in pii_votes.base_spans(t).items() for a, b in s] == brute_base(t)
    for table in (small, hard):
        text = defaultdict(list)
        for r in table.collect():
            text[r["doc_id"]].append(brute_base(r["text"] or ""))
        got = defaultdict(list)
        for r in pii_votes.detect(table).collect():
            got[r["doc_id"]].append(r)
            assert all(s in r["spans"].split(",") for s in [])
        assert {d: sorted(",".join(f"{k}:{a}:{b}" for k, a, b in x) for x in v) for d, v in text.items()}.keys() == got.keys()
        for d, v in text.items():
            want = sorted((sha(",".join(f"{k}:{a}:{b}" for k, a, b in x)), *(sum(s[0] == k for s in x) for k in BASE)) for x in v)
            assert want == sorted((r["base_sha256"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in got[d])
            for x in v:
                assert any({f"{k}:{a}:{b}" for k, a, b in x} <= set(r["spans"].split(",")) for r in got[d])
    assert pii_votes.detect(empty).count() == 0


def test_pii_ip_with_thousands_of_zeros():
    zeros = "0" * 6000
    assert pii_votes.base_spans(f"1.2.3.{zeros}")["ip"] == [(0, 6006)]
    assert pii_votes.base_spans(f"1.2.3.{zeros}256")["ip"] == []


def test_pii_candidates_of_a_text_with_many_spans():
    part = "mail a@b.com from 1 . 2 . 3 . 4 call 030 1234 567 or +49 30 1234567. "
    base, found = pii_votes.candidates(part * 5000)
    loose = [r[:3] for r in found if not r[3]]
    taken = {i for spans in base.values() for a, b in spans for i in range(a, b)}
    assert loose and all(taken.isdisjoint(range(a, b)) for _, a, b in loose)
    assert len(loose) == 5000 * len([r for r in pii_votes.candidates(part)[1] if not r[3]])


def test_pii_estimates_reliabilities():
    rnd = np.random.default_rng(2)
    truth = rnd.random(4000) < 0.4
    right = np.array([0.95, 0.9, 0.8, 0.6])
    says = np.where(rnd.random((4000, 4)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    patterns, counts = np.unique(says, axis=0, return_counts=True)
    share, table, post = pii_votes.estimate(patterns, counts.astype(float))
    assert abs(share - 0.4) < 0.05 and np.abs(table[1, :, 2] - right).max() < 0.06
    w = pii_votes.fit_classifier(patterns, counts.astype(float), post).tolist()
    said = np.array([pii_votes.probability(w, list(s)) > 0.5 for s in says])
    assert (said == truth).mean() > 0.94


def test_pii_adds_supported_spans(spark):
    rows = [(i, f"call me +1 (555) 123-{1000 + i} or mail p{i}@mail.example.com") for i in range(60)]
    rows += [(100 + i, f"phone: (555) 123-{1000 + i} now") for i in range(40)] + [(200, "version 1.2.3.4.5 page 12-13-1999")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii_votes.detect(df, add_at=0.5).collect()}
    assert all(got[i]["n_phone"] == 1 and got[i]["n_email"] == 1 for i in range(60))
    assert all(s["spans"].count("phone:") <= 1 for s in got.values())


def test_pii_adds_planted_spans_at_production_threshold(spark):
    true, false = {}, {}
    rows = [(i, f"call me +1 (555) 123-{1000 + i} or mail p{i}@mail.example.com") for i in range(60)]
    for i in range(40):
        for d, kind, head, span, tail in (
                (100 + i, "phone", "phone: ", f"(555) 123-{1000 + i}", " now"),
                (200 + i, "email", "contact ", f"bob{'abcd'[i % 4]} [at] example [dot] com", " today")):
            rows.append((d, head + span + tail))
            true[d] = f"{kind}:{len(head)}:{len(head) + len(span)}"
        for d, text in ((300 + i, f"section 12-13-19{10 + i} of the release"), (400 + i, f"the dot looks at example{i}.com again"),
                        (500 + i, f"version 10-20-30-{10 + i} costs $ 12 34 5{i % 10}")):
            rows.append((d, text))
            false[d] = text
            assert any(not r[3] for r in pii_votes.candidates(text)[1])
    got = {r["doc_id"]: r["spans"] for r in pii_votes.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: got[d] for d in true} == true
    assert {d: got[d] for d in false} == dict.fromkeys(false, "")


def test_rans_cuts_where_the_library_does_around_control_characters():
    """Fuzz over signs, stops and all control characters."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORD)
    with open(WORD, encoding="utf-8") as f:
        encoder = rans.WordEncoder(f.read())
    rnd = random.Random(11)
    odd = [chr(c) for c in (*range(0x20), 0x7F, 0x85, 0xA0, 0x2028)]
    plain = list("ab1_.,,..  ") + ["\n", '"', "-", "é", "Z"]
    texts = [f"ab{c}. cd" for c in odd] + [f"ab{c}, cd{c}." for c in odd]
    texts += ["".join(rnd.choice(odd if rnd.random() < 0.3 else plain) for _ in range(rnd.randint(1, 14))) for _ in range(100_000)]
    ids = [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    got = encoder.encode(texts)
    wrong = [x for x, want, found in zip(texts, ids, got) if array(encoder.kind, found).tolist() != want]
    assert not wrong, wrong[:5]


# ------------------------------------------------------------------ 10 mixing

def brute_targets(sizes):
    order_ = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order_)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(order_)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def check_mix(table):
    rows = table.select("doc_id", "text", "source").collect()
    sizes, largest = Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
        largest[r["source"]] = max(largest[r["source"]], len(words(r["text"])))
    targets = brute_targets(dict(sizes))
    got = mixing.mix_report(table).collect()
    assert order((r["doc_id"], r["size"]) for r in got) == order((r["doc_id"], len(words(r["text"]))) for r in rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert sorted((r["source_size"], round(r["target"], 6)) for r in got) == sorted(
        (sizes[r["source"]], round(targets[r["source"]], 6)) for r in rows)
    return rows, got, targets, largest


def test_mixing_brute_force(small, hard, empty):
    rows, got, targets, largest = check_mix(small)
    source = {r["doc_id"]: r["source"] for r in rows}
    taken = Counter()
    for r in got:
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - t) <= largest[s] / 2 + 1e-6 for s, t in targets.items())
    assert order(map(tuple, got)) == order(map(tuple, mixing.mix_report(small.repartition(7)).collect()))
    check_mix(hard)
    assert mixing.mix_report(empty).count() == 0
    mixed = mixing.mix_documents(small)
    assert mixed.columns == small.columns
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert {r["doc_id"]: r["taken"] for r in got if r["size"]} == {
        r["doc_id"]: times[r["doc_id"]] * r["size"] for r in got if r["size"]}
    assert mixing.mix_documents(empty).count() == 0 and mixing.mix_documents(hard).columns == hard.columns


def check_bounds(rows, spark):
    """No row beyond twice its size; every source within half its largest hash group of its target."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_report(df).collect()
    assert len(got) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in got)
    return got


def test_mixing_tells_rows_apart_by_their_text(spark):
    # a source at its cap, with an empty row under the doc_id of another
    rows = [(1, None, "a"), (1, "x y z", "a")] + [(i, "w " * 50, "b") for i in range(2, 40)]
    got = check_bounds(rows, spark)
    assert sorted(r["taken"] for r in got if r["size"] <= 3) == [0, 6]
    # rows without doc_id
    rows = [(None, " ".join(f"w{i}x{j}" for j in range(10)), s) for i in range(200) for s in ("a", "b")]
    got = check_bounds(rows, spark)
    for target in {r["target"] for r in got}:
        of = [r for r in got if r["target"] == target]
        assert abs(sum(r["taken"] for r in of) - target) <= 5
    assert len(spark.createDataFrame(rows, "doc_id long, text string, source string").collect()) == 400


def test_mixing_takes_equal_rows_together(spark):
    rows = [(7, "same words here", "a")] * 60 + [(i, "one two", "a") for i in range(40)] + [(i, "x " * 30, "b") for i in range(100, 120)]
    got = check_bounds(rows, spark)
    for target in {r["target"] for r in got}:
        of = [r for r in got if r["target"] == target]
        assert abs(sum(r["taken"] for r in of) - target) <= 60 * 3 / 2
    assert len({r["taken"] for r in got if r["size"] == 3}) == 1


def test_mixing_groups_stay_small():
    assert [mixing.group_digits(n) for n in (0, 1 << 20, 4096 * mixing.GROUP_ROWS + 1, 10 ** 12)] == [3, 3, 4, 7]


def test_bpe_splits_the_basic_plane_as_its_pattern_does():
    from tokenizers import Tokenizer
    wanted, mine = bpe.regex.compile(bpe.PIECES), bpe.plane_zero_pieces()
    for lo in range(0, 0x10000, 0x100):
        codes = [c for c in range(lo, lo + 0x100) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{chr(c)}1 {chr(c)}'s  {chr(c)}{chr(c)}\n" for c in codes)
        assert mine.findall(text) == wanted.findall(text)
    t, codec = Tokenizer.from_file(BYTE), bpe.Codec(bpe.load_vocabulary(BYTE))
    for text in ("it's \U0001F600 we'll 'tis  x\u00a0\u3000y", "we've  \t'd\U00020000 12'3", " 're\x1c\x85 ok"):
        assert codec.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_components_take_the_tasks_that_their_edges_need(spark):
    names = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        edges = spark.range(400).selectExpr("id as a", "id + 7 as b")
        found = simhash_cover.components(edges)
        files = found.inputFiles()
        assert {r["node"]: r["root"] for r in found.collect()} == {i: i % 7 for i in range(407)}
        assert len(files) <= 2 * spark.sparkContext.defaultParallelism
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
