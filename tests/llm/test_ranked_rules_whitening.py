"""Whitening, quality rules and blocked search against brute force, and their hard cases."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from bookmart.llm import blocked_search, quality_rules, whitening

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TERMS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


# -------------------------------------------------------------- 11 whitening

def brute_whitening(vectors, count=32):
    """n, deviations, variances, whitened, total variance by an eigendecomposition."""
    width = max(map(len, vectors))
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in (*v, *[0.0] * (width - len(v)))] for v in vectors], object)
    n = len(x)
    d = n * x - x.sum(0)
    y = d.astype(float) / n
    v = y.T @ y / n
    e, w = np.linalg.eigh(v)
    best = np.argsort(-e)[:count]
    e, w = e[best], w[:, best]
    return n, [sum(int(a) ** 2 for a in r) for r in d], e, (y @ w) / np.sqrt(np.maximum(e, 1e-300)), float(np.trace(v))


def check_whitening(df, rows, count=32):
    """``rows``: (vec_id, vector) of the rows that take part, ids distinct."""
    n, deviation, e, z, total = brute_whitening([v for _, v in rows], count)
    at = {i: k for k, (i, _) in enumerate(rows)}
    got = whitening.report(df).collect()
    assert len(got) == len(rows) * len(e)
    found = np.zeros_like(z)
    for r in got:
        k, c = at[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[k] and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(e[c] / total, rel=1e-9)
        found[k, c] = r["whitened"]
    assert np.abs(found * np.sign((found * z).sum(0)) - z).max() < 1e-8
    assert np.abs(found.T @ found / n - np.eye(len(e))).max() < 1e-9


def test_whitening_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check_whitening(df, [(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_whitening_of_badly_conditioned_rows(spark):
    rnd = np.random.default_rng(5)
    v = rnd.normal(size=(300, 8)) @ rnd.normal(size=(8, 8)) * np.geomspace(1e7, 1, 8)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    model = whitening.fit(whitening.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    n, _, e, _, total = brute_whitening([r for _, r in rows])
    assert model.used == 8 and model.total == pytest.approx(total, rel=1e-12)
    assert np.allclose(model.variances[:4], e[:4], rtol=1e-10)


def test_whitening_finds_dependent_dimensions(spark):
    rnd = np.random.default_rng(6)
    a = rnd.integers(-500, 500, size=(60, 3)) / 64.0
    v = np.hstack([a, a[:, :1], a[:, :1] + a[:, 1:2], np.full((60, 1), 7.0)])
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    got = whitening.report(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 60 * 6
    assert {r["component"] for r in got if r["whitened"] is None} == {4, 5, 6}
    assert all(r["identity_error"] < 1e-9 for r in got)
    assert sum(r["explained"] for r in got) / 60 == pytest.approx(1)
    assert {r["explained"] for r in got if r["component"] > 3} == {0.0}


def test_whitening_hard_cases(spark):
    kind = "vec_id long, embedding array<double>, n long, x string"
    rows = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, None), (3, [1.0, None, 2.0]), (4, [float("nan"), 1.0, 1.0]),
            (5, [float("inf"), 1.0, 1.0]), (None, [4.0, -1.0, 0.5]), (6, [2.5]), (7, [])]
    got = whitening.report(spark.createDataFrame([(*r, 9, "x") for r in rows], kind)).collect()
    assert Counter(r["vec_id"] for r in got) == {1: 6, None: 3, 6: 3, 7: 3}
    n, deviation, *_ = brute_whitening([rows[i][1] for i in (0, 1, 6, 7, 8)])
    assert {r["n"] for r in got} == {n} and sorted(r["deviation"] for r in got if r["component"] == 1) == sorted(deviation)
    one = whitening.report(spark.createDataFrame([(1, [1.0, 2.0], 1, "x")], kind)).collect()
    assert [tuple(r) for r in one] == [(1, 1, 1, 0, None, None, None), (1, 2, 1, 0, None, None, None)]
    for none in ([], [(2, None, 1, "x")], [(3, [], 1, "x")]):
        assert whitening.report(spark.createDataFrame(none, kind)).count() == 0
    with pytest.raises(Exception, match="cannot be a long"):
        whitening.report(spark.createDataFrame([(1, [1e300], 1, "x")], kind)).collect()


def test_whitening_keeps_whole_numbers_beyond_64_bits():
    x = np.array([[1 << 61, 3], [-(1 << 61), 4], [5, 6]], np.int64)
    sums = [int(s) for s in x.astype(object).sum(0)]
    assert whitening._centre(x, 3, sums).tolist() == (3 * x.astype(object) - np.array(sums, object)).tolist()


# ---------------------------------------------------------- 12 quality rules

def brute_counts(text):
    text = text or ""
    w = WORDS.findall(text)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered, seen, lines = set(), set(), 0
    for i in range(len(w) - 2):
        if windows[tuple(w[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORDS.search(line):
            lines += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), lines, len(covered)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_quality_rules_counts_and_verdicts(spark, labels):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    label = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = quality_rules.judge(docs, labels).collect()
    assert len(got) == len(text)
    right = Counter()
    for r in got:
        want = brute_counts(text[r["doc_id"]])
        assert tuple(r[c] for c in COUNTS) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"]) and 0 <= r["probability"] <= 1
        if r["doc_id"] in label and not r["base_failed"]:
            right[r["kept"] == (label[r["doc_id"]] == 1)] += 1
    assert right[False] <= 0.02 * right.total()


def test_quality_rules_held_out(spark, labels):
    """Trained on the labels of even doc_ids, judged on the odd ones."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    label = {r["doc_id"]: r["quality"] for r in labels.collect() if r["doc_id"] % 2}
    got = [r for r in quality_rules.judge(docs, labels.filter("doc_id % 2 = 0")).collect()
           if r["doc_id"] in label and not r["base_failed"]]
    good = [r for r in got if label[r["doc_id"]]]
    bad = [r for r in got if not label[r["doc_id"]]]
    assert len(bad) > 5 and sum(r["kept"] for r in good) >= 0.98 * len(good) and sum(r["kept"] for r in bad) <= 0.1 * len(bad)
    # the probabilities say how often they are right
    assert abs(np.mean([r["probability"] for r in got]) - len(good) / len(got)) < 0.08


def test_quality_rules_sample_is_bounded(spark, labels, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen = []
    monkeypatch.setattr(quality_rules, "fit", lambda rows, y: seen.append((len(rows), sum(len(c) for c, _ in rows), set(y))))
    for rows, columns in ((50, 10 ** 9), (400, 30_000), (400, 1)):
        quality_rules.train(docs, labels, sample_rows=rows, sample_columns=columns)
    assert seen[0][0] == 50 and seen[0][1] > 0
    assert seen[1][0] < 400 and seen[1][1] <= 30_000
    assert seen[2][0] == 2 and seen[2][2] == {0.0, 1.0}


def test_quality_rules_hard_cases(spark, hard, empty):
    kind = "doc_id long, quality int, toxic int, text string"
    marks = spark.createDataFrame([(1, 1, 0, "x"), (1, 0, 0, "x"), (3, 0, 1, "y"), (6, None, 0, "z"), (None, 1, 0, ""),
                                   (12, 0, 0, "q"), (999, 0, 0, "no document")], kind)
    rows = hard.collect()
    got = quality_rules.judge(hard, marks).collect()
    assert order((r["doc_id"], *(r[c] for c in COUNTS)) for r in got) == order((r["doc_id"], *brute_counts(r["text"])) for r in rows)
    for without in (marks.limit(0), marks.filter("quality = 1")):           # the limits alone decide
        assert all(r["kept"] == (not r["base_failed"]) for r in quality_rules.judge(hard, without).collect())
    assert quality_rules.judge(empty, marks).count() == 0
    same = defaultdict(set)
    for r in got:
        if r["doc_id"] == 1:
            same[1].add(tuple(r)[1:])
    assert len(same[1]) == 1


def test_quality_rules_count_repeats_of_any_vocabulary():
    rnd = random.Random(2)
    for size, n in ((2, 60), (5, 300), (400, 1000)):
        text = " ".join(f"w{rnd.randrange(size)}" for _ in range(n))
        assert quality_rules.Text(text.encode()).counts() == brute_counts(text)
    for text in ("", "a", "a a a", "a a a a", "a b c a b", "a b c a b c", "\n\n x \n x \n x", "é\x1cü #"):
        assert quality_rules.Text(text.encode()).counts() == brute_counts(text)


def test_quality_rules_slices_of_long_texts_are_the_whole_text(monkeypatch):
    text = "".join(random.Random(3).choice("abc dé#\n") for _ in range(5_000)).encode()
    whole = quality_rules.sparse(quality_rules.Text(text))
    monkeypatch.setattr(quality_rules, "_SLICE", 97)
    parts = quality_rules.sparse(quality_rules.Text(text))
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1])


def test_platt_recovers_a_logistic_curve():
    rnd = np.random.default_rng(1)
    z = rnd.normal(size=20_000) * 3
    y = (rnd.random(20_000) < 1 / (1 + np.exp(-(0.7 * z - 0.4)))).astype(float)
    slope, offset = quality_rules.platt(z, y)
    assert abs(slope - 0.7) < 0.05 and abs(offset + 0.4) < 0.08


# --------------------------------------------------------- 13 blocked search

def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_search(docs, items, k=10):
    """docs: (doc_id, text), items: (item_id, text)."""
    counts = [(d, Counter(TERMS.findall(lower(t)))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total, df = len(counts), sum(c.total() for _, c in counts), Counter()
    for _, c in counts:
        df.update(c.keys())
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(TERMS.findall(lower(t)))
    out = []
    for i, terms in wanted.items():
        found = []
        for d, c in counts:
            m = 10 + (90 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in terms if c[t])
            if score > 0:
                found.append((-score, d is None, d))
        out += [(i, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k])]
    return out


def test_blocked_search_brute_force(spark, small):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute_search([(r["doc_id"], r["text"]) for r in small.collect()], [tuple(r)[:2] for r in items.collect()])
    assert order(tuple(r) for r in blocked_search.search(small, items).collect()) == order(want)
    # items in several groups, each with a pass of its own
    few = items.filter("item_id < 4")
    pairs = blocked_search.item_terms(few).count()
    assert 2 <= len(blocked_search._groups(blocked_search.item_terms(few), pairs - 1)) <= 4
    assert order(tuple(r) for r in blocked_search.search(small, few, vocabulary=pairs - 1).collect()) == order(
        r for r in want if r[0] < 4)


def test_blocked_search_hard_cases(spark, hard, empty):
    kind = "item_id long, text string, doc_id long, score string"
    rows = [(1, "alpha BETA beta gamma"), (1, "pi"), (2, None), (3, ""), (4, "... !!"), (None, "word1 word976"), (5, "ünïcödé 🙂"),
            (6, "unknown"), (7, "one two"), (7, "one two")]
    items = spark.createDataFrame([(*r, 1, "x") for r in rows], kind)
    want = brute_search([(r["doc_id"], r["text"]) for r in hard.collect()], rows)
    assert order(tuple(r) for r in blocked_search.search(hard, items).collect()) == order(want)
    assert {i for i, *_ in want} >= {1, None, 5, 7}
    assert blocked_search.search(empty, items).count() == 0
    assert blocked_search.search(hard, items.limit(0)).count() == 0
    assert blocked_search.search(hard, items.filter("item_id = 2")).count() == 0


def test_blocked_search_ties_go_to_the_smaller_doc_id(spark):
    docs = spark.createDataFrame([(i, "red green") for i in range(40, 0, -1)] + [(None, "red green")] * 3 + [(50, "blue")] * 80,
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, "red")], "item_id long, text string")
    assert [r["doc_id"] for r in blocked_search.search(docs, items).orderBy("rank").collect()] == list(range(1, 11))


def make_shard(rnd, docs, ranks, least=1, most=30):
    rows = [np.sort(rnd.choice(ranks, rnd.integers(least, most), replace=False)) for _ in range(docs)]
    rank = np.concatenate(rows)
    impact = (rnd.pareto(1.0, len(rank)) * 1e9).astype(np.int64) // (rank + 1) + 1
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    return blocked_search.Shard(np.zeros(docs, bool), np.arange(docs), ends, rank, impact, ranks), rows, impact, ends


def test_blocked_search_skips_blocks_and_stays_exact():
    rnd = np.random.default_rng(9)
    shard, rows, impact, ends = make_shard(rnd, 4000, 200)
    scored = 0
    for _ in range(40):
        query = np.sort(rnd.choice(200, 12, replace=False))
        wanted = np.zeros(200, np.int64)
        wanted[query] = 1
        best, plain = blocked_search.Best(10), shard.score

        def counted(docs, w):
            nonlocal scored
            scored += len(docs)
            return plain(docs, w)

        shard.score = counted
        shard.search(query, best, wanted)
        shard.score = plain
        every = np.array([(impact[a:b] * wanted[rows[i]]).sum() for i, (a, b) in enumerate(zip(ends, ends[1:]))])
        want = sorted((-int(s), i) for i, s in enumerate(every) if s > 0)[:10]
        assert [(-int(s), int(d)) for s, d in zip(best.score, best.doc)] == want
    assert scored < 0.5 * 40 * 4000


def test_blocked_search_summaries_bound_their_blocks():
    rnd = np.random.default_rng(10)
    shard, rows, impact, ends = make_shard(rnd, 1500, 60)
    for t in range(60):
        docs, cuts, kinds, summary = shard.block(t)
        assert sorted(docs) == [i for i, r in enumerate(rows) if t in r]
        for b, (a, z) in enumerate(zip(cuts, cuts[1:])):
            most = defaultdict(int)
            for d in docs[a:z]:
                for r, x in zip(rows[d], impact[ends[d]:ends[d + 1]]):
                    if r >= t:
                        most[r] = max(most[r], x)
            assert {int(k): int(v) for k, v in zip(kinds, summary[b]) if v} == dict(most)
