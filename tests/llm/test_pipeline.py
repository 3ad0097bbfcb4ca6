"""The pipeline stage by stage, and the registered queries against DuckDB."""

import importlib
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from bookmart.llm.queries import ORACLE, QUERIES

from .test_operators import BYTE, brute_components, brute_lines, brute_simhash, brute_targets, order, sha, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(input rows, output rows, output columns) of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.materialise(stage(spark, docs, SF), "test-stage")
        out[name] = (docs.collect(), result.collect(), result.columns)
        docs = result
    return out


def test_stages_keep_the_columns(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages) and len(stages) == 5
    assert all(c == columns for _, _, c in list(stages.values())[:-1])


def test_quality_stage_keeps_good_and_drops_bad(spark, stages):
    before, after, _ = stages["quality classifier"]
    kept = {r["doc_id"] for r in after}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert all(r["doc_id"] in kept for r in labels if r["quality"] == 1)
    assert not any(r["doc_id"] in kept for r in labels if r["quality"] == 0)
    assert kept <= {r["doc_id"] for r in before} and len(after) == len(kept)


def test_line_stage(stages):
    before, after, _ = stages["line dedup"]
    want = {d: s for d, _, _, s in brute_lines([(r["doc_id"], r["text"], r["source"]) for r in before], 5)}
    assert {r["doc_id"]: sha(r["text"]) for r in after} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_near_dedup_stage(stages):
    before, after, _ = stages["SimHash near-dedup"]
    fps = [(r["doc_id"], brute_simhash(r["text"])) for r in before]
    assert sorted(r["doc_id"] for r in after) == sorted(set(brute_components(fps)))


def test_mix_stage(stages):
    before, after, _ = stages["mixing sources"]
    sizes, taken = {}, {}
    for r in before:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(words(r["text"]))
    for r in after:
        taken[r["source"]] = taken.get(r["source"], 0) + len(words(r["text"]))
    largest = max(len(words(r["text"])) for r in before)
    assert all(abs(taken.get(s, 0) - t) <= largest / 2 + 1e-6 for s, t in brute_targets(sizes).items())


def test_encode_stage(stages):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTE)
    before, after, _ = stages["BPE encoding"]
    want = sorted((r["doc_id"], t.encode(r["text"], add_special_tokens=False).ids, sha(r["text"])) for r in before)
    assert sorted((r["doc_id"], list(r["ids"]), r["decoded_sha256"]) for r in after) == want


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in got.collect()) == sorted(
        (r["doc_id"], r["ids_sha256"]) for r in stages["BPE encoding"][1])


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_hard_and_empty_tables(spark, hard, empty, stage):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, run = spark.conf.get(setting), dict(corpus_pipeline.STAGES)[stage]
    rows = hard.collect()
    got = corpus_pipeline.materialise(run(spark, hard, SF), "test-hard")
    assert spark.conf.get(setting) == before
    out = got.collect()
    assert run(spark, empty, SF).count() == 0
    if stage == "BPE encoding":
        assert order((r["doc_id"], r["decoded_sha256"]) for r in out) == order((r["doc_id"], sha(r["text"] or "")) for r in rows)
        return
    assert got.columns == hard.columns
    if stage == "quality classifier":
        assert set(map(repr, out)) <= set(map(repr, rows)) and out
    elif stage == "line dedup":
        want = brute_lines([(r["doc_id"], r["text"], r["source"]) for r in rows], 5)
        assert order((r["doc_id"], sha(r["text"] or "")) for r in out) == order((d, s) for d, _, _, s in want)
        assert sum(r["text"] is None for r in out) == sum(r["text"] is None for r in rows)
    elif stage == "SimHash near-dedup":
        components = brute_components([(r["doc_id"], brute_simhash(r["text"])) for r in rows])
        assert len(out) == len({c for c in components if c is not None}) + len(
            {brute_simhash(r["text"]) for r, c in zip(rows, components) if c is None})
        assert {c for c in components if c is not None} <= {r["doc_id"] for r in out}
    else:
        times = Counter(map(repr, out))
        assert set(times) <= set(map(repr, rows)) and all(words(r["text"]) for r in out)
        held = Counter(map(repr, rows))
        assert all(n <= 2 * held[k] for k, n in times.items())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLE[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    rows = lambda df: sorted(map(tuple, df[columns].astype(str).values))
    assert rows(got) == rows(want)


def test_all_queries_registered():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names
