"""Plan shape: the physical strategies the design relies on."""

import re

import pytest
from pyspark.sql import functions as F

from bookmart.operators import keys
from bookmart.plans import clean, fixtures, jobs

from .conftest import SF001, rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_distributed_key_has_no_single_partition_on_data_path(spark):   # W1
    df = spark.range(1000).select((F.col("id") * 7 % 1000).cast("string").alias("s")).distinct()
    out = keys.surrogate_key(df, ["s"], "id")
    p = plan(out)
    # the only single-partition exchange is the per-partition count (one row
    # per partition), never the data itself
    assert p.count("SinglePartition") <= 1
    glob = plan(keys.surrogate_key_global(df, ["s"], "id"))
    assert "SinglePartition" in glob


def test_fact_book_broadcasts_time(spark):   # J2
    p = plan(jobs.fact_book(spark, SF001))
    assert "BroadcastHashJoin" in p and "LeftOuter" in p


def test_no_python_udf_anywhere(spark):
    for name, fn in jobs.JOBS.items():      # what a job writes on the way is covered by the source check below
        p = plan(fn(spark, SF001))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in p, (name, node)


def test_scan_prunes_columns(spark):
    p = plan(jobs.dim_author(spark, SF001))
    assert "ReadSchema: struct<s_suppkey:bigint,s_name:string,s_nationkey:int>" in p


def test_dedup_reduces_keys_before_the_shuffle(spark):   # W2 under skew
    df = spark.createDataFrame([("k", i, "x") for i in range(100)], "k string, n int, v string")
    p = plan(keys.one_per_key(df, "k"))
    # a WindowGroupLimit sits below the exchange (map side) and above it
    below = p.split("Exchange hashpartitioning")[1]
    assert p.count("WindowGroupLimit") == 2 and "WindowGroupLimit" in below
    assert "partial_min" in plan(keys.one_per_key_agg(df, "k"))


def test_library_has_no_python_udf_or_rdd_transformations():
    import pathlib
    import re
    root = pathlib.Path(__file__).resolve().parent.parent / "bookmart"
    banned = re.compile(r"\b(udf|pandas_udf|mapInPandas|applyInPandas|mapInArrow|localCheckpoint)\b"
                        r"|\.rdd\.(map|flatMap|mapPartitions|foreach|collect)\b|\.collect\(\)")
    hits = [f"{p.name}:{i}" for p in root.rglob("*.py") if "llm" not in p.parts
            for i, line in enumerate(p.read_text().splitlines(), 1) if banned.search(line)]
    assert not hits, hits


def test_flagship_reads_its_raw_table_once(spark):   # D10
    p = plan(jobs.fact_book(spark, SF001))
    assert "lineitem.parquet" not in p and "InMemoryTableScan" not in p      # one written copy of the parsed rows


def test_flagship_is_wide_after_a_narrow_scan(spark):   # D10: one row group in, several tasks from there on
    e = jobs._editions(spark, SF001.replace("0.001", "0.01"), jobs.FACT)
    assert e.columns == jobs.FACT
    from bookmart.plans import clean, fixtures
    parsed = clean.edition_parsed(fixtures.raw_editions(spark, SF001), jobs.FACT)
    p = plan(parsed)
    assert "rebalance" in p.lower() and "isbn" not in p and "languages" not in p


@pytest.mark.parametrize("raw, columns", [(fixtures.raw_editions, ["key", "title", "publishers"]), (fixtures.raw_works, ["key", "title"])])
def test_spread_holds_no_split_in_memory(spark, raw, columns):   # S4, W1: rows dealt out in turn are sorted first
    from bookmart.plans import clean
    df = raw(spark, SF001).select(*columns)
    df = df.unionByName(df.limit(50)).unionByName(df.select(*[F.lit(None).cast("string").alias(c) for c in columns]).limit(3))
    p = plan(clean.spread(df))
    assert "RoundRobin" not in p and "REBALANCE_PARTITIONS_BY_COL" in p
    assert rows(clean.spread(df)) == rows(df)


def test_scans_are_neither_cached_nor_spread(spark):
    p = plan(jobs.dim_author(spark, SF001))
    assert "InMemoryTableScan" not in p and "RoundRobin" not in p


def test_bucketed_tables_join_without_exchange(spark):   # C3
    from bookmart.session import scratch_path
    from bookmart.sources import sinks
    f = spark.range(3000).select((F.col("id") % 300).cast("string").alias("work_id"),
                                 (F.col("id") % 7).alias("time_id"))
    d = spark.range(300).select(F.col("id").cast("string").alias("work_id"), F.lit("t").alias("title"))
    ft = sinks.bucketed_write(f, "t_fact_by_work", scratch_path(spark, "tf"), "work_id", "time_id", 8)
    dt = sinks.bucketed_write(d, "t_work_by_work", scratch_path(spark, "tw"), "work_id", None, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(ft.join(dt, "work_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and "Exchange" not in p, p
    assert ft.join(dt, "work_id").count() == 3000


def test_hot_works_join_in_place(spark):   # C3
    from bookmart.session import scratch_path
    from bookmart.sources import bucketed, sinks
    work = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 11 == 1, F.lit(None)).when(
        F.col("id") % 11 == 2, F.lit("")).otherwise(F.concat(F.lit("w"), F.col("id") % 300))
    fact = spark.range(9000).select(F.col("id").alias("edition_id"), work.alias("work_id"))
    dim = spark.range(300).select(F.concat(F.lit("w"), "id").alias("work_id"), F.lit("t").alias("title")).unionByName(
        spark.createDataFrame([("hot", "h"), ("", "e"), (None, "n")], "work_id string, title string"))
    limit, n = 400, 23
    hot = bucketed.hot_keys(fact, "work_id", limit)
    assert {r["work_id"]: r["parts"] for r in hot.collect()} == {"hot": 8, "": 2}
    by = ["work_id", bucketed.SALT]
    sides = [bucketed.salted(fact, "work_id", hot, n), bucketed.replicated(dim, "work_id", hot)]
    assert sides[0].count() == 9000 and sides[1].count() == 303 + 7 + 1
    largest = bucketed.largest_bucket(sides[0], by, n).first()["largest"]
    assert largest < 4 * limit < bucketed.largest_bucket(fact, ["work_id"], n).first()["largest"]
    ft, dt = [sinks.bucketed_write(df, f"t_hot_{i}", scratch_path(spark, f"hot{i}"), by, "work_id", n) for i, df in enumerate(sides)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left"):
            joined = bucketed.co_located(ft, dt, "work_id", how)
            p = plan(joined)
            assert "SortMergeJoin" in p and "Exchange" not in p, p
            want = fact.join(dim, "work_id", how)
            assert sorted(joined.select("edition_id", "work_id", "title").collect(), key=str) == \
                sorted(want.select("edition_id", "work_id", "title").collect(), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_fact_has_buckets_for_its_size(spark, monkeypatch):   # C3
    few = jobs.bucketed_fact(spark, SF001)
    n = few.count()
    monkeypatch.setattr(jobs, "BUCKET_ROWS", max(1, n // 20))
    many = jobs.bucketed_fact(spark, SF001)
    assert many.count() == n
    assert len(few.inputFiles()) <= 16 < len(many.inputFiles()) <= -(-n // max(1, n // 20))


def test_spread_streams_rows_whatever_the_shuffle_partitions(spark):   # D1, D2: no map task holds its split
    df = spark.range(3000).select((F.col("id") % 700).alias("a"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("b"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, want in ((7, 7), (300, 200)):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            for out in (clean.spread(df), clean.edition_parsed(fixtures.raw_editions(spark, SF001), jobs.DIMENSION)):
                assert re.search(rf"Exchange hashpartitioning\(.*, {want}\), REBALANCE_PARTITIONS_BY_COL", plan(out))
            assert rows(clean.spread(df)) == rows(df)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_language_is_parsed_per_edition_and_filled_texts_not_at_all(spark):   # D8
    p = plan(jobs.dim_edition(spark, SF001))
    above = p[:p.index("Generate")]
    assert "from_json" not in above and "languages" not in above
    assert "from_json(ArrayType(StringType,true), publishers" not in p     # the filled-in constant is no JSON


def test_distinct_of_editions_has_tasks_for_its_rows(spark, monkeypatch):   # D8: rows of a task are bounded at any size
    from bookmart.plans import model
    monkeypatch.setattr(keys, "TASK_ROWS", 500)
    i = F.col("id") % 18000                    # 2,000 rows come twice
    e = spark.range(20000).select(
        F.when(i % 7 > 0, F.concat(F.lit("OL"), i, F.lit("M"))).alias("edition_id"), F.concat(F.lit("t"), i).alias("title"),
        F.when(i % 5 > 0, i.cast("int")).alias("publish_date"), F.when(i % 3 > 0, F.lit('["some press."]')).otherwise('["other press."]').alias("publishers"),
        F.when(i % 2 > 0, F.lit("unknown")).otherwise('[{"key":"/languages/eng"}]').alias("languages"))
    got = model.dim_edition(e, rows=20000)
    assert rows(got) == rows(model.dim_edition(e)) and got.count() == 18000
    held = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert held < 2 * 500
    n = jobs._parsed_editions(spark, SF001, jobs.DIMENSION).count()
    monkeypatch.setattr(keys, "TASK_ROWS", n // 30)
    assert re.search(r"Exchange hashpartitioning\(.*, 3[01]\), REPARTITION_BY_NUM", plan(jobs.dim_edition(spark, SF001)))


def test_copies_of_one_row_are_one_row(spark, monkeypatch):   # D8 over a row that comes very often
    monkeypatch.setattr(keys, "TASK_ROWS", 100)
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("a"), F.lit(None).cast("string").alias("b"))
    assert rows(keys.distinct_rows(df, 5000)) == rows(df.distinct())
    assert keys.distinct_rows(df.limit(0), 0).count() == 0


def test_files_of_parsed_editions_are_bounded(spark, monkeypatch):   # D8: and the rows of a task that reads them
    monkeypatch.setattr(jobs, "PARSED_FILE_ROWS", 300)
    parsed = jobs._parsed_editions(spark, SF001, jobs.DIMENSION)
    assert parsed.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] == 300


@pytest.mark.parametrize("job", ["compact_write", "surrogate_key"])
def test_jobs_over_dim_edition_count_their_rows(spark, monkeypatch, job):   # S4, W1
    seen, plain = [], keys.distinct_rows
    monkeypatch.setattr(keys, "distinct_rows", lambda df, n: seen.append(n) or plain(df, n))
    jobs.JOBS[job](spark, SF001)
    assert seen == [fixtures.raw_editions(spark, SF001).count()]
