"""Streaming: replaying availableNow on one checkpoint adds nothing; the
micro-batch upsert equals the one-shot upsert."""

import glob
import os

from pyspark.sql import functions as F

from bookmart.operators import merge
from bookmart.plans import jobs, schemas
from bookmart.session import scratch_path
from bookmart.streaming import dedup as sd
from bookmart.streaming import upsert as su

from .conftest import SF001, rows


def test_stream_dedup_replay_is_idempotent(spark):   # T1
    schema = spark.read.parquet(f"{SF001}/events.parquet").schema
    out, ck = scratch_path(spark, "t-sd"), scratch_path(spark, "t-sd-ck")
    for _ in range(2):
        s = sd.read_stream(spark, SF001, schema, glob="events.parquet")
        s = s.withColumn("_c", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_c")
        sd.to_parquet(sd.dedup(s, ["event_id"]), out, ck).awaitTermination()
    n = spark.read.parquet(f"{SF001}/events.parquet").count()
    assert spark.read.parquet(out).count() == n


def test_stream_upsert_equals_batch_upsert(spark):   # T2
    got = jobs.stream_upsert(spark, SF001)
    want = jobs.merge_upsert(spark, SF001)
    assert rows(got) == rows(want)


def test_stream_upsert_batches_apply_in_order(spark):
    root = scratch_path(spark, "t-su")
    land = scratch_path(spark, "t-su-land")
    schema = schemas.TABLES["dim_time"]
    spark.createDataFrame([(1, 2000, 2000, 20)], schema).coalesce(1).write.parquet(f"{land}/a")
    spark.createDataFrame([(1, 2001, 2000, 21), (2, 1999, 1990, 20)], schema) \
        .coalesce(1).write.parquet(f"{land}/b")
    su.init_table(spark.createDataFrame([(3, 1000, 1000, 10)], schema), root, "time_id")
    s = sd.read_stream(spark, f"{land}/*", schema, max_files=1)
    su.start_upsert(s, root, "time_id", scratch_path(spark, "t-su-ck")).awaitTermination()
    now = lambda: rows(merge.read_current(spark, root, "time_id", schema))
    assert now() == [(1, 2001, 2000, 21), (2, 1999, 1990, 20), (3, 1000, 1000, 10)]
    # a batch load and a stream with a fresh checkpoint share the table
    merge.append_changes(spark.createDataFrame([(3, 1003, 1000, 11)], schema), root, "load", "1", "time_id")
    spark.createDataFrame([(4, 1500, 1500, 15)], schema).coalesce(1).write.parquet(f"{land}2/c")
    s = sd.read_stream(spark, f"{land}2/*", schema, max_files=1)
    su.start_upsert(s, root, "time_id", scratch_path(spark, "t-su-ck2")).awaitTermination()
    assert now() == [(1, 2001, 2000, 21), (2, 1999, 1990, 20), (3, 1003, 1000, 11), (4, 1500, 1500, 15)]


def test_watermark_dedup_forgets_old_keys(spark):   # T1, bounded state
    import datetime as dt
    land = scratch_path(spark, "t-wm-land")
    schema = "event_id bigint, ts timestamp_ntz"
    h = lambda x: dt.datetime(2025, 1, 1, *x)
    batches = [[(1, h((10, 0))), (2, h((12, 0)))],
               [(2, h((12, 10))), (3, h((15, 0)))],          # 2 repeats within the delay
               [(1, h((15, 30)))]]                           # 1 comes back after its state expired
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(f"{land}/b{i}")
    out, ck = scratch_path(spark, "t-wm-out"), scratch_path(spark, "t-wm-ck")
    s = sd.read_stream(spark, f"{land}/*", spark.createDataFrame([], schema).schema, max_files=1)
    sd.to_parquet(sd.dedup(s, ["event_id"], event_time="ts", delay="1 hour"), out, ck).awaitTermination()
    got = sorted(r.event_id for r in spark.read.parquet(out).collect())
    assert got == [1, 1, 2, 3]
    # the exact (unbounded) mode never emits a key twice
    out2, ck2 = scratch_path(spark, "t-ex-out"), scratch_path(spark, "t-ex-ck")
    s2 = sd.read_stream(spark, f"{land}/*", spark.createDataFrame([], schema).schema, max_files=1)
    sd.to_parquet(sd.dedup(s2, ["event_id"]), out2, ck2).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out2).collect()) == [1, 2, 3]


def test_stored_dedup_holds_no_keys_and_replays(spark, monkeypatch):   # T1
    land, root, ck = (scratch_path(spark, f"t-st-{x}") for x in ("land", "root", "ck"))
    kind = "event_id bigint, v string"
    schema = spark.createDataFrame([], kind).schema
    batches = [[(1, "a"), (1, "a"), (None, "n")], [(1, "b"), (2, "c")], [(None, "m"), (3, "d"), (2, "e")]]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, kind).coalesce(1).write.parquet(f"{land}/b{i}")
    run = lambda ck_: sd.start_stored_dedup(sd.read_stream(spark, f"{land}/*", schema, max_files=1), root,
                                            ["event_id"], ck_).awaitTermination()
    run(ck)
    want = rows(sd.read_deduped(spark, root, schema))
    assert [r[0] for r in want] == [None, 1, 2, 3]
    assert not glob.glob(ck.replace("file:", "") + "/state/*")           # no state store at all
    # the last micro-batch again, as after a failure before its commit entry
    for name in ("2", ".2.crc"):
        os.remove(f"{ck.replace('file:', '')}/commits/{name}")
    run(ck)
    assert rows(sd.read_deduped(spark, root, schema)) == want
    run(scratch_path(spark, "t-st-ck2"))                                  # another stream adds nothing
    assert rows(sd.read_deduped(spark, root, schema)) == want


def test_batch_is_spread_before_it_is_sorted(spark):   # T1
    rows_ = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "k int, v string")
    new = sd.new_rows(rows_, rows_.filter("k = 2"), ["k"])
    assert "REBALANCE_PARTITIONS" in new._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, new.collect()), key=str) == [(1, "a"), (None, "c")]
