"""Operators: keys, dedup, salting, upsert, drifting reads, sinks, contracts."""

import os
import random
import shutil

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bookmart.operators import contracts, frontier, keys, merge, skew
from bookmart.plans import schemas
from bookmart.session import scratch_path
from bookmart.sources import drifting, sinks

from .conftest import rows


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_surrogate_key_equals_global_row_number(spark, parts):   # W1
    rnd = random.Random(parts)
    vals = list({"".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6)))
                 for _ in range(1500)})
    df = spark.createDataFrame([(v,) for v in vals], "s string").repartition(5)
    dist = keys.surrogate_key(df, ["s"], "id", num_partitions=parts)
    glob = df.withColumn("id", F.row_number().over(Window.orderBy("s")))
    assert rows(dist, "s", "id") == rows(glob, "s", "id")
    assert dist.schema["id"].dataType.simpleString() == "bigint"


def test_surrogate_key_with_null_and_int_keys(spark):
    df = spark.createDataFrame([(None,), (5,), (1,), (3,)], "y int")
    got = rows(keys.surrogate_key(df, ["y"], "id", num_partitions=2), "y", "id")
    assert got == [(None, 1), (1, 2), (3, 3), (5, 4)]


def test_one_per_key_nulls_last_and_window_form(spark):   # W2, Q6
    df = spark.createDataFrame([
        ("e1", "w2", 5), ("e1", "w1", None), ("e1", "w1", 3), ("e1", None, 1),
        ("e2", None, None), ("e2", None, 7), (None, "w9", 1), (None, "w8", 2)],
        "k string, w string, n int")
    want = [(None, "w8", 2), ("e1", "w1", 3), ("e2", None, 7)]
    assert rows(keys.one_per_key(df, "k")) == want
    assert rows(keys.one_per_key_agg(df, "k")) == want


def test_salted_agg_equals_plain(spark):   # A5, F19
    data = [("VN", i % 50, float(i)) for i in range(9900)] + \
           [("U_S", i, 1.0) for i in range(60)] + [(None, i, 2.0) for i in range(40)]
    df = spark.createDataFrame(data, "k string, v int, x double")
    aggs = {"n": ("count", "*"), "nd": ("count_distinct", "v"), "s": ("sum", "x"),
            "lo": ("min", "v"), "hi": ("max", "v"), "a": ("avg", "x")}
    salted = skew.salted_agg(df, ["k"], aggs, salts=10)
    plain = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("v").alias("nd"),
                                F.sum("x").alias("s"), F.min("v").alias("lo"),
                                F.max("v").alias("hi"), F.avg("x").alias("a"))
    cols = ["k", "n", "nd", "s", "lo", "hi", "a"]
    assert rows(salted, *cols) == rows(plain, *cols)
    assert dict(rows(salted, "k", "n"))["U_S"] == 60      # key with the separator intact


def test_upsert_semantics(spark):   # J4
    t = spark.createDataFrame([("k1", "a", 1), ("k2", "b", 2), ("k4", "d", 4)], "k string, v string, n int")
    s = spark.createDataFrame([("k1", "a2", 10), ("k2", None, 20), ("k3", "c", 30), ("k3", "c", 31)],
                              "k string, v string, n int")
    out = merge.upsert(t, s, "k")
    assert rows(out) == [("k1", "a2", 10), ("k2", None, 20), ("k3", "c", 30), ("k4", "d", 4)]
    # null keys never match: a null-key target row is kept, a null-key source row inserted
    tn = t.unionByName(spark.createDataFrame([(None, "z", 0)], t.schema))
    sn = s.unionByName(spark.createDataFrame([(None, "y", 9)], s.schema))
    assert (None, "z", 0) in rows(merge.upsert(tn, sn, "k")) and (None, "y", 9) in rows(merge.upsert(tn, sn, "k"))
    # idempotent: applying the same staging again changes nothing
    assert rows(merge.upsert(out, s, "k")) == rows(out)
    # column subset: n is updated, v keeps the target value; a null update sticks
    sub = merge.upsert(t, s, "k", update_cols=["n"])
    assert rows(sub) == [("k1", "a", 10), ("k2", "b", 20), ("k3", "c", 30), ("k4", "d", 4)]


def test_changes_are_appended_and_the_newest_counts(spark):   # D13
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
    root = scratch_path(spark, "t-changes")
    frame = lambda rows_: spark.createDataFrame(rows_, schema)
    assert not merge.is_loaded(spark, root)
    merge.append_changes(frame([(f"k{i}", i) for i in range(3000)]), root, "load", "1")
    size = lambda: sum(f.getLen() for f in _files(spark, root))
    before = size()
    merge.append_changes(frame([("k1", 100), ("new", 1)]), root, "load", "2")
    assert size() - before < before / 4                 # a small batch writes little
    merge.append_changes(frame([("k1", 101)]), root, "load", "2")      # the same load again replaces itself
    got = dict(rows(merge.read_current(spark, root, "k", schema)))
    assert got["k1"] == 101 and got["k2"] == 2 and "new" not in got and len(got) == 3000
    assert rows(merge.read_latest(spark, root, schema)) == [("k1", 101)]
    merge.compact(spark, root, root + "-compact", "k", schema)
    assert dict(rows(merge.read_current(spark, root + "-compact", "k", schema))) == got


def _files(spark, root):
    jvm, out = spark._jvm, []
    path = jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    while found.hasNext():
        out.append(found.next())
    return out


def test_unreadable_tables_are_errors(spark):   # never taken for empty ones
    import pathlib

    import pytest
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
    root = scratch_path(spark, "t-broken")
    merge.append_changes(spark.createDataFrame([("a", 1)], schema), root, "load", "1")
    local = pathlib.Path(root.replace("file:", ""))
    for part in [*local.rglob("loads/*.parquet"), *local.rglob("rows/**/*.parquet")]:
        for x in (part, part.with_name("." + part.name + ".crc")):
            if x.exists():
                x.write_bytes(b"broken")
    with pytest.raises(Exception):
        merge.read_latest(spark, root, schema).count()
    with pytest.raises(Exception):
        merge.read_current(spark, root, "k", schema).count()
    seen = scratch_path(spark, "t-broken-seen")
    frontier.record_seen(spark.createDataFrame([("a",)], "k string"), seen, "k")
    for part in pathlib.Path(seen.replace("file:", "")).rglob("rows/*.parquet"):
        for x in (part, part.with_name("." + part.name + ".crc")):
            if x.exists():
                x.write_bytes(b"broken")
    with pytest.raises(Exception):
        frontier.read_seen(spark, seen, "k").count()


def test_bridge_reload_and_frontier(spark):   # A7, J3
    st = spark.createDataFrame([("w1", 1), ("w1", 1), ("w2", 1)], "work_id string, subject_id int")
    assert rows(merge.bridge_reload(st, ["work_id", "subject_id"])) == [("w1", 1), ("w2", 1)]
    cand = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "key string")
    seen = spark.createDataFrame([("a",)], "key string")
    assert rows(frontier.unseen(cand, seen, "key")) == [("b",), ("c",)]
    assert rows(frontier.add_seen(seen, frontier.unseen(cand, seen, "key"), "key")) == [("a",), ("b",), ("c",)]


def test_read_drifting(spark):   # S1, S2, S3, U1
    root = scratch_path(spark, "t-drift")
    spark.createDataFrame([("a", 1)], "key string, cover_id int").write.parquet(f"{root}/1")
    spark.createDataFrame([(2.0, "b")], "cover_id double, key string").write.parquet(f"{root}/2")
    spark.createDataFrame([("c", "x")], "key string, extra string").write.parquet(f"{root}/3")
    spark.createDataFrame([("d", 4)], "key string, cover_id int").write.parquet(f"{root}/4")
    paths = [f"{root}/{i}" for i in range(1, 5)]
    df = drifting.read_drifting(spark, paths, {"cover_id": "bigint"})
    assert df.schema["cover_id"].dataType.simpleString() == "bigint"
    assert rows(df, "key", "cover_id", "extra") == [
        ("a", 1, None), ("b", 2, None), ("c", None, "x"), ("d", 4, None)]


def test_read_drift_unsuffixed_and_partitioned(spark):   # S1: the files and columns of a plain scan
    root = scratch_path(spark, "t drift=part")
    land = lambda data, schema: spark.createDataFrame(data, schema).coalesce(1).write.mode("append") \
        .partitionBy("day", "zone").parquet(root)
    land([("a", 1, "1", "x y")], "key string, cover_id int, day string, zone string")
    land([("b", 2.0, "2", "a/b")], "key string, cover_id double, day string, zone string")
    land([("c", "3", "late", "x y")], "key string, cover_id string, day string, zone string")
    folder = root.removeprefix("file:")
    for at, _, names in os.walk(folder):
        for name in names:
            if name.startswith("part-") and "day=2" in at:
                shutil.copyfile(f"{at}/{name}", f"{at}/unsuffixed")
    df = drifting.read_drifting(spark, [root], {"cover_id": "bigint"})
    assert rows(df, "key", "cover_id", "day", "zone") == [("a", 1, "1", "x y"), ("b", 2, "2", "a/b"), ("b", 2, "2", "a/b"),
                                                          ("c", 3, "late", "x y")]


def test_read_drift_inside_one_folder(spark):   # S1: files of one append-only landing
    path = scratch_path(spark, "t-drift-one")
    land = lambda data, schema: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
    land([("a", 1)], "key string, cover_id int")
    land([("b", 2, "x")], "key string, cover_id int, extra string")
    assert rows(drifting.read_drifting(spark, [path]), "key", "cover_id", "extra") == [("a", 1, None), ("b", 2, "x")]
    land([(3.0, "c")], "cover_id double, key string")
    land([("d", "4", "y")], "key string, cover_id string, extra string")
    land([("e",)], "key string")
    land([("f", 6)], "key string, cover_id int")
    df = drifting.read_drifting(spark, [path], {"cover_id": "bigint"})
    assert rows(df, "key", "cover_id", "extra") == [("a", 1, None), ("b", 2, "x"), ("c", 3, None), ("d", 4, "y"),
                                                    ("e", None, None), ("f", 6, None)]
    assert len(drifting.group_by_schema(spark, drifting.data_files(spark, [path]))) == 3


def test_null_pad_is_by_name(spark):   # S3, U2
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    x = spark.createDataFrame([(1, "p")], "b bigint, a string")
    y = spark.createDataFrame([("q",)], "a string")
    out = drifting.union_by_name([drifting.null_pad(x, schema), drifting.null_pad(y, schema)])
    assert out.columns == ["a", "b"] and rows(out) == [("p", 1), ("q", None)]


def test_partitioned_write_keeps_other_days(spark):   # S6, Q12
    path = scratch_path(spark, "t-days")
    df = spark.createDataFrame([("x",)], "v string")
    sinks.partitioned_write(df, path, "2025-01-15")
    sinks.partitioned_write(df, path, "2025-01-16")
    sinks.partitioned_write(df, path, "2025-01-16")
    got = rows(spark.read.parquet(path), "v", "year", "month", "day")
    assert got == [("x", 2025, 1, 15), ("x", 2025, 1, 16)]
    assert sinks.read_load_day(spark, path, "2025-01-15").count() == 1
    # static mode (the source job's behaviour) drops the earlier day
    sinks.partitioned_write(df, path, "2025-01-17", dynamic=False)
    assert rows(spark.read.parquet(path), "day") == [(17,)]


def test_batched_landing_file_sizes(spark):   # S11
    import glob
    import os
    path = scratch_path(spark, "t-batches")
    sinks.batched_landing(spark.range(0, 2500).coalesce(1), path, 1000)
    files = glob.glob(os.path.join(path.replace("file:", ""), "*.parquet"))
    assert len(files) == 3 and spark.read.parquet(path).count() == 2500


def test_stage_load_selects_by_name(spark):   # S8, Q18
    path = scratch_path(spark, "t-stage")
    spark.createDataFrame([("Drama", 1)], "subject string, subject_id int").write.parquet(path)
    df = sinks.stage_load(spark, path, schemas.TABLES["dim_subject"])
    assert df.columns == ["subject_id", "subject"] and rows(df) == [(1, "Drama")]


def test_sample_rows_is_deterministic(spark):   # S5, O3
    df = spark.range(100).withColumn("x", F.col("id") % 7).repartition(4)
    assert [r.id for r in sinks.sample_rows(df, 3, ["x", "id"]).collect()] == [0, 7, 14]


def test_contracts(spark):   # C1, C2
    df = spark.createDataFrame([("a", "xx"), ("a", "y"), (None, "zzzz"), ("b", None)], "k string, t string")
    r = contracts.key_report(df, "t1", "k").collect()[0]
    assert (r.n_rows, r.n_null_keys, r.n_dup_keys, r.n_dup_rows) == (4, 1, 1, 2)
    lr = {x.column_name: (x.max_length, x.n_too_long)
          for x in contracts.length_report(df, "t1", {"t": 2, "k": 5}).collect()}
    assert lr == {"t": (4, 1), "k": (1, 0)}


def test_clustered_write_splits_hot_key(spark):   # C3
    path = scratch_path(spark, "t-clustered")
    df = spark.range(4000).select(
        F.when(F.col("id") < 3000, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("w"),
        (F.col("id") % 13).alias("t"), F.col("id").cast("string").alias("e"))
    sinks.clustered_write(df, path, "w", "t", split_key="e", partitions=8)
    back = spark.read.parquet(path)
    assert back.count() == 4000
    per_file = back.groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in per_file) < 3000      # the hot work spans files


def test_surrogate_key_ties_and_hot_value(spark):   # W1 with repeated values
    df = spark.createDataFrame([("a", i) for i in range(500)] + [("b", 1), ("c", 2)], "s string, n int")
    out = keys.surrogate_key(df, ["s"], "id", num_partitions=6)
    got = out.groupBy("s").agg(F.min("id").alias("lo"), F.max("id").alias("hi"),
                               F.count_distinct("id").alias("n")).collect()
    assert sorted((r.s, r.lo, r.hi, r.n) for r in got) == [("a", 1, 500, 500), ("b", 501, 501, 1),
                                                           ("c", 502, 502, 1)]


def test_seen_keys_table(spark):   # S12 + J3 over two rounds
    path = scratch_path(spark, "t-seen")
    assert frontier.read_seen(spark, path, "key").count() == 0
    round1 = spark.createDataFrame([("a",), ("b",), ("a",)], "key string")
    new1 = frontier.unseen(round1, frontier.read_seen(spark, path, "key"), "key")
    frontier.record_seen(new1, path, "key")
    round2 = spark.createDataFrame([("b",), ("c",), (None,)], "key string")
    new2 = frontier.unseen(round2, frontier.read_seen(spark, path, "key"), "key")
    assert rows(new2) == [("c",)]
    frontier.record_seen(new2, path, "key")
    frontier.record_seen(new2, path, "key")          # a replayed append changes nothing
    assert rows(frontier.read_seen(spark, path, "key")) == [("a",), ("b",), ("c",)]


def test_approximate_median_is_close_to_exact(spark):   # A2 approx mode
    from bookmart.plans import jobs
    from .conftest import SF01
    r = jobs.median_approx(spark, SF01).collect()[0]
    assert r.publish_date_within and r.number_of_pages_within


def test_extend_keys_keeps_existing_ids(spark):   # Q7 stable keys
    prev = spark.createDataFrame([(1, "drama"), (2, "poetry")], "subject_id int, subject string")
    vals = spark.createDataFrame([("poetry",), ("art",), ("zoology",), ("art",), ("drama",)], "subject string")
    out = keys.extend_keys(prev, vals, ["subject"], "subject_id")
    assert rows(out, "subject", "subject_id") == [("art", 3), ("drama", 1), ("poetry", 2), ("zoology", 4)]
    # nothing new: the previous keys come back unchanged
    same = keys.extend_keys(prev, vals.filter("subject in ('drama', 'poetry')"), ["subject"], "subject_id")
    assert rows(same, "subject", "subject_id") == [("drama", 1), ("poetry", 2)]
    empty = spark.createDataFrame([], "subject_id int, subject string")
    assert rows(keys.extend_keys(empty, vals, ["subject"], "subject_id"), "subject", "subject_id") == [
        ("art", 1), ("drama", 2), ("poetry", 3), ("zoology", 4)]


def test_extend_keys_takes_one_key_per_value(spark):   # Q7: repeats and nulls in the previous load
    prev = spark.createDataFrame([(4, "drama"), (1, "drama"), (2, None)], "subject_id int, subject string")
    vals = spark.createDataFrame([("drama",), (None,), ("art",)], "subject string")
    assert rows(keys.extend_keys(prev, vals, ["subject"], "subject_id"), "subject", "subject_id") == [
        (None, 2), ("art", 5), ("drama", 1)]


def test_one_per_key_with_a_map_column(spark):
    df = spark.createDataFrame([("k", 2, {"a": "1"}), ("k", 1, {"b": "2"})], "k string, n int, m map<string,string>")
    got = keys.one_per_key(df, "k").collect()
    assert len(got) == 1 and got[0].n == 1 and got[0].m == {"b": "2"}


# --- loads repeated in any order (D13, D14, S6, T2) ------------------------------

KN = "k string, n long"


def _kn():
    from pyspark.sql import types as T
    return T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])


def test_an_older_day_run_again_does_not_win(spark):   # D13
    root = scratch_path(spark, "t-older")
    load = lambda data, day: merge.append_changes(spark.createDataFrame(data, KN), root, "load", day, "k", day)
    now = lambda: rows(merge.read_current(spark, root, "k", _kn()))
    load([("a", 15), ("b", 15)], "2025-01-15")
    load([("a", 16)], "2025-01-16")
    load([("a", 150), ("b", 150)], "2025-01-15")          # a backfill
    assert now() == [("a", 16), ("b", 150)]
    assert rows(merge.read_latest(spark, root, _kn())) == [("a", 16)]
    load([("a", 14), ("c", 14)], "2025-01-14")            # a day that came late
    assert now() == [("a", 16), ("b", 150), ("c", 14)]
    merge.compact(spark, root, root + "-new", "k", _kn())
    merge.append_changes(spark.createDataFrame([("a", 1)], KN), root + "-new", "load", "2025-01-15", "k", "2025-01-15")
    assert rows(merge.read_current(spark, root + "-new", "k", _kn())) == [("a", 16), ("b", 150), ("c", 14)]
    with pytest.raises(ValueError):
        load([("a", 1)], "yesterday")


@pytest.mark.parametrize("key", [None, "k"])
def test_a_batch_replaced_by_none_leaves_no_rows(spark, key):   # D13, D14, T2
    root = scratch_path(spark, "t-empty")
    frame = spark.createDataFrame([("a", 1), ("b", 2)], KN)
    merge.append_changes(frame, root, "load", "1", key)
    merge.append_changes(frame.filter("k = 'a'"), root, "stream", "0", key)
    merge.append_changes(frame.limit(0), root, "load", "1", key)
    assert rows(merge.read_current(spark, root, "k", _kn())) == [("a", 1)]
    merge.append_changes(frame.limit(0), root, "stream", "0", key)
    assert merge.read_current(spark, root, "k", _kn()).count() == 0 and merge.is_loaded(spark, root)
    assert merge.read_latest(spark, root, _kn()).count() == 0


@pytest.mark.parametrize("key", [None, "k"])
def test_a_rerun_that_ends_early_changes_nothing(spark, monkeypatch, key):   # D14
    root = scratch_path(spark, "t-killed")
    frame = spark.createDataFrame([("a", 1), ("b", 2)], KN)
    merge.append_changes(frame, root, "load", "1", key, "2025-01-15")

    def killed(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(merge, "name_attempt", killed)
        merge.append_changes(spark.createDataFrame([("a", 5)], KN), root, "load", "1", key, "2025-01-15")
    want = [("a", 1), ("b", 2)]
    assert rows(merge.read_current(spark, root, "k", _kn())) == want == rows(merge.read_latest(spark, root, _kn()))
    merge.append_changes(spark.createDataFrame([("a", 5)], KN), root, "load", "1", key, "2025-01-15")
    assert rows(merge.read_latest(spark, root, _kn())) == [("a", 5)] == rows(merge.read_current(spark, root, "k", _kn()))


def test_a_day_written_again_without_rows_is_empty(spark):   # S6
    path = scratch_path(spark, "t-empty-day")
    frame = spark.createDataFrame([("a", 1)], KN)
    for day, df in (("2025-01-15", frame), ("2025-01-16", frame), ("2025-01-16", frame.limit(0))):
        sinks.partitioned_write(df, path, day)
    assert rows(spark.read.parquet(path), "k", "n", "day") == [("a", 1, 15)]
    assert sinks.read_load_day(spark, path, "2025-01-16").count() == 0
    sinks.partitioned_write(frame.filter("n > 5").groupBy("k").agg(F.sum("n").alias("n")), path, "2025-01-15")
    assert spark.read.parquet(path).count() == 0 and set(spark.read.parquet(path).columns) >= {"k", "n", "day"}
    sinks.partitioned_write(frame, path, "2025-01-16")
    assert rows(spark.read.parquet(path), "k", "day") == [("a", 16)]


def test_the_current_state_and_seen_keys_do_not_move(spark):   # D13, S12
    root = scratch_path(spark, "t-still")
    wide = spark.range(2000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("n"))
    for day in ("2025-01-15", "2025-01-16"):
        merge.append_changes(wide, root, "load", day, "k", day)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    now = merge.read_current(spark, root, "k", _kn())
    assert "Bucketed: true" in plan(now) and "hashpartitioning(k#" not in plan(now)
    assert now.count() == 2000
    seen = scratch_path(spark, "t-still-seen")
    frontier.record_seen(wide.filter("n < 1500"), seen, "k")
    frontier.record_seen(wide.filter("n < 100"), seen, "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = frontier.unseen(wide, frontier.read_seen(spark, seen, "k"), "k")
        p = plan(new)
        candidates, stored = p.split("Range (")
        assert "LeftAnti" in p and "Exchange" in candidates and "Exchange" not in stored and "Bucketed: true" in stored, p
        assert new.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_folder_keeps_its_layout(spark):
    from bookmart.sources import bucketed
    root = scratch_path(spark, "t-layout")
    frame = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], KN)
    bucketed.append(frame, root, ["k"], 8)
    bucketed.append(frame, root, ["k"], 64)                    # the first rows fixed it
    assert bucketed.layout(spark, root) == (["k"], 8) and bucketed.read(spark, root, _kn()).count() == 6
    with pytest.raises(ValueError):
        bucketed.append(frame, root, ["n"])
    assert bucketed.read_or_empty(spark, root + "-none", _kn()).count() == 0


# --- C2 types, A5 without partial form, A2 across loads ----------------------------

def test_types_are_reported_and_misfits_kept_apart(spark):   # C2
    from pyspark.sql import types as T
    from bookmart.plans import warehouse
    declared = T.StructType([T.StructField("time_id", T.IntegerType()), T.StructField("publish_year", T.IntegerType()),
                             T.StructField("decade", T.IntegerType()), T.StructField("century", T.IntegerType())])
    landed = spark.createDataFrame([("1", "1999", 1990.0, 20), ("2", "undated", 1990.0, 20), ("3", None, 1990.5, 20),
                                    ("x", "12345678901", float("nan"), None), (None, "2000", None, 3000000000)],
                                   "time_id string, publish_year string, decade double, century bigint")
    report = {r["column_name"]: (r["found_type"], r["declared_type"], r["n_values"], r["n_misfits"])
              for r in contracts.type_report(landed, "dim_time", declared).collect()}
    assert report == {"time_id": ("string", "int", 4, 1), "publish_year": ("string", "int", 4, 2),
                      "decade": ("double", "int", 4, 2), "century": ("bigint", "int", 4, 1)}
    assert contracts.type_report(landed.drop("century"), "t", declared).filter("found_type = 'absent'").count() == 1
    root = scratch_path(spark, "t-quarantine")
    warehouse.load_table(root, "dim_time", landed, "2025-01-15")          # ended the load before
    assert rows(warehouse.read_table(spark, root, "dim_time")) == [(1, 1999, 1990, 20)]
    bad = rows(warehouse.read_rejects(spark, root, "dim_time"), "column", "reason", "value")
    assert bad == sorted([("publish_year", "not int", "undated"), ("decade", "not int", "1990.5"), ("time_id", "not int", "x"),
                          ("publish_year", "not int", "12345678901"), ("decade", "not int", "NaN"),
                          ("century", "not int", "3000000000")])
    warehouse.load_table(root, "dim_time", landed.limit(1), "2025-01-15")     # the day again, mended
    assert warehouse.read_rejects(spark, root, "dim_time").count() == 0
    with pytest.raises(ValueError, match="century"):
        warehouse.load_table(root, "dim_time", landed.drop("century"), "2025-01-16")


def test_lengths_are_part_of_the_contract(spark):   # C2
    schema = schemas.TABLES["work_author"]
    df = spark.createDataFrame([("w" * 51, "a"), ("w", "a"), (None, None)], schema)
    good, bad = contracts.split_valid(df, schema, schemas.LENGTHS["work_author"])
    assert rows(good) == [(None, None), ("w", "a")]
    assert [r["reasons"][0]["reason"] for r in bad.collect()] == ["longer than 50"]
    _, bad = contracts.split_valid(df, schema, key="work_id")
    assert [r["reasons"][0]["reason"] for r in bad.collect()] == ["no key"]


def test_salted_aggregates_without_a_partial_form(spark):   # A5
    rnd = random.Random(8)
    data = [("hot", rnd.randrange(5000), rnd.choice("abc")) for _ in range(30_000)] + \
           [("few", i, "z") for i in range(5)] + [(None, 7, "b"), (None, 7, "a"), ("none", None, None)]
    df = spark.createDataFrame(data, "k string, v int, s string")
    q = {r["k"]: (r["lo"], r["mid"]) for r in skew.salted_quantile(df, ["k"], "v", {"lo": 0.1, "mid": 0.5}, salts=8).collect()}
    values = sorted(v for k, v, _ in data if k == "hot")
    for got, share in zip(q["hot"], (0.1, 0.5)):
        below, upto = sum(v < got for v in values), sum(v <= got for v in values)
        assert below <= len(values) * (share + 0.005) and upto >= len(values) * (share - 0.005)
    assert q["few"] == (0, 2) and q["none"] == (None, None) and q[None] == (7, 7)
    counts = {k: sorted(((-sum(1 for a, _, x in data if a == k and x == s)), s) for s in {x for a, _, x in data if a == k and x})
              for k in ("hot", "few", None)}
    mode = {r["k"]: (r["mode"], r["mode_count"]) for r in skew.salted_mode(df, ["k"], "s").collect()}
    assert mode == {**{k: (c[0][1], -c[0][0]) for k, c in counts.items()}, "none": (None, None)}
    sets = {r["k"]: r["values"] for r in skew.salted_set(df, ["k"], "v", salts=8).collect()}
    assert sets == {"hot": sorted(set(values)), "few": list(range(5)), None: [7], "none": None}
    x = skew.salted_quantile(df.withColumn("d", F.col("v") / 2), ["k"], "d", {"m": 0.5}).filter("k = 'few'").first()["m"]
    assert x == 1.0


def test_medians_across_loads_read_no_old_rows(spark):   # A2, A2b
    from bookmart.operators import sketches
    root, land = scratch_path(spark, "t-sketch"), scratch_path(spark, "t-sketch-rows")
    day = {d: spark.createDataFrame([(i,) for i in v], "y int") for d, v in
           (("2025-01-15", [1, 2, 3, 4, 5, None]), ("2025-01-16", [100, None, 101, 102, 103, 104, 105]))}
    for d, df in day.items():
        df.write.parquet(f"{land}/{d}")
        sketches.record(spark.read.parquet(f"{land}/{d}"), root, d, ["y"])
    filled = sketches.fill(spark.read.parquet(f"{land}/2025-01-16"), root, ["y"])
    assert "2025-01-15" not in filled._jdf.queryExecution().toString()
    assert rows(filled)[0] == (100,) and filled.filter("y = 100").count() == 2          # 100 is the 6th of 11
    sketches.record(day["2025-01-15"].filter("y > 3"), root, "2025-01-15", ["y"])       # the day again: replaced
    assert [r["n_values"] for r in sketches.quantiles(spark, root).collect()] == [8]
    sketches.record(day["2025-01-15"].limit(0), root, "2025-01-15", ["y"])
    sketches.record(day["2025-01-15"].limit(0), root, "2025-01-16", ["y"])
    assert sketches.fill(day["2025-01-15"], root, ["y"]).filter("y is null").count() == 1


def test_landing_with_a_manifest_opens_no_file_for_its_schema(spark, monkeypatch):   # S1, S11
    path = scratch_path(spark, "t-manifest")
    for i in range(6):                                         # alternating types
        kind = ("int", "double", "string")[i % 3]
        drifting.land_batch(spark.createDataFrame([(f"k{i}", i), (f"l{i}", None)], f"key string, n {kind}".replace(
            "n double", "n int").replace("n string", "n int")).withColumn("n", F.col("n").cast(kind)), path, 1)
    drifting.land_batch(spark.createDataFrame([("more", "x")], "key string, extra string"), path)
    spark.createDataFrame([("unrecorded", 1)], "key string, n int").write.parquet(f"{path}/half-done")
    def no_look(*_):
        raise AssertionError("a schema job")
    monkeypatch.setattr(drifting, "merged_schema", no_look)
    got = drifting.read_landing(spark, path, {"n": "bigint"})
    want = [(f"k{i}", i, None) for i in range(6)] + [(f"l{i}", None, None) for i in range(6)] + [("more", None, "x")]
    assert rows(got, "key", "n", "extra") == sorted(want, key=lambda t: tuple((x is not None, x) for x in t))
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 4


def test_compaction_packs_the_small_batches_alone(spark, monkeypatch):   # S4
    path = scratch_path(spark, "t-pack")
    large = drifting.land_batch(spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("key"),
                                                           F.col("id").cast("int").alias("n")), path)
    small = [drifting.land_batch(spark.createDataFrame([(f"k{i}{j}", i) for j in range(5)], "key string, n int"), path, 1)
             for i in range(4)]
    lone = drifting.land_batch(spark.createDataFrame([("x", 1.5)], "key string, n double"), path)
    size = {f: sum(x.getLen() for x in _files(spark, f"{path}/{f}")) for f in (large, *small)}
    hashes = lambda: drifting.read_landing(spark, path, {"n": "double"}).agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("key", "n").cast("decimal(38,0)"))).first()
    before = hashes()

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):          # before it is named
        m.setattr(drifting, "_record", killed)
        drifting.compact_landing(spark, path, target_bytes=max(size[f] for f in small) + 1)
    assert hashes() == before
    new = drifting.compact_landing(spark, path, target_bytes=sum(size[f] for f in small) + 1)
    left = {r["folder"] for r in drifting._batches(spark, path).collect()}
    assert len(new) == 1 and left == {large, lone, *new} and hashes() == before
    assert len([f for f in _files(spark, f"{path}/{new[0]}") if f.getPath().getName().endswith(".parquet")]) == 1
    assert drifting.compact_landing(spark, path, target_bytes=1) == [] and hashes() == before
