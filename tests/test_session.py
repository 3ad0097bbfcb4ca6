"""Session helpers: scratch space under spark.checkpoint.dir, sizing."""

from bookmart import session

from .conftest import rows


def test_scratch_paths_are_unique_and_under_the_checkpoint_root(spark):
    root = session.checkpoint_root(spark)
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/")) and b.startswith(root.rstrip("/"))


def test_materialise_round_trip(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    m = session.materialise(df, "t-mat")
    assert rows(m) == rows(df)
    assert "FileScan parquet" in m._jdf.queryExecution().executedPlan().toString()


def test_scale_conf_sizes_partitions():
    small = session.scale_conf(1024)
    assert small["spark.sql.shuffle.partitions"] == "200"
    big = session.scale_conf(100 * 1024 ** 4)          # 100 TB of shuffle
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2)
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 ** 2)


def test_scratch_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_root", lambda _: str(tmp_path))
    df = session.materialise(spark.range(3), "t-clear")
    assert df.count() == 3 and list(tmp_path.glob("bookmart/t-clear-*"))
    session.clear_scratch(spark)
    assert not (tmp_path / "bookmart").exists()
