"""D12 whole build and D13/D14 warehouse load, end to end at sf0.001."""

from pyspark.sql import functions as F

from bookmart.plans import build, fixtures, jobs, schemas, warehouse
from bookmart.session import scratch_path

from .conftest import SF001, rows


def test_build_star_matches_single_jobs_and_keys_hold(spark):
    star = build.build_star(fixtures.raw_works(spark, SF001), fixtures.raw_editions(spark, SF001),
                            fixtures.raw_authors(spark, SF001))
    assert set(star) == set(schemas.TABLES)
    for name in ("dim_time", "fact_book", "work_subject", "dim_subject", "dim_author"):
        assert rows(star[name]) == rows(jobs.JOBS[name](spark, SF001)), name
    # every bridge / fact id exists in its dimension
    subj = {r.subject_id for r in star["dim_subject"].collect()}
    assert {r.subject_id for r in star["work_subject"].collect()} <= subj
    times = {r.time_id for r in star["dim_time"].collect()}
    assert {r.time_id for r in star["fact_book"].collect()} - {None} <= times
    for name, df in star.items():
        got = [(f.name, f.dataType) for f in df.schema.fields]
        assert got == [(f.name, f.dataType) for f in schemas.TABLES[name].fields], name


def test_warehouse_load_is_idempotent(spark):
    star = build.build_star(fixtures.raw_works(spark, SF001), fixtures.raw_editions(spark, SF001),
                            fixtures.raw_authors(spark, SF001), materialise_cleaned=False)
    root = scratch_path(spark, "t-wh")
    loaded = warehouse.load_star(root, star, "2025-01-15")
    first = {t: rows(warehouse.read_table(spark, root, t)) for t in loaded}
    warehouse.load_star(root, star, "2025-01-16")
    for t in loaded:
        assert rows(warehouse.read_table(spark, root, t)) == first[t], t
    # keyed tables hold one row per key after the load
    for t, k in schemas.KEYS.items():
        if k:
            df = warehouse.read_table(spark, root, t)
            assert df.count() == df.select(k).distinct().count(), t


def test_command_line_build_and_load(spark):
    from bookmart.__main__ import run_build, run_load
    land = scratch_path(spark, "t-cli-land")
    paths = {}
    for name, df in (("works", fixtures.raw_works(spark, SF001)),
                     ("editions", fixtures.raw_editions(spark, SF001)),
                     ("authors", fixtures.raw_authors(spark, SF001))):
        paths[name] = [f"{land}/{name}/b0", f"{land}/{name}/b1"]
        half = df.randomSplit([0.5, 0.5], seed=3)
        for p, part in zip(paths[name], half):
            part.write.parquet(p)
    out = scratch_path(spark, "t-cli-out")
    written = run_build(spark, paths["works"], paths["editions"], paths["authors"], out, "2025-01-15")
    assert set(written) == set(schemas.TABLES)
    fact = spark.read.parquet(written["fact_book"]).drop("year", "month", "day")
    assert rows(fact) == rows(jobs.fact_book(spark, SF001))
    wh = scratch_path(spark, "t-cli-wh")
    assert run_load(spark, out, wh) == "2025-01-15"
    assert rows(warehouse.read_table(spark, wh, "dim_time")) == \
        rows(jobs.dim_time(spark, SF001))
    # a second build against the loaded warehouse keeps its ids
    run_build(spark, paths["works"], paths["editions"], paths["authors"], out, "2025-01-16", wh)
    again = spark.read.parquet(f"{out}/dim_subject").filter("day = 16")
    assert rows(again.select("subject_id", "subject")) == rows(warehouse.read_table(spark, wh, "dim_subject"))
    # the load takes the newest day alone
    assert run_load(spark, out, wh) == "2025-01-16"
    assert rows(warehouse.read_table(spark, wh, "work_subject")) == rows(jobs.work_subject(spark, SF001))


def test_rebuild_keeps_ids_with_previous_dimensions(spark):   # Q7 across runs
    w, e, a = (fixtures.raw_works(spark, SF001), fixtures.raw_editions(spark, SF001),
               fixtures.raw_authors(spark, SF001))
    first = build.build_star(w, e, a, materialise_cleaned=False)
    # the previous load knew every other subject only, with its own ids
    prev_subject = first["dim_subject"].filter("subject_id % 2 = 0").select(
        (F.col("subject_id") * 10).alias("subject_id"), "subject")
    prev_time = first["dim_time"].filter("time_id = 3").select(
        F.lit(100).alias("time_id"), "publish_year", "decade", "century")
    second = build.build_star(w, e, a, materialise_cleaned=False,
                              previous={"dim_subject": prev_subject, "dim_time": prev_time})
    s2 = dict(rows(second["dim_subject"], "subject", "subject_id"))
    for subj, sid in rows(prev_subject, "subject", "subject_id"):
        assert s2[subj] == sid                       # existing ids kept
    assert len(s2) == first["dim_subject"].count()   # every subject present once
    assert len(set(s2.values())) == len(s2)          # ids unique
    t2 = rows(second["dim_time"], "publish_year", "time_id")
    year3 = [y for y, t in rows(first["dim_time"], "publish_year", "time_id") if t == 3][0]
    assert dict(t2)[year3] == 100 and len(t2) == first["dim_time"].count()
    # bridges and facts use the stable ids
    assert {r.subject_id for r in second["work_subject"].collect()} <= set(s2.values())
    assert {r.time_id for r in second["fact_book"].collect()} - {None} <= {t for _, t in t2}


def test_first_load_of_a_keyed_table_stores_its_rows_once(spark, monkeypatch):   # D13
    from bookmart.plans import warehouse
    from bookmart.session import materialise, scratch_path
    from bookmart.sources import bucketed
    monkeypatch.setattr(bucketed, "materialise", None)          # a second copy, only to be counted, would need it
    d = materialise(spark.createDataFrame([("e1", "t", 1999, "p", None), ("e1", "a", 1999, "p", None), ("e2", "b", None, "q", "x")],
                                          "edition_id string, title string, publish_date int, publisher string, language string"), "d")
    root = scratch_path(spark, "stored-once")
    for day in ("2025-01-15", "2025-01-16"):
        warehouse.load_table(root, "dim_edition", d, day)
    got = warehouse.read_table(spark, root, "dim_edition").select("edition_id", "title").collect()
    assert sorted(map(tuple, got)) == [("e1", "a"), ("e2", "b")]
