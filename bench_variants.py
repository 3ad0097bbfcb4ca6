"""Our design choices against their alternatives, at $BENCH_SF_DIR.

Prints one JSON line per comparison: median seconds of $BENCH_RUNS runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bench import CPUS, RUNS, SF_DIR, _session  # noqa: E402


def timed(fn) -> float:
    def once():
        t0 = time.perf_counter()
        out = fn()
        if out is not None:
            out.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0
    once()
    return round(statistics.median(once() for _ in range(RUNS)), 3)


def main():
    from pyspark.sql import functions as F

    from bookmart.operators import keys, merge, profile, skew
    from bookmart.plans import build, clean, fixtures, jobs
    spark = _session()
    sf = SF_DIR
    ed = clean.edition_clean(fixtures.raw_editions(spark, sf)).checkpoint(eager=True)
    ids = ed.select("edition_id").distinct().checkpoint(eager=True)
    res = {}
    res["surrogate_key"] = {
        "distributed": timed(lambda: keys.surrogate_key(ids, ["edition_id"], "k")),
        "global_window": timed(lambda: keys.surrogate_key_global(ids, ["edition_id"], "k")),
        "rows": ids.count()}
    dim = jobs.dim_edition(spark, sf).checkpoint(eager=True)
    res["distinct_count_by_language"] = {
        "salted": timed(lambda: skew.salted_agg(dim, ["language"], {
            "n": ("count", "*"), "d": ("count_distinct", "edition_id")}, salts=16)),
        "plain": timed(lambda: dim.groupBy("language").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("edition_id").alias("d")))}
    parsed = clean.edition_parsed(fixtures.raw_editions(spark, sf)).checkpoint(eager=True)

    def several():
        for one in ("publish_date", "number_of_pages"):
            profile.stats(parsed, [one], exact=False).first()
        profile.null_counts(parsed).first()
    res["stats"] = {
        "one_pass": timed(lambda: profile.stats(parsed, ["publish_date", "number_of_pages"],
                                                null_cols=parsed.columns, exact=False)),
        "one_action_each": timed(several)}
    fact = jobs.fact_book(spark, sf).checkpoint(eager=True)
    prev = jobs.previous_fact_load(spark, sf).checkpoint(eager=True)
    hot = fact.withColumn("edition_id", F.when(F.col("number_of_pages") < 170, F.lit("HOT"))
                          .otherwise(F.col("edition_id"))).checkpoint(eager=True)
    res["one_row_per_key"] = {
        "window_group_limit": timed(lambda: keys.one_per_key(fact, "edition_id")),
        "min_struct_aggregate": timed(lambda: keys.one_per_key_agg(fact, "edition_id")),
        "hot_key_window_group_limit": timed(lambda: keys.one_per_key(hot, "edition_id")),
        "hot_key_min_struct_aggregate": timed(lambda: keys.one_per_key_agg(hot, "edition_id"))}
    def anti_union():
        src = keys.one_per_key(fact, "edition_id").select(*prev.columns)
        return prev.join(fact.select("edition_id"), "edition_id", "left_anti").unionByName(src)
    res["upsert"] = {
        "full_outer": timed(lambda: merge.upsert(prev, fact, "edition_id")),
        "anti_union": timed(anti_union)}
    w, e, a = (fixtures.raw_works(spark, sf), fixtures.raw_editions(spark, sf),
               fixtures.raw_authors(spark, sf))

    def star(mat):
        def run():
            for df in build.build_star(w, e, a, materialise_cleaned=mat).values():
                df.write.format("noop").mode("overwrite").save()
        return run
    res["star_build_8_tables"] = {"materialised_cleaned": timed(star(True)),
                                  "recomputed_cleaned": timed(star(False))}
    for k, v in res.items():
        print(json.dumps({"comparison": k, "sf": sf, "cpus": CPUS, "runs": RUNS, **v}))


if __name__ == "__main__":
    main()
