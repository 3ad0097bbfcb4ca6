"""Command line: the whole job, end to end.

  python -m bookmart build --works DIR [DIR ...] --editions DIR [...] --authors DIR [...]
                           --out DIR --load-date YYYY-MM-DD [--previous WAREHOUSE]
  python -m bookmart load  --built DIR --warehouse DIR [--load-date YYYY-MM-DD]

``build`` reads drifting landing folders, cleans, models and writes the eight
tables, partitioned by load date. ``load`` upserts the keyed tables and reloads
the bridges of one built day (the newest unless named) into a warehouse copy.
With ``--previous`` the build keeps the warehouse's ids. The session comes from the
launcher (spark-submit); its ``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import build, schemas, warehouse
from .session import clear_scratch, get_session
from .sources import drifting, sinks

# Casts applied to every landing before the union (drifting numeric types).
LANDING_TYPES = {
    "works": {"cover_id": "bigint", "edition_count": "bigint"},
    "editions": {"number_of_pages": "bigint"},
    "authors": {},
}


def previous_dimensions(spark: SparkSession, root: str | None) -> dict:
    """The warehouse's current numbered dimensions (for stable ids), if any."""
    out = {}
    for t in ("dim_subject", "dim_time") if root else ():
        try:
            out[t] = warehouse.read_table(spark, root, t)
        except FileNotFoundError:   # first load: nothing to keep
            pass
    return out


def run_build(spark: SparkSession, works: list[str], editions: list[str], authors: list[str],
              out: str, load_date: str, previous: str | None = None) -> dict[str, str]:
    raw = {name: drifting.read_drifting(spark, paths, LANDING_TYPES[name])
           for name, paths in (("works", works), ("editions", editions), ("authors", authors))}
    star = build.build_star(raw["works"], raw["editions"], raw["authors"],
                            previous=previous_dimensions(spark, previous))
    written = {}
    for name, df in star.items():
        path = f"{out.rstrip('/')}/{name}"
        sinks.partitioned_write(df, path, load_date)
        written[name] = path
    return written


def run_load(spark: SparkSession, built: str, root: str, load_date: str | None = None) -> str:
    """Load one built day; returns the day."""
    day = load_date or sinks.newest_load_day(spark, f"{built.rstrip('/')}/dim_work")
    star = {t: sinks.stage_day(spark, f"{built.rstrip('/')}/{t}", schemas.TABLES[t], day)
            for t in schemas.LOAD_ORDER}
    warehouse.load_star(root, star, day)
    return day


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="bookmart")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--works", nargs="+", required=True)
    b.add_argument("--editions", nargs="+", required=True)
    b.add_argument("--authors", nargs="+", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--load-date", required=True)
    b.add_argument("--previous", default=None,
                   help="warehouse folder whose subject / time ids are kept")
    ld = sub.add_parser("load")
    ld.add_argument("--built", required=True)
    ld.add_argument("--warehouse", required=True)
    ld.add_argument("--load-date", default=None)
    for cmd in (b, ld):
        cmd.add_argument("--clear-scratch", action="store_true",
                         help="delete this library's scratch tables under spark.checkpoint.dir afterwards")
    a = p.parse_args(argv)
    spark = get_session(app=f"bookmart-{a.cmd}")
    if a.cmd == "build":
        for name, path in run_build(spark, a.works, a.editions, a.authors, a.out, a.load_date,
                                    a.previous).items():
            print(f"{name}\t{path}")
    else:
        print(run_load(spark, a.built, a.warehouse, a.load_date))
    if a.clear_scratch:
        clear_scratch(spark)


if __name__ == "__main__":
    main()
