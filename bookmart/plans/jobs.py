"""Registered jobs: each takes (spark, sf_dir) and returns a DataFrame.

They read the driver tables of one scale-factor folder (through the raw
views of ``fixtures``), so their work grows with the data.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import catalogue as C
from ..functions import jsoncols as J
from ..functions import text as X
from ..operators import contracts, frontier, impute, keys, merge, profile, sketches, skew
from ..session import PARSED_FILE_ROWS, PARSED_ROW_GROUP, materialise, scratch_path
from ..sources import bucketed, drifting, landing, sinks
from ..streaming import dedup as sdedup
from ..streaming import upsert as supsert
from . import build, clean, model, schemas, warehouse
from .fixtures import raw_authors, raw_editions, raw_works, read_table


def _works(spark, sf):
    return clean.explode_works(_work_level(spark, sf))


TIME, FACT = ["title", "publish_date"], ["edition_id", "work_id", "title", "publish_date", "number_of_pages"]
DIMENSION = ["edition_id", "title", "publish_date", "publishers", "languages"]


def _parsed_editions(spark, sf, columns=None):
    """Editions over one scan and one parse: the parsed rows, with the columns of
    the job, are written once and read for the medians, for their number and for
    what is made of them."""
    parsed = clean.edition_parsed(raw_editions(spark, sf), columns)
    return materialise(parsed, "edition-parsed", PARSED_ROW_GROUP, PARSED_FILE_ROWS)


def _editions(spark, sf, columns=None):
    return clean.edition_filled(_parsed_editions(spark, sf, columns))


def _authors(spark, sf):
    return clean.author_clean(raw_authors(spark, sf))


# --- D1-D11 ------------------------------------------------------------------

def work_clean(spark: SparkSession, sf: str) -> DataFrame:
    return _works(spark, sf)


def edition_clean(spark, sf):
    return _editions(spark, sf)


def author_clean(spark, sf):
    return _authors(spark, sf)


def _work_level(spark, sf):
    parsed = materialise(clean.work_parsed(raw_works(spark, sf)), "work-parsed", PARSED_ROW_GROUP)
    return clean.work_filled(parsed)


def dim_work(spark, sf):
    return model.dim_work(_work_level(spark, sf))


def dim_subject(spark, sf):
    return model.dim_subject(_works(spark, sf))


def work_subject(spark, sf):
    w = _works(spark, sf)
    return model.work_subject(w, model.dim_subject(w))


def work_author(spark, sf):
    return model.work_author(_work_level(spark, sf))


def dim_edition(spark, sf):
    parsed = _parsed_editions(spark, sf, DIMENSION)
    return model.dim_edition(clean.edition_filled(parsed), rows=parsed.count())


def dim_time(spark, sf):
    return model.dim_time(_editions(spark, sf, TIME))


def fact_book(spark, sf):
    e = _editions(spark, sf, FACT)
    return model.fact_book(e, model.dim_time(e))


def dim_author(spark, sf):
    return model.dim_author(_authors(spark, sf))


# --- S1-S3, U1, U2: drifting landings -----------------------------------------

def read_drifting(spark, sf):
    """Works landed by append in ONE folder: cover_id as int (twice, once with an
    extra column), as double with the columns in another order, and absent;
    read back as one table with every column and row."""
    w = raw_works(spark, sf)
    g = F.col("edition_count") % 4
    cover = F.col("edition_count") * 7
    path = scratch_path(spark, "landing-works")
    for i in range(4):
        part = w.filter(g == i)
        if i in (0, 1):
            part = part.withColumn("cover_id", cover.cast("int"))
        if i == 1:
            part = part.withColumn("extra", F.upper("title"))
        elif i == 2:
            part = part.withColumn("cover_id", cover.cast("double"))
            part = part.select(*reversed(part.columns))
        part.write.mode("append").parquet(path)
    return drifting.read_drifting(spark, [path], {"cover_id": "bigint"})


def manifest_landing(spark, sf):
    """Works landed in eight batches whose cover_id is int, double and
    absent in turn, read back by the schemas recorded with the batches."""
    w, path = raw_works(spark, sf), scratch_path(spark, "landing-manifest")
    cover = F.col("edition_count") * 7
    for i in range(8):
        part = w.filter(F.col("edition_count") % 8 == i)
        kind = ("int", "double", None)[i % 3]
        drifting.land_batch(part.withColumn("cover_id", cover.cast(kind)) if kind else part, path, C.LANDING_BATCH_EDITIONS)
    return drifting.read_landing(spark, path, {"cover_id": "bigint"})


def compacted_landing(spark, sf):
    """Works landed in one large and seven small batches of two schemas; the
    small ones are packed, and all rows are read back."""
    w, path = raw_works(spark, sf), scratch_path(spark, "landing-compacted")
    drifting.land_batch(w.filter(F.col("edition_count") % 2 == 0), path)
    for i in range(7):
        part = w.filter((F.col("edition_count") % 2 == 1) & (F.col("edition_count") % 7 == i))
        drifting.land_batch(part if i % 2 else part.drop("authors"), path, C.LANDING_BATCH_EDITIONS)
    drifting.compact_landing(spark, path)
    return drifting.read_landing(spark, path)


def harmonise_types(spark, sf):
    """Editions landed in one folder with number_of_pages as int, double and
    text."""
    e = raw_editions(spark, sf)
    g = F.length("key") % 3
    path = scratch_path(spark, "landing-editions")
    for i, t in enumerate(["int", "double", "string"]):
        e.filter(g == i).withColumn("number_of_pages", F.col("number_of_pages").cast(t)) \
            .write.mode("append").parquet(path)
    return drifting.read_drifting(spark, [path], {"number_of_pages": "bigint"})


def null_pad_union(spark, sf):
    """Two record shapes, padded to the declared raw works schema by name."""
    w = raw_works(spark, sf)
    even = F.col("edition_count") % 2 == 0
    a = w.filter(even).select("key", "title", "subject")
    b = w.filter(~even).select("authors", "key", "edition_count", "title")
    schema = w.schema
    return drifting.union_by_name([drifting.null_pad(a, schema), drifting.null_pad(b, schema)])


# --- S4-S8, S11, C3: sinks (written, then read back) ----------------------------

def compact_write(spark, sf):
    path = sinks.compact_write(dim_edition(spark, sf), scratch_path(spark, "dim_edition"))
    return spark.read.parquet(path)


def sample_rows(spark, sf):
    return sinks.sample_rows(dim_work(spark, sf), 5)


def partitioned_write(spark, sf):
    """dim_work written for two load days; the second write keeps the first."""
    path = scratch_path(spark, "dim_work")
    d = dim_work(spark, sf)
    sinks.partitioned_write(d, path, "2025-01-15")
    sinks.partitioned_write(d, path, "2025-01-16")
    return spark.read.parquet(path)


def fact_write(spark, sf):
    path = sinks.fact_write(fact_book(spark, sf), scratch_path(spark, "fact_book"))
    return spark.read.parquet(path)


def stage_load(spark, sf):
    """dim_subject is written (subject, subject_id) and staged by name."""
    path = scratch_path(spark, "dim_subject_staging")
    dim_subject(spark, sf).select("subject", "subject_id").write.parquet(path)
    return sinks.stage_load(spark, path, schemas.TABLES["dim_subject"])


def batched_landing(spark, sf):
    path = sinks.batched_landing(raw_editions(spark, sf), scratch_path(spark, "editions"),
                                 C.LANDING_BATCH_EDITIONS)
    return spark.read.parquet(path)


def clustered_write(spark, sf):
    path = sinks.clustered_write(fact_book(spark, sf), scratch_path(spark, "fact_clustered"),
                                 "work_id", "time_id", split_key="edition_id")
    return spark.read.parquet(path)


BUCKET_ROWS = 1 << 20        # rows of a bucket, about


def bucketed_fact(spark, sf):
    """C3 with bucketing: fact_book stored bucketed by its own key, sorted by
    time_id, in as many buckets as its size needs. Null and empty work ids would
    share one bucket; edition ids do not repeat much, so this layout is not
    co-located by work, which is left to ``clustered_write``. Rows are dealt by
    bucket before the write, so each bucket is one file."""
    fact = materialise(fact_book(spark, sf), "fact-to-bucket")
    buckets = max(16, -(-fact.count() // BUCKET_ROWS))
    name = f"fact_book_by_edition_{uuid.uuid4().hex[:8]}"
    return sinks.bucketed_write(fact.repartition(buckets, "edition_id"), name,
                                scratch_path(spark, name), "edition_id", "time_id", buckets=buckets)


def work_co_located(spark, sf):
    """C3 by work: facts and works stored in as many buckets by (work, salt);
    works that hold more than a bucket's rows are cut in parts and their dimension
    rows repeated for each. The facts with their work's title, joined in place."""
    fact, work = materialise(fact_book(spark, sf), "fact-by-work"), materialise(dim_work(spark, sf), "work-by-work")
    buckets = max(16, -(-fact.count() // BUCKET_ROWS))
    hot = materialise(bucketed.hot_keys(fact, "work_id", BUCKET_ROWS), "hot-works")
    tag, by = uuid.uuid4().hex[:8], ["work_id", bucketed.SALT]
    sides = {"fact": bucketed.salted(fact, "work_id", hot, buckets), "work": bucketed.replicated(work, "work_id", hot)}
    stored = [sinks.bucketed_write(df.repartition(buckets, *by), f"{name}_by_work_{tag}", scratch_path(spark, f"{name}_by_work"),
                                   by, "work_id", buckets) for name, df in sides.items()]
    return bucketed.co_located(*stored, "work_id").select("edition_id", "work_id", "time_id", "title")


# --- S9, S10, F21, J3: landing ---------------------------------------------------

def explode_response(spark, sf):
    """Works grouped into 50-record response pages, landed as JSON lines, read
    back with a declared schema and exploded into records."""
    recs = raw_works(spark, sf, keep_id=True)
    pages = landing.pages_of(recs, "works", 50, "_pk")
    path = scratch_path(spark, "responses")
    pages.select(F.to_json(F.struct("page", "works")).alias("value")).write.text(path)
    record = raw_works(spark, sf).schema
    schema = T.StructType([T.StructField("page", T.LongType()),
                           T.StructField("works", T.ArrayType(record))])
    return landing.explode_response(landing.read_responses(spark, path, schema), "works")


def page_shapes(spark, sf):
    """Works in pages of three shapes, landed with cut pages and pages of
    another shape among them; all records by one reader, and the rejects."""
    recs = raw_works(spark, sf, keep_id=True)
    pages = landing.pages_of(recs, "records", 50, "_pk")
    shape = F.element_at(F.array(*map(F.lit, landing.PAGE_LISTS)), (F.col("page") % 3 + 1).cast("int"))
    body = F.to_json(F.struct("page", F.col("records").alias("_list")))
    text = F.replace(body, F.lit('"_list":'), F.concat(F.lit('"'), shape, F.lit('":')))
    lines = F.array_compact(F.array(text, F.when(F.col("page") % 7 == 0, F.left(text, F.length(text) - 5)),
                                    F.when(F.col("page") % 11 == 0, F.lit('{"size": 0, "docs": []}'))))
    path = scratch_path(spark, "page-shapes")
    pages.select(F.explode(lines).alias("value")).write.text(path)
    record = T.StructType([f for f in raw_works(spark, sf).schema.fields if f.name in ("key", "title", "edition_count")])
    records, rejects = landing.read_pages(spark, path, record)
    none = F.lit(None).cast("string")
    return records.select("page_list", "key", "title", "edition_count", none.alias("reason")).unionByName(
        rejects.select(none.alias("page_list"), none.alias("key"), none.alias("title"),
                       F.lit(None).cast("bigint").alias("edition_count"), "reason"))


def nested_to_json(spark, sf):
    e = raw_editions(spark, sf).select(
        "key", J.parse("works", J.KEY_ARRAY).alias("works"),
        J.parse("publishers", J.STRING_ARRAY).alias("publishers"),
        J.parse("languages", J.KEY_ARRAY).alias("languages"))
    return J.nested_to_json(e)


def linked_keys(spark, sf):
    return landing.linked_keys(raw_works(spark, sf), "key", "authors")


def frontier_anti(spark, sf):
    """Authors linked from works that have no valid author record yet."""
    cand = model.work_author(_work_level(spark, sf), distinct=False)
    return frontier.unseen(cand, _authors(spark, sf), "author_id")


# --- P / F: scalar functions and predicates ---------------------------------------

def extract_id(spark, sf):
    return raw_works(spark, sf).select("key", X.entity_id("key").alias("work_id"))


def extract_year(spark, sf):
    return raw_editions(spark, sf).select(
        "key", "publish_date", X.first_year("publish_date").alias("publish_year"))


def explode_delimited(spark, sf):
    return raw_works(spark, sf).select("key", F.explode(X.split_list("subject")).alias("item"))


def subject_clean(spark, sf):
    return _works(spark, sf).select("work_id", "subject")


def title_filter(spark, sf):
    e = impute.fill_constants(raw_editions(spark, sf), {"title": C.UNKNOWN})
    return e.filter(X.has_latin_letter("title")).select("key", "title")


def publisher_clean(spark, sf):
    return raw_editions(spark, sf).select(
        "key", F.explode(model.valid_publishers("publishers")).alias("publisher"))


def impute_hash_year(spark, sf):
    a = raw_authors(spark, sf).select(
        X.strip_prefix("key", C.AUTHOR_PREFIX).alias("author_id"),
        X.first_year("birth_date", C.BIRTH_YEAR_PATTERN, 0).alias("birth_date"))
    return impute.fill_computed(a, "birth_date", X.hash_year("author_id"))


def fill_constants(spark, sf):
    return impute.fill_constants(raw_editions(spark, sf), {
        "publishers": C.UNKNOWN, "languages": C.UNKNOWN, "title": C.UNKNOWN})


def json_first_key(spark, sf):
    return raw_editions(spark, sf).select("key", J.first_key("works").alias("work_key"))


def explode_json_strings(spark, sf):
    return J.explode_json(raw_editions(spark, sf), "publishers", J.STRING_ARRAY,
                          "publisher").select("key", "publisher")


def language_code(spark, sf):
    return raw_editions(spark, sf).select(
        "key", X.language_code(J.first_key("languages")).alias("language_code"))


def map_lookup_table(spark, sf):
    """F14 from a table: supplier nations by a map of (key, name) rows."""
    names = X.lookup_map(read_table(spark, sf, "nation"), "n_nationkey", "n_name")
    return read_table(spark, sf, "supplier").select(
        "s_suppkey", X.lookup(names, F.when(F.col("s_suppkey") % 7 > 0, F.col("s_nationkey"))).alias("nation"))


def map_lookup(spark, sf):
    code = F.coalesce(X.language_code(J.first_key("languages")), F.lit(C.UNKNOWN))
    return raw_editions(spark, sf).select("key", X.language_label(code).alias("language"))


# --- A: aggregates -------------------------------------------------------------------

def null_profile(spark, sf):
    return profile.null_counts(raw_editions(spark, sf))


def median_exact(spark, sf):
    e = clean.edition_parsed(raw_editions(spark, sf))
    return profile.stats(e, ["publish_date", "number_of_pages"], exact=True)


def median_approx(spark, sf):
    """Approximate medians, reported by what they promise: whether the rank of
    each lies within a thousandth of the middle."""
    e = clean.edition_parsed(raw_editions(spark, sf)).select("publish_date", "number_of_pages")
    e = materialise(e, "median-columns")
    m = profile.stats(e, e.columns, exact=False).first()
    checks = []
    for c in e.columns:
        n, v = F.count(c), F.lit(m[f"median_{c}"])
        checks.append(((F.count_if(F.col(c) < v) <= n * 0.501) & (F.count_if(F.col(c) <= v) >= n * 0.499))
                      .alias(f"{c}_within"))
    return e.agg(*checks, F.count(F.lit(1)).alias("n_rows"))


def impute_median(spark, sf):
    w = raw_works(spark, sf).select(
        X.entity_id("key").alias("work_id"),
        X.lenient_cast("first_publish_year", "int").alias("first_publish_year"))
    return impute.fill_median(w, ["first_publish_year"])


def group_count(spark, sf):
    return skew.group_count(dim_edition(spark, sf), ["language"], "n_rows")


def salted_agg(spark, sf):
    return skew.salted_agg(dim_edition(spark, sf), ["language"], {
        "n_rows": ("count", "*"),
        "n_editions": ("count_distinct", "edition_id"),
        "min_year": ("min", "publish_date"),
        "max_year": ("max", "publish_date"),
        "sum_year": ("sum", "publish_date"),
        "avg_year": ("avg", "publish_date"),
    }, salts=8)


def salted_holistic(spark, sf):
    """A5 for aggregates that gather values: per language the most frequent
    publisher, the decades, and whether the median and the 0.9 quantile of the
    year lie within a hundredth of their ranks."""
    d = materialise(dim_edition(spark, sf).select("edition_id", "publisher", "publish_date", "language"), "holistic")
    shares = {"median": 0.5, "high": 0.9}
    q = skew.salted_quantile(d, ["language"], "publish_date", shares, salts=8)
    mode = skew.salted_mode(d, ["language"], "publisher")
    decades = skew.salted_set(d.withColumn("decade", X.decade("publish_date")), ["language"], "decade", "decades", salts=8)
    n, y = F.count("publish_date"), F.col("publish_date")
    ranks = d.join(q, "language").groupBy("language").agg(*[
        ((F.count_if(y < F.col(c)) <= n * (s + 0.01)) & (F.count_if(y <= F.col(c)) >= n * (s - 0.01))).alias(f"{c}_within")
        for c, s in shares.items()])
    return (ranks.join(mode, "language").join(decades, "language")
            .select("language", "median_within", "high_within", F.col("mode").alias("publisher"),
                    F.col("mode_count").alias("n_publisher"), F.concat_ws(",", F.transform("decades", lambda x: x.cast("string"))).alias("decades")))


def two_day_impute(spark, sf):
    """A2b across loads: the works of two days; each day stores its sketch, and the
    second day's missing years take the median over both days without the first
    day's rows being read. Per work of the second day: the year if it was known,
    and whether a filled year lies within a hundredth of the middle of all."""
    root, land = scratch_path(spark, "year-sketches"), scratch_path(spark, "year-days")
    w = raw_works(spark, sf).select(X.entity_id("key").alias("work_id"), "edition_count",
                                    X.lenient_cast("first_publish_year", "int").alias("year"))
    days = {"2025-01-15": F.col("edition_count") % 3 != 0, "2025-01-16": F.col("edition_count") % 3 == 0}
    for day, chosen in days.items():
        w.filter(chosen).write.parquet(f"{land}/{day}")
        sketches.record(spark.read.parquet(f"{land}/{day}"), root, day, ["year"])
    today = spark.read.parquet(f"{land}/2025-01-16").withColumn("known", F.col("year"))
    filled = sketches.fill(today, root, ["year"])
    value = filled.agg(F.max(F.when(F.col("known").isNull(), F.col("year"))).alias("v"))
    every, n = spark.read.parquet(f"{land}/2025-01-15", f"{land}/2025-01-16"), F.count("year")
    within = every.withColumn("v", value.scalar()).agg(
        ((F.count_if(F.col("year") < F.col("v")) <= n * 0.51) & (F.count_if(F.col("year") <= F.col("v")) >= n * 0.49)).alias("w"))
    return filled.select("work_id", F.col("known").alias("year"),
                         F.when(F.col("known").isNull() & F.col("year").isNotNull(), within.scalar()).alias("filled_within"))


def bridge_reload(spark, sf):
    staged = model.work_author(_work_level(spark, sf), distinct=False)
    return merge.bridge_reload(staged, ["work_id", "author_id"])


# --- W: windows / keys -----------------------------------------------------------------

def surrogate_key(spark, sf):
    pubs = dim_edition(spark, sf).select("publisher").distinct()
    return keys.surrogate_key(pubs, ["publisher"], "publisher_id")


def dedup_latest(spark, sf):
    return keys.one_per_key(fact_book(spark, sf), "edition_id")


# --- J: joins ----------------------------------------------------------------------------

def left_join_unhinted(spark, sf):
    e = _editions(spark, sf, FACT)
    return model.fact_book(e, model.dim_time(e), broadcast_time=False)


def previous_fact_load(spark, sf):
    """The warehouse fact table as an earlier load left it (from orders)."""
    o = read_table(spark, sf, "orders")
    return o.select(
        F.concat(F.lit("OL"), (F.col("o_orderkey") * 10 + 1).cast("string"), F.lit("M")).alias("edition_id"),
        F.lit(None).cast("string").alias("work_id"),
        F.lit(None).cast("int").alias("time_id"),
        (F.col("o_totalprice").cast("bigint") % 1000).alias("number_of_pages"))


def merge_upsert(spark, sf):
    return merge.upsert(previous_fact_load(spark, sf), fact_book(spark, sf), "edition_id")


def warehouse_load(spark, sf):
    """dim_edition loaded on two days into an empty warehouse copy (the
    second load must change nothing); one row per edition id."""
    root = scratch_path(spark, "warehouse")
    d = materialise(dim_edition(spark, sf), "dim-edition")
    warehouse.load_table(root, "dim_edition", d, "2025-01-15")
    warehouse.load_table(root, "dim_edition", d, "2025-01-16")
    return warehouse.read_table(spark, root, "dim_edition")


def warehouse_star(spark, sf):
    """D13 + D14 over the whole star: the build loaded on two days into an empty
    warehouse copy (the second load must change nothing); the fact table as
    stored, one row per edition id."""
    return warehouse.read_table(spark, _loaded_star(spark, sf), "fact_book")


def _loaded_star(spark, sf):
    root = scratch_path(spark, "warehouse-star")
    star = {t: materialise(df, f"built-{t}") for t, df in _star(spark, sf).items()}
    for day in ("2025-01-15", "2025-01-16"):
        warehouse.load_star(root, star, day)
    return root


def warehouse_tables(spark, sf):
    """Every table of the loaded star, each row as JSON beside its table's name."""
    root = _loaded_star(spark, sf)
    parts = [warehouse.read_table(spark, root, t).select(F.lit(t).alias("table_name"), row_text(t).alias("row_text"))
             for t in schemas.LOAD_ORDER]
    return reduce(DataFrame.unionByName, parts)


def _two_days(spark, sf):
    """A warehouse after two build days in one output folder: the first with all
    works under older titles, the second without the works whose edition count
    divides by 3 (they are kept) and with the titles of today."""
    out, root = scratch_path(spark, "two-days"), scratch_path(spark, "two-days-warehouse")
    works = materialise(_works(spark, sf), "two-days-works")
    today = works.filter(F.col("edition_count") % 3 != 0)
    for day, w in (("2025-01-15", works.withColumn("title", F.concat(F.lit("Aaa "), "title"))), ("2025-01-16", today)):
        sinks.partitioned_write(model.dim_work(w), f"{out}/dim_work", day)
        sinks.partitioned_write(model.work_author(w), f"{out}/work_author", day)
        newest = sinks.newest_load_day(spark, f"{out}/dim_work")
        for t in ("dim_work", "work_author"):
            warehouse.load_table(root, t, sinks.stage_day(spark, f"{out}/{t}", schemas.TABLES[t], newest), newest)
    return root


def two_day_dim_work(spark, sf):
    """S6 + S8 + D13: changed works take today's row, absent ones stay."""
    return warehouse.read_table(spark, _two_days(spark, sf), "dim_work")


def two_day_work_author(spark, sf):
    """The bridge holds the second day's pairs alone."""
    return warehouse.read_table(spark, _two_days(spark, sf), "work_author")


REPLAYS = ["load older day again", "replay without rows", "day written without rows", "killed before it was named"]


def replayed_loads(spark, sf):
    """Loads repeated in any order, each into a warehouse (or sink) of its own
    and read back: the first day run again after the second with other titles;
    a day run again without rows; a day of the date-partitioned sink written
    again without rows; a rerun of a bridge that ended before it was named."""
    root = scratch_path(spark, "replayed")
    works = materialise(_works(spark, sf), "replayed-works")
    today, older = works.filter("edition_count % 3 <> 0"), works.withColumn("title", F.concat(F.lit("Aaa "), "title"))
    two, none, sink, killed = (f"{root}/{x}" for x in ("two", "none", "sink", "killed"))
    for day, w in (("2025-01-15", works), ("2025-01-16", today), ("2025-01-15", older)):
        warehouse.load_table(two, "dim_work", model.dim_work(w), day)
    for w in (works, works.limit(0)):
        warehouse.load_table(none, "work_author", model.work_author(w), "2025-01-15")
    for day, w in (("2025-01-15", works), ("2025-01-16", works), ("2025-01-16", works.limit(0))):
        sinks.partitioned_write(model.dim_work(w), sink, day)
    warehouse.load_table(killed, "work_author", model.work_author(today), "2025-01-15")
    merge.write_rows(model.work_author(works), f"{killed}/work_author", "ended-early")
    got = [warehouse.read_table(spark, two, "dim_work").select("work_id", "title"),
           warehouse.read_table(spark, none, "work_author").select("work_id", F.col("author_id").alias("title")),
           spark.read.parquet(sink).select("work_id", F.concat_ws("|", "title", "day").alias("title")),
           warehouse.read_table(spark, killed, "work_author").select("work_id", F.col("author_id").alias("title"))]
    return reduce(DataFrame.unionByName, [g.withColumn("replay", F.lit(name)) for name, g in zip(REPLAYS, got)])


def stable_keys(spark, sf):
    """Ids across two builds: the first without the editions of an odd year, the
    second with all; old years keep their id, and every edition has one fact."""
    e = materialise(_editions(spark, sf, FACT), "stable-keys")
    first = model.dim_time(e.filter(F.col("publish_date") % 2 == 0))
    repeated = first.unionByName(first.withColumn("time_id", F.col("time_id") + 1000))   # one value, two keys
    second = materialise(model.dim_time(e, previous=repeated), "stable-time")
    facts = model.fact_book(e, second).groupBy("time_id").agg(F.count(F.lit(1)).alias("n_facts"))
    return second.select("time_id", "publish_year").join(facts, "time_id")


# --- O: order --------------------------------------------------------------------------------

def sorted_subjects(spark, sf):
    """``position`` is the row's place in the sorted output."""
    placed = keys.surrogate_key(_works(spark, sf).select("subject").distinct(), ["subject"], "position")
    return placed.orderBy("position").select("subject", "position")


def order_by_hidden(spark, sf):
    """Sorted by a column that is not returned, ties by work id, so a hot subject
    spans several ranges; ``position`` is the row's place in that order."""
    w = _works(spark, sf)
    d = model.dim_subject(w)
    placed = keys.surrogate_key(w.join(d, "subject").select("subject", "work_id", "subject_id"),
                                ["subject", "work_id"], "position")
    return placed.orderBy("position").select("work_id", "subject_id", "position")


# --- C: contracts --------------------------------------------------------------------------------

def _star(spark, sf):
    """The whole star from one build: cleaned frames materialised once."""
    return build.build_star(raw_works(spark, sf), raw_editions(spark, sf), raw_authors(spark, sf))


def quality_report(spark, sf):
    parsed = _parsed_editions(spark, sf, build.EDITION_COLUMNS)
    e = clean.edition_filled(parsed)
    return model.quality_report(e, model.dim_edition(e, rows=parsed.count()), model.fact_book(e, model.dim_time(e)))


def check_keys(spark, sf):
    star = _star(spark, sf)
    return contracts.keys_report({n: (star[n], k) for n, k in schemas.KEYS.items() if k})


def _text_facts(spark, sf):
    """Facts as a landing delivers them: time_id as text (some undated), page
    counts as doubles (some with a half)."""
    e = raw_editions(spark, sf)
    year = F.when(F.col("publish_date") == "undated", F.col("publish_date")).otherwise(
        X.first_year("publish_date").cast("string"))
    half = F.when(F.col("key").endswith("4M"), F.lit(0.5)).otherwise(F.lit(0.0))
    return e.select(X.entity_id("key").alias("edition_id"), X.entity_id(J.first_key("works")).alias("work_id"),
                    year.alias("time_id"), (F.col("number_of_pages") + half).alias("number_of_pages"))


def check_types(spark, sf):
    """The columns of two landed tables against the declared types."""
    e = raw_editions(spark, sf).select(X.entity_id("key").alias("edition_id"), "title", "publish_date",
                                       F.col("publishers").alias("publisher"))
    return contracts.type_report(e, "dim_edition", schemas.TABLES["dim_edition"]).unionByName(
        contracts.type_report(_text_facts(spark, sf), "fact_book", schemas.TABLES["fact_book"]))


def quarantined_load(spark, sf):
    """Landed facts are loaded; rows with a value beyond its declared type are
    left out and kept with the reason. Loaded facts (one per edition id) and
    rejects, row by row."""
    root = scratch_path(spark, "quarantine")
    warehouse.load_table(root, "fact_book", materialise(_text_facts(spark, sf), "text-facts"), "2025-01-15")
    none = F.lit(None).cast("string")
    loaded = warehouse.read_table(spark, root, "fact_book").select(
        "edition_id", "time_id", "number_of_pages", none.alias("column"), none.alias("reason"), none.alias("value"))
    rejects = warehouse.read_rejects(spark, root, "fact_book").select(
        F.get_json_object("row_json", "$.edition_id").alias("edition_id"), F.lit(None).cast("int").alias("time_id"),
        F.lit(None).cast("bigint").alias("number_of_pages"), "column", "reason", "value")
    return loaded.unionByName(rejects)


def check_lengths(spark, sf):
    star = _star(spark, sf)
    parts = [contracts.length_report(star[n], n, lim) for n, lim in schemas.LENGTHS.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- T: streaming ------------------------------------------------------------------------------------

def _events_stream(spark, sf):
    schema = read_table(spark, sf, "events").schema
    s = sdedup.read_stream(spark, sf, schema, glob="events.parquet")
    # every event arrives twice
    return s.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")


def stream_dedup(spark, sf):
    out, ck = scratch_path(spark, "events-dedup"), scratch_path(spark, "events-dedup-ckpt")
    q = sdedup.to_parquet(sdedup.dedup(_events_stream(spark, sf), ["event_id"]), out, ck)
    q.awaitTermination()
    return spark.read.parquet(out)


def stream_dedup_watermark(spark, sf):
    out, ck = scratch_path(spark, "events-wm"), scratch_path(spark, "events-wm-ckpt")
    d = sdedup.dedup(_events_stream(spark, sf), ["event_id"], event_time="ts", delay="1 hour")
    q = sdedup.to_parquet(d, out, ck)
    q.awaitTermination()
    return spark.read.parquet(out)


def stream_dedup_stored(spark, sf):
    """T1 without state: two files of events, every event twice in each stream and
    half of them in both files; a second stream with a checkpoint of its own then
    brings all events again, and adds none."""
    root, land, schema = scratch_path(spark, "events-stored"), scratch_path(spark, "events-land"), None
    events = read_table(spark, sf, "events")
    schema = events.schema
    events.filter("event_id % 3 > 0").coalesce(1).write.parquet(f"{land}/a")
    events.filter("event_id % 3 < 2").coalesce(1).write.parquet(f"{land}/b")
    for _ in (0, 1):
        twice = (sdedup.read_stream(spark, f"{land}/*", schema, max_files=1)
                 .withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy"))
        sdedup.start_stored_dedup(twice, root, ["event_id"], scratch_path(spark, "events-stored-ckpt")).awaitTermination()
    return sdedup.read_deduped(spark, root, schema)


def stream_upsert(spark, sf):
    """The staged fact rows land as files hashed by edition_id (a key lives in
    one file) in two folders, each streamed with a checkpoint of its own, one
    file per micro-batch, into the table of the previous load; the result
    equals the one-shot upsert."""
    root, schema = scratch_path(spark, "fact-changes"), schemas.TABLES["fact_book"]
    supsert.init_table(previous_fact_load(spark, sf), root, "edition_id")
    facts = materialise(fact_book(spark, sf), "fact-staged")
    for half in (0, 1):
        land = scratch_path(spark, "fact-landing")
        (facts.filter(F.pmod(F.xxhash64("edition_id"), F.lit(2)) == half)
         .repartition(2, "edition_id").write.parquet(land))
        stream = sdedup.read_stream(spark, land, schema, max_files=1)
        supsert.start_upsert(stream, root, "edition_id", scratch_path(spark, "fact-upsert-ckpt")).awaitTermination()
    return merge.read_current(spark, root, "edition_id", schema)


# --- landing: S9 -> F21 -> J3 -> S11 -> S12 over two rounds ------------------------------------------

def landing_rounds(spark, sf):
    """Two crawl rounds: response pages are exploded into works, their linked
    author keys are compared with the seen keys, new keys land in batches and are
    recorded. The second round has all works and lands only new keys."""
    seen, land = scratch_path(spark, "seen-authors"), scratch_path(spark, "author-keys")
    works = raw_works(spark, sf, keep_id=True)
    for round_, part in ((1, works.filter("_pk % 10 < 5")), (2, works)):
        pages = landing.pages_of(part, "works", 50, "_pk")
        path = scratch_path(spark, "responses")
        pages.select(F.to_json(F.struct("page", "works")).alias("value")).write.text(path)
        schema = T.StructType([T.StructField("page", T.LongType()),
                               T.StructField("works", T.ArrayType(raw_works(spark, sf).schema))])
        records = landing.explode_response(landing.read_responses(spark, path, schema), "works")
        links = landing.linked_keys(records, "key", "authors")
        new = materialise(frontier.unseen(links, frontier.read_seen(spark, seen, "linked_key"), "linked_key"), "new-keys")
        sinks.batched_landing(new.withColumn("round", F.lit(round_)), land, C.LANDING_BATCH_AUTHORS)
        frontier.record_seen(new, seen, "linked_key")
    return spark.read.parquet(land).select("linked_key", "round")


def row_text(table: str):
    """A row of a star table as text, null as ``null``."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in schemas.TABLES[table].names])


def star_written(spark, sf):
    """The whole build written as eight tables for a load day; rows per
    table as read back, and the sum of their hashes."""
    out = scratch_path(spark, "star")
    for name, df in _star(spark, sf).items():
        sinks.partitioned_write(df, f"{out}/{name}", "2025-01-15")
    number = lambda t: F.conv(F.substring(F.md5(row_text(t)), 1, 8), 16, 10).cast("long")
    parts = [spark.read.parquet(f"{out}/{t}").agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                                                  F.sum(number(t)).alias("row_hash")) for t in schemas.LOAD_ORDER]
    return reduce(DataFrame.unionByName, parts)


JOBS = {
    "work_clean": work_clean,
    "edition_clean": edition_clean,
    "author_clean": author_clean,
    "dim_work": dim_work,
    "dim_subject": dim_subject,
    "work_subject": work_subject,
    "work_author": work_author,
    "dim_edition": dim_edition,
    "dim_time": dim_time,
    "fact_book": fact_book,
    "dim_author": dim_author,
    "read_drifting": read_drifting,
    "harmonise_types": harmonise_types,
    "null_pad_union": null_pad_union,
    "compact_write": compact_write,
    "sample_rows": sample_rows,
    "partitioned_write": partitioned_write,
    "fact_write": fact_write,
    "stage_load": stage_load,
    "batched_landing": batched_landing,
    "clustered_write": clustered_write,
    "bucketed_fact": bucketed_fact,
    "explode_response": explode_response,
    "nested_to_json": nested_to_json,
    "linked_keys": linked_keys,
    "frontier_anti": frontier_anti,
    "extract_id": extract_id,
    "extract_year": extract_year,
    "explode_delimited": explode_delimited,
    "subject_clean": subject_clean,
    "title_filter": title_filter,
    "publisher_clean": publisher_clean,
    "impute_hash_year": impute_hash_year,
    "fill_constants": fill_constants,
    "json_first_key": json_first_key,
    "explode_json_strings": explode_json_strings,
    "language_code": language_code,
    "map_lookup": map_lookup,
    "null_profile": null_profile,
    "median_exact": median_exact,
    "median_approx": median_approx,
    "impute_median": impute_median,
    "group_count": group_count,
    "salted_agg": salted_agg,
    "bridge_reload": bridge_reload,
    "surrogate_key": surrogate_key,
    "dedup_latest": dedup_latest,
    "left_join_unhinted": left_join_unhinted,
    "merge_upsert": merge_upsert,
    "warehouse_load": warehouse_load,
    "warehouse_star": warehouse_star,
    "sorted_subjects": sorted_subjects,
    "order_by_hidden": order_by_hidden,
    "check_keys": check_keys,
    "quality_report": quality_report,
    "check_lengths": check_lengths,
    "stream_dedup": stream_dedup,
    "stream_dedup_watermark": stream_dedup_watermark,
    "stream_upsert": stream_upsert,
    "warehouse_tables": warehouse_tables,
    "two_day_dim_work": two_day_dim_work,
    "two_day_work_author": two_day_work_author,
    "stable_keys": stable_keys,
    "landing_rounds": landing_rounds,
    "star_written": star_written,
    "replayed_loads": replayed_loads,
    "stream_dedup_stored": stream_dedup_stored,
    "check_types": check_types,
    "quarantined_load": quarantined_load,
    "salted_holistic": salted_holistic,
    "two_day_impute": two_day_impute,
    "work_co_located": work_co_located,
    "page_shapes": page_shapes,
    "map_lookup_table": map_lookup_table,
    "manifest_landing": manifest_landing,
    "compacted_landing": compacted_landing,
}
