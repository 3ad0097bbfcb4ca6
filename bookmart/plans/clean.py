"""Cleaned works (one row per work and subject), editions, authors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import catalogue as C
from ..functions import jsoncols as J
from ..functions import text as X
from ..operators import impute

WORK_COLS = ["key", "title", "first_publish_year", "edition_count", "subject", "authors"]
EDITION_COLS = ["key", "works", "title", "publish_date", "publishers", "languages",
                "number_of_pages", "isbn_13"]

# Up to so many partitions (spark.shuffle.sort.bypassMergeThreshold) a map task writes each
# row straight to its partition's file; for more it gathers the rows in memory.
STREAMED_PARTITIONS = 200


def clean_subjects(df: DataFrame, col: str = "subject") -> DataFrame:
    """List text -> one cleaned subject per row. A null list
    gives no rows (the work then has no subject rows at all)."""
    return df.withColumn(col, F.explode(subject_items(col)))


def subject_items(col: str = "subject"):
    """F4-F7, P3, P4 on the split array (``transform`` / ``filter``): every item
    is cleaned once, in order, before any explode."""
    items = F.transform(X.split_list(col), X.strip_subject_tags)
    items = F.filter(items, X.subject_is_clean_text)
    items = F.transform(items, lambda s: F.trim(s))
    items = F.filter(items, X.subject_is_wellformed)
    return F.transform(items, X.strip_subject_marks)


def work_clean(works: DataFrame, exact_median: bool = True) -> DataFrame:
    """One row per work and subject."""
    return explode_works(work_level(works, exact_median))


def explode_works(level: DataFrame) -> DataFrame:
    return level.withColumn("subject", F.explode("subject"))


def work_level(works: DataFrame, exact_median: bool = True) -> DataFrame:
    """Cleaned works before the explode: ``subject`` is the array of cleaned
    subjects; works without one have no rows in D1 and are left out here too.
    What depends on works alone (D4, D7) starts from this frame."""
    return work_filled(work_parsed(works), exact_median)


def work_parsed(works: DataFrame) -> DataFrame:
    """Ids, years and subject arrays; nothing filled or left out yet. Written
    once before ``work_filled`` where it matters: a filter on the subjects would
    be pushed below the spread and parse them a second time."""
    return spread(works.select(*WORK_COLS)).select(
        X.entity_id("key").alias("work_id"), "title",
        X.lenient_cast("first_publish_year", "int").alias("first_publish_year"),
        "edition_count", subject_items().alias("subject"), "authors")


def work_filled(parsed: DataFrame, exact_median: bool = True) -> DataFrame:
    return impute.fill_median(parsed, ["first_publish_year"], exact=exact_median).filter(F.size("subject") > 0)


def spread(raw: DataFrame) -> DataFrame:
    """Even out a raw projection before it is parsed. Parsing is the dear part,
    and a landing's files differ in size by orders of magnitude (batches of one
    row group each); the same plan at every size. By a hash of the row: dealing rows
    out in turn sorts them first, and a task then holds all rows of its split. Into
    ``STREAMED_PARTITIONS`` at most, as it holds them for more as well; adaptive
    execution cuts large partitions by their map tasks, however large the landing is."""
    n = min(int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")), STREAMED_PARTITIONS)
    return raw.hint("rebalance", n, *[F.col(c) for c in raw.columns])


# The parsed columns, each with the raw column it is made of.
_PARSED = {
    "edition_id": ("key", lambda: X.entity_id("key")),
    "work_id": ("works", lambda: X.entity_id(J.first_key("works"))),
    "title": ("title", lambda: F.col("title")),
    "publish_date": ("publish_date", lambda: X.first_year(F.col("publish_date").cast("string"))),
    **{c: (c, lambda c=c: F.col(c)) for c in ("publishers", "languages", "number_of_pages", "isbn_13")},
}


def edition_parsed(editions: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Keys, work id and year extracted; nothing filled yet. With ``columns``
    only these are parsed, from the raw columns they need."""
    columns = columns or list(_PARSED)
    raw = spread(editions.select(*[_PARSED[c][0] for c in columns]))
    return raw.select(*[_PARSED[c][1]().alias(c) for c in columns])


def edition_clean(editions: DataFrame, exact_median: bool = True) -> DataFrame:
    """D2 from raw editions."""
    return edition_filled(edition_parsed(editions), exact_median)


def edition_filled(parsed: DataFrame, exact_median: bool = True) -> DataFrame:
    """D2 on parsed editions (with a title; other columns as present): medians for year and pages, 'unknown' for missing
    text, then rows whose title has no Latin letter are dropped. Years are a
    bounded domain; page counts are not and take the approximate median (as the
    source job did), whose state is bounded."""
    exact = {"publish_date"} if exact_median else False
    numbers = [c for c in ("publish_date", "number_of_pages") if c in parsed.columns]
    e = impute.fill_median(parsed, numbers, exact=exact)
    e = impute.fill_constants(e, {"publishers": C.UNKNOWN, "languages": C.UNKNOWN,
                                  "title": C.UNKNOWN})
    return e.filter(X.has_latin_letter("title"))


def author_clean(authors: DataFrame) -> DataFrame:
    """D3: id from key, real names only, birth year from text; a missing year
    becomes a deterministic hash year of the author id."""
    author_id = X.strip_prefix("key", C.AUTHOR_PREFIX)
    born = F.coalesce(X.first_year("birth_date", C.BIRTH_YEAR_PATTERN, 0), X.hash_year(author_id))
    return authors.where(X.is_real_name("name")).select(
        author_id.alias("author_id"), "name", born.alias("birth_date"))
