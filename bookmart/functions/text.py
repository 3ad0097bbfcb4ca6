"""Column functions for keys, years, subjects, publishers and languages.

All are built-in expressions, so they stay inside whole-stage codegen; no
Python UDF is used anywhere. Casts that may meet bad text use ``try_cast``
(ANSI mode makes a plain cast of ``''`` to int fail).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import catalogue as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# entity id from a path key; no match gives '' (not null), null stays null.
def entity_id(c, pattern: str = C.ENTITY_ID_PATTERN) -> Column:
    return F.regexp_extract(_col(c), pattern, 0)


# remove a literal prefix, then trim.
def strip_prefix(c, prefix: str) -> Column:
    return F.trim(F.replace(_col(c), F.lit(prefix), F.lit("")))


# P9 + F3 + F8: first 4-digit year in free text as int; '' / no year -> null.
def first_year(c, pattern: str = C.YEAR_PATTERN, group: int = 1) -> Column:
    text = F.trim(F.regexp_extract(_col(c), pattern, group))
    return F.nullif(text, F.lit("")).try_cast("int")


# F8: lenient cast: bad input gives null instead of failing the job.
def lenient_cast(c, to: str) -> Column:
    return _col(c).try_cast(to)


# "[a, b]" -> array('a', ' b'); null stays null (explode then drops it).
def split_list(c, brackets: str = C.SUBJECT_BRACKETS,
               sep: str = C.SUBJECT_SEPARATOR) -> Column:
    return F.split(F.regexp_replace(_col(c), brackets, ""), sep)


# strip subject tags and quotes.
def strip_subject_tags(c) -> Column:
    return F.regexp_replace(_col(c), C.SUBJECT_TAGS, "")


# Subject present, no backslash, no digit.
def subject_is_clean_text(c) -> Column:
    c = _col(c)
    return c.isNotNull() & ~c.rlike(C.SUBJECT_JUNK_1)


# No &, .com suffix, @, leading ':' or '.', and not empty after trim.
def subject_is_wellformed(c) -> Column:
    c = _col(c)
    return ~c.rlike(C.SUBJECT_JUNK_2) & (F.trim(c) != "")


# F6
def strip_subject_marks(c) -> Column:
    return F.regexp_replace(_col(c), C.SUBJECT_STRIP, "")


# P5
def has_latin_letter(c) -> Column:
    return _col(c).rlike(C.TITLE_LETTER)


# P7
def is_real_name(c) -> Column:
    c = _col(c)
    return c.isNotNull() & ~c.rlike(C.AUTHOR_NAME_JUNK)


# publisher normalisation (pattern is a parameter; see catalogue.py).
def normalise_publisher(c, pattern: str = C.PUBLISHER_STRIP) -> Column:
    return F.trim(F.regexp_replace(_col(c), pattern, ""))


# P6 + F20: publisher validity. The rejected phrases are plain text, and a search for
# each costs less than their alternation as a pattern.
def is_valid_publisher(c) -> Column:
    c = _col(c)
    rejected = reduce(Column.__or__, [F.contains(c, F.lit(phrase)) for phrase in C.PUBLISHER_REJECT.split("|")])
    return (c.rlike(C.PUBLISHER_MIN_LETTERS) & (c != "")
            & (F.length(c) < C.PUBLISHER_MAX_LENGTH) & ~rejected)


# trailing letters of a language key.
def language_code(c) -> Column:
    return F.regexp_extract(_col(c), C.LANGUAGE_CODE_PATTERN, 0)


# code -> label through a literal map; a missing code gives null.
def map_lookup(c, mapping: dict) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)[_col(c)]


def language_label(c, mapping: dict | None = None) -> Column:
    return map_lookup(c, mapping or C.LANGUAGE_LABELS)


# F14 from a table: its rows as one map value (a scalar subquery), so a lookup is
# an expression and no join. For code lists: a longer table is an error, and to be
# joined.
MAP_ROWS = 10_000


def lookup_map(table: DataFrame, key: str, value: str) -> Column:
    rows = table.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))
    entries = F.map_from_entries(F.collect_list(F.struct(key, value)))
    too_long = F.raise_error(F.lit(f"more than {MAP_ROWS} codes: join the table"))
    return rows.agg(F.count(F.lit(1)).alias("n"), entries.alias("m")).select(
        F.when(F.col("n") <= MAP_ROWS, F.col("m")).otherwise(too_long)).scalar()


def lookup(mapping: Column, c) -> Column:
    """The value under a code; null without one."""
    return F.try_element_at(mapping, _col(c))


# Decade (its first year) and century of a year after 0.
def decade(y) -> Column:
    return _col(y) - _col(y) % 10


def century(y) -> Column:
    return F.floor((_col(y) + 99) / 100).cast("int")


# load-date parts of an explicit date (never an implicit "today").
def load_date_parts(day: str) -> dict:
    d = F.to_date(F.lit(day))
    return {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}


# F18 (deterministic replacement of a random year): the same id always gets
# the same year, so duplicates of one author still collapse.
def hash_year(id_col, base: int = C.IMPUTE_YEAR_BASE,
              span: int = C.IMPUTE_YEAR_SPAN) -> Column:
    h = F.conv(F.substring(F.md5(_col(id_col)), 1, 8), 16, 10).cast("bigint")
    return (F.lit(base) + F.pmod(h, F.lit(span))).cast("int")


# A deterministic salt column in [0, n).
def salt(n: int, *cols) -> Column:
    return F.pmod(F.xxhash64(*[_col(c) for c in cols]), F.lit(n)).cast("int")
