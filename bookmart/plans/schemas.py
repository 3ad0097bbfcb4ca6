"""Warehouse table contracts: declared types, keys and text lengths."""

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()


def _st(*cols):
    return T.StructType([T.StructField(n, t) for n, t in cols])


# Declared warehouse schemas (staging twins use the same columns, no keys).
TABLES = {
    "dim_work": _st(("work_id", S), ("title", S), ("first_publish_year", I), ("edition_count", L)),
    "dim_subject": _st(("subject_id", L), ("subject", S)),
    "work_subject": _st(("work_id", S), ("subject_id", L)),
    "work_author": _st(("work_id", S), ("author_id", S)),
    "dim_edition": _st(("edition_id", S), ("title", S), ("publish_date", I),
                       ("publisher", S), ("language", S)),
    "dim_time": _st(("time_id", I), ("publish_year", I), ("decade", I), ("century", I)),
    "dim_author": _st(("author_id", S), ("name", S), ("birth_date", I)),
    "fact_book": _st(("edition_id", S), ("work_id", S), ("time_id", I), ("number_of_pages", L)),
}

# Primary keys; None = no key (bridges and the fact are reloaded / appended).
KEYS = {
    "dim_work": "work_id", "dim_subject": "subject_id", "dim_edition": "edition_id",
    "dim_time": "time_id", "dim_author": "author_id", "fact_book": "edition_id",
    "work_subject": None, "work_author": None,
}

# FIXED VALUES: declared text lengths of the warehouse columns.
LENGTHS = {
    "dim_work": {"work_id": 50, "title": 10000},
    "dim_subject": {"subject": 500},
    "work_subject": {"work_id": 50},
    "work_author": {"work_id": 50, "author_id": 50},
    "dim_edition": {"edition_id": 50, "title": 1000, "publisher": 500, "language": 100},
    "dim_author": {"author_id": 50, "name": 500},
    "fact_book": {"edition_id": 50, "work_id": 50},
}

# Bridges are reloaded; dimensions come before what refers to them.
BRIDGES = {t for t, key in KEYS.items() if key is None}
LOAD_ORDER = sorted(TABLES, key=lambda t: (not t.startswith("dim_"), t))
