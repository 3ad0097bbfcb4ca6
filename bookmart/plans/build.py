"""The whole star build in dependency order.

The cleaned frames feed up to five outputs each, so they are written once as
parquet tables in the shared checkpoint folder instead of being recomputed
per output; a lost executor then re-reads the table rather than re-running
the cleaning and its statistics jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import PARSED_FILE_ROWS, PARSED_ROW_GROUP, materialise
from . import clean, model


# What the star is made of; isbn_13 is in none of its tables.
EDITION_COLUMNS = ["edition_id", "work_id", "title", "publish_date", "publishers", "languages", "number_of_pages"]


def build_star(works_raw: DataFrame, editions_raw: DataFrame, authors_raw: DataFrame,
               materialise_cleaned: bool = True,
               previous: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All eight tables. ``previous`` may hold the warehouse's current
    ``dim_subject`` / ``dim_time``: their ids are then kept stable and the
    bridges and the fact table use them."""
    previous = previous or {}
    works = clean.work_parsed(works_raw)
    parsed = clean.edition_parsed(editions_raw, EDITION_COLUMNS)
    author = clean.author_clean(authors_raw)
    if materialise_cleaned:
        works = materialise(works, "work_parsed", PARSED_ROW_GROUP)
        # parsed rather than cleaned rows: one parse for the medians and the rows
        parsed = materialise(parsed, "edition_parsed", PARSED_ROW_GROUP, PARSED_FILE_ROWS)
    n_editions = parsed.count() if materialise_cleaned else None
    level, edition = clean.work_filled(works), clean.edition_filled(parsed)
    work = clean.explode_works(level)
    d_subject = model.dim_subject(work, previous=previous.get("dim_subject"))
    d_time = model.dim_time(edition, previous=previous.get("dim_time"))
    if materialise_cleaned:
        # the numbered frames feed a table and a bridge or the fact each
        d_subject, d_time = materialise(d_subject, "dim_subject"), materialise(d_time, "dim_time")
    return {
        "dim_work": model.dim_work(level),
        "dim_subject": d_subject,
        "work_subject": model.work_subject(work, d_subject),
        "work_author": model.work_author(level),
        "dim_edition": model.dim_edition(edition, rows=n_editions),
        "dim_time": d_time,
        "dim_author": model.dim_author(author),
        "fact_book": model.fact_book(edition, d_time),
    }
