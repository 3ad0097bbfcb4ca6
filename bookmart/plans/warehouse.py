"""Keep a warehouse copy of the star current.

For every table: stage the new build by name with the declared types (S8, C2:
a row with a value that its column cannot hold is not loaded but lands in the
table's rejects, with column, reason and value); keyed tables append their deduplicated staging (W2) as changes, of which the
newest row per key counts (J4); bridges are replaced by their distinct staged
pairs (A7). Errors propagate (nothing is swallowed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contracts, keys, merge
from ..sources import bucketed
from . import schemas


def stage(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows that meet the table's contract, rejects)."""
    return contracts.split_valid(df, schemas.TABLES[table], schemas.LENGTHS.get(table))


def _root(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def _rejects(root: str, table: str) -> str:
    return f"{_root(root, table)}-rejects"


def load_table(root: str, table: str, new: DataFrame, load: str) -> None:
    """Stage and load one table; ``load`` is the day it is of. The same day
    again replaces itself, whether it has rows or not, and an older day run
    again does not win over a later one. ``new`` is read twice, for the rows
    and for the rejects: give it as a stored table."""
    staged, rejects = stage(new, table)
    merge.append_changes(rejects, _rejects(root, table), "load", load, as_of=load)
    if table in schemas.BRIDGES:
        merge.append_changes(merge.bridge_reload(staged, staged.columns), _root(root, table), "load", load, as_of=load)
    else:
        key = schemas.KEYS[table]
        # the buckets from about how many keys there are: one column of the stored staging,
        # rather than the deduplicated rows written and read once more to be counted
        n = 0 if bucketed.layout(new.sparkSession, _root(root, table)) else new.agg(F.approx_count_distinct(key)).first()[0]
        merge.append_changes(keys.one_per_key(staged, key), _root(root, table), "load", load, key, load,
                             max(bucketed.LEAST_BUCKETS, -(-n // bucketed.BUCKET_ROWS)))


def load_star(root: str, star: dict[str, DataFrame], load: str) -> list[str]:
    """Load every built table, dimensions first."""
    done = [t for t in schemas.LOAD_ORDER if t in star]
    for table in done:
        load_table(root, table, star[table], load)
    return done


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    path, schema = _root(root, table), schemas.TABLES[table]
    if not merge.is_loaded(spark, path):
        raise FileNotFoundError(f"nothing loaded under {path}")
    if table in schemas.BRIDGES:
        return merge.read_latest(spark, path, schema)
    return merge.read_current(spark, path, schemas.KEYS[table], schema)


def read_rejects(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows that the loads of a table left out, one row per reason."""
    found = merge.read_all(spark, _rejects(root, table), contracts.REJECT)
    return found.select(F.lit(table).alias("table_name"), "row_json", F.inline("reasons"))
