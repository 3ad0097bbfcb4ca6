"""A1-A3: null counts, row count and medians in ONE aggregate pass.

The source job ran a separate action for each statistic. Here every
statistic is one expression in a single global ``agg``: each task
pre-aggregates, so only one small row per task reaches the final merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, cols: list[str] | None = None,
                count_col: str | None = "n_rows") -> DataFrame:
    """One row: for each column the number of nulls, plus the row count."""
    cols = cols or df.columns
    exprs = [F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    if count_col:
        exprs.append(F.count(F.lit(1)).alias(count_col))
    return df.agg(*exprs)


def median_expr(c: str, exact: bool = True, accuracy: int = 10000) -> Column:
    """Median of a column, nulls ignored, in the column's own type.

    ``exact`` uses percentile_disc: it merges one value -> count map in a single
    task, so it is for domains with a proven bound (years). Otherwise the approximate
    sketch (relative error ~ 1/accuracy) is bounded whatever the data size.
    """
    if exact:
        return F.expr(f"percentile_disc(0.5) within group (order by `{c}`)")
    return F.percentile_approx(F.col(c), 0.5, accuracy)


def stats(df: DataFrame, median_cols: list[str], null_cols: list[str] | None = None,
          exact: bool | set[str] = True) -> DataFrame:
    """One-row frame: ``median_<c>`` per column, plus null counts and count.
    ``exact`` may name the columns (of a proven small domain) that take the
    exact form."""
    types = dict(df.dtypes)
    exprs = [median_expr(c, exact if isinstance(exact, bool) else c in exact).cast(types[c]).alias(f"median_{c}")
             for c in median_cols]
    for c in null_cols or []:
        exprs.append(F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))
    exprs.append(F.count(F.lit(1)).alias("n_rows"))
    return df.agg(*exprs)
