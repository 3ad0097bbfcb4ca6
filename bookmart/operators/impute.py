"""Fill missing values without a driver round trip.

Medians are computed by one aggregate over the frame and attached as a
scalar subquery (``DataFrame.scalar``): the plan stays lazy, there is no
join, and Spark runs the statistics job once when the result is executed.
A column whose values are all null has a null median and stays null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import profile


def fill_median(df: DataFrame, cols: list[str], exact: bool | set[str] = True) -> DataFrame:
    """Replace nulls in ``cols`` by the column median (in the column type)."""
    if not cols:
        return df
    st = profile.stats(df, cols, exact=exact)
    medians = st.select(F.struct(*[f"median_{c}" for c in cols]).alias("m")).scalar()
    # one subquery column, read by every fill, so the statistics run once
    m = "_bm_medians"
    return (df.withColumn(m, medians)
            .withColumns({c: F.coalesce(F.col(c), F.col(m).getField(f"median_{c}"))
                          for c in cols})
            .drop(m))


def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    """Null -> constant per column (only for columns present)."""
    present = {k: v for k, v in values.items() if k in df.columns}
    return df.fillna(present) if present else df


def fill_computed(df: DataFrame, col: str, value) -> DataFrame:
    """P10: null -> a computed Column."""
    return df.withColumn(col, F.coalesce(F.col(col), value))
