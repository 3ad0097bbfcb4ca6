"""Documents in ascending doc_id order, spread over range blocks.

Bounds are quantiles of the narrow doc_id column, so the texts move once, in
one shuffle. Null doc_ids come first. The block numbers rise with the ids; all
rows of one doc_id lie in one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffle_width


def bounds(docs: DataFrame, doc_col: str, blocks: int | None = None) -> list[int]:
    """Upper bounds of all blocks but the last: a list as long as the number
    of blocks, which the driver may hold."""
    n = blocks or shuffle_width(docs.sparkSession)
    if n < 2:
        return []
    found = docs.select(F.percentile_approx(F.col(doc_col).cast("long"), [i / n for i in range(1, n)],
                                            max(10_000, 10 * n))).first()[0]
    return sorted(set(found or []))


def constants(values: list[int]) -> Column:
    """An array of whole numbers as one constant of the plan, however many."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def block_of(doc_id: Column, cuts: list[int]) -> Column:
    """Number of the cuts below a doc_id (0 for null), by binary search: the
    plan has one size for any number of blocks."""
    if not cuts:
        return F.lit(0)
    held = constants(cuts)
    steps = F.array(*[F.lit(1 << k) for k in range(len(cuts).bit_length() - 1, -1, -1)])
    # beyond the last cut there is nothing to get, so the step is not taken
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(held, at + step - 1) < doc_id, at + step).otherwise(at))
