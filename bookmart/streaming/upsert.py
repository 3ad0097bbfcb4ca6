"""Incremental upsert of each micro-batch into a table of changes.

A micro-batch appends its rows under (stream, batch id); the stream's name is
taken from its checkpoint. A replay after a failure replaces the batch's own
rows, also by none, a stream with a new checkpoint writes beside the old one, and batch loads
(``plans.warehouse``) can share the table. What a batch writes grows with the
batch.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import keys, merge


def start_upsert(stream: DataFrame, root: str, key: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    source = "stream-" + hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge.append_changes(keys.one_per_key(batch, key), root, source, str(batch_id), key)

    w = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def init_table(df: DataFrame, root: str, key: str) -> None:
    """Write the initial state (of no day: every batch comes after it)."""
    merge.append_changes(keys.one_per_key(df, key), root, "init", "0", key, "0001-01-01")
