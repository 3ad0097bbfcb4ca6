"""bookmart: a Spark-native build of a book-catalogue star schema.

Raw landings (drifting parquet / JSON) are cleaned into works, editions and
authors, modelled into dimensions, bridges and a fact table, and kept current
in a warehouse copy through deduplicated upserts, in batch or from a stream.

Every operator takes and returns ``DataFrame`` or ``Column`` objects and stays
lazy; the only actions are sinks and the few places that must cut lineage.
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming", "session"]
