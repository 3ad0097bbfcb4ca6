from . import dedup, upsert  # noqa: F401
