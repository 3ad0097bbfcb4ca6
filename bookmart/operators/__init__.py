from . import contracts, frontier, impute, keys, merge, profile, skew  # noqa: F401
