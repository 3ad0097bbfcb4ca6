from . import drifting, landing, scan, sinks  # noqa: F401
