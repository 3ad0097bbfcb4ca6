from . import build, clean, fixtures, model, schemas, warehouse  # noqa: F401
