from . import catalogue, jsoncols, text  # noqa: F401
