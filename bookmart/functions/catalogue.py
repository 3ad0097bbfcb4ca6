"""Fixed values that must equal the source catalogue job's, stated together.

FIXED VALUES: patterns, word lists and the language map below are the
catalogue rules the outputs depend on. Change them only on purpose.
"""

# FIXED VALUES ---------------------------------------------------------------

# Entity id inside a path key: "/works/OL1W" -> "OL1W".
ENTITY_ID_PATTERN = r"[A-Z]+\d+[A-Z]"

# First four-digit year in free text (publish dates: group 1; birth dates:
# the whole match).
YEAR_PATTERN = r"(\d{4})"
BIRTH_YEAR_PATTERN = r"\d{4}"

# Subject list: brackets removed, then split on every comma.
SUBJECT_BRACKETS = r"[\]\[]"
SUBJECT_SEPARATOR = ","
SUBJECT_TAGS = r'form:|genre:|"'
SUBJECT_JUNK_1 = r"\\|[0-9]"                    # backslash or any digit
SUBJECT_JUNK_2 = r"&|\.com$|@|^:|^\."           # &, .com suffix, @, leading : or .
SUBJECT_STRIP = r"'|\*|-"

# Title must hold a Latin letter.
TITLE_LETTER = r"[A-Za-z]"

# Author names holding this text are dropped (case-sensitive).
AUTHOR_NAME_JUNK = r"n/a"
AUTHOR_PREFIX = "/authors/"

# Publisher normalisation. The leading ".$" removes the last character of
# every name (kept as in the source job); PUBLISHER_STRIP_DOT_ONLY is the
# variant that only removes a trailing dot.
PUBLISHER_STRIP = r".$|-$|\?|\]|\[|s\.n\.?|etc\.?|et al\.?|publisher not identified"
PUBLISHER_STRIP_DOT_ONLY = r"\.$|-$|\?|\]|\[|s\.n\.?|etc\.?|et al\.?|publisher not identified"
PUBLISHER_MIN_LETTERS = r"[a-z]{3,}"
PUBLISHER_MAX_LENGTH = 86                       # kept when length < 86
PUBLISHER_REJECT = r"printed by|printed for|distributed by|distributor|sold by"

# Trailing language code of "/languages/eng".
LANGUAGE_CODE_PATTERN = "[A-Z|a-z]+$"

# Language code -> label; codes outside the map become null.
LANGUAGE_LABELS = {
    "eng": "English",
    "vie": "Vietnamese",
    "fre": "French",
    "ger": "German",
    "spa": "Spanish",
    "ita": "Italian",
    "jpn": "Japanese",
    "kor": "Korean",
    "chi": "Chinese",
    "rus": "Russian",
    "por": "Portuguese",
    "ara": "Arabic",
    "hin": "Hindi",
    "ben": "Bengali",
    "tur": "Turkish",
    "pol": "Polish",
    "ukr": "Ukrainian",
    "unknown": "Unknown",
}

# Constant used for missing text fields before parsing.
UNKNOWN = "unknown"

# Years below this are not time-dimension members.
MIN_YEAR = 1000

# Deterministic stand-in for a missing birth year: BASE + hash % SPAN.
IMPUTE_YEAR_BASE = 1800
IMPUTE_YEAR_SPAN = 200

# Warehouse sink defaults.
SINK_MAX_RECORDS_PER_FILE = 500_000
LANDING_BATCH_EDITIONS = 2_000
LANDING_BATCH_AUTHORS = 1_000

# END FIXED VALUES -----------------------------------------------------------
