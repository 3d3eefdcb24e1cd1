"""Character classes and fixed word lists shared by the value rules.

Everything under "fixed values" must stay exactly as written: results only agree with the
reference behaviour when these sets are the same.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------------------------

# Text that means NULL at load and check time (compared lower-cased; "none" is not one of them).
NULL_TOKENS = ("null", "<null>")

# Load-time boolean text.
LOAD_TRUE = "true"
LOAD_FALSE = "false"

# Check-time boolean text (the value is lower-cased, not stripped, before the test).
CHECK_BOOL_WORDS = ("true", "false", "yes", "no", "t", "f", "y", "n")
CHECK_TRUE = ("true", "yes", "t", "y")
CHECK_FALSE = ("false", "no", "f", "n")

# Boolean normalisation of a column found boolean-like.
BOOL_TRUE = ("true", "1", "yes", "t", "y")
BOOL_FALSE = ("false", "0", "no", "f", "n")
BOOL_LIKE = ("true", "false", "1", "0", "yes", "no", "t", "f", "y", "n")
BOOL_LIKE_MAX_DISTINCT = 10

# Column length of every target text column, in characters.
TARGET_TEXT_CHARS = 2000

# Characters removed from both ends by Python's str.strip(): the str.isspace() set.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Timestamp text with six fraction digits; the first three are kept, the rest of the text goes.
DATETIME_TEXT = (
    r"(?s)^(\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2} \p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2})\.(\p{Nd}{3})\p{Nd}{3}.*$"
)

# Letters and digits in the sense of Python's str.isalnum(), for Java and RE2.
ALNUM_ONLY = r"^[\p{L}\p{N}]+$"

# Separators ignored when deciding whether padded text is an identifier.
ID_SEPARATORS = r"[/_-]"

# Render format of date/time values: milliseconds, truncated.
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
DATE_FORMAT = "yyyy-MM-dd"

# Date in front of a value that is only a time.
BARE_TIME_DATE = "1900-01-01"
