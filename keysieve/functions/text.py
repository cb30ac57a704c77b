"""Text helpers: Python-style ``strip()`` and whitespace tokenisation."""

from __future__ import annotations

import re
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's ``str.strip()`` removes, derived from ``str.isspace``.
PY_WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())
LATIN1_WHITESPACE = "".join(c for c in PY_WHITESPACE if ord(c) < 256)

# Token separator for turning prose into candidate strings.
TOKEN_SEPARATOR = "[ \t\n\r]+"


def _java_class(chars: str) -> str:
    return "[" + "".join("\\x{%X}" % ord(c) for c in chars) + "]"


def py_strip(col: str | Column, charset: str = "UTF-8") -> Column:
    """Strip leading/trailing whitespace exactly like Python's ``str.strip()``
    on text decoded with ``charset``."""
    c = F.col(col) if isinstance(col, str) else col
    chars = LATIN1_WHITESPACE if charset.upper().replace("-", "") in ("ISO88591", "LATIN1") \
        else PY_WHITESPACE
    cls = _java_class(chars)
    return F.regexp_replace(c, f"^{cls}+|{cls}+$", "")


def tokens(col: str | Column, separator: str = TOKEN_SEPARATOR) -> Column:
    """Whitespace-separated tokens of a text column (to be exploded)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(c, separator)


def sql_char_set(chars: str) -> str:
    """SQL expression concatenating ``chr()`` calls (for oracle SQL)."""
    return " || ".join(f"chr({ord(c)})" for c in chars)


assert re.fullmatch(r"\s+", PY_WHITESPACE)
