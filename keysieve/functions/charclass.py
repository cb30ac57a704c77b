"""Character-class flags, composition score and strength label.

Every function returns a Column expression built from ``pyspark.sql.functions``;
nothing here touches data, so the expressions stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
# These patterns, thresholds and label names must stay exactly as they are for
# labels to agree with the published pipeline. Patterns are Java regexes as used
# by ``rlike`` (find semantics).
FLAG_PATTERNS: dict[str, str] = {
    "is_lower": "^[a-z]+$",
    "is_upper": "^[A-Z]+$",
    "is_digit": "^[0-9]+$",
    "has_letter_and_digit": r"(?=.*[a-zA-Z])(?=.*\d)",
    "has_digits": ".*[0-9].*",
    "has_upper": ".*[A-Z].*",
    "has_lower": ".*[a-z].*",
    "has_symbols": "[^a-zA-Z0-9].*",
    "has_spaces": r"\s",
    "has_special_characters": r"[!@#$%^&*()_+{}\|:<>?~`\-=\[\];',./]",
}
BLANK_PATTERN = r"^\s*$"
MAX_LENGTH_EXCLUSIVE = 20  # outlier filter keeps length < 20
LONG_BONUS_ABOVE = 8  # score gets +1 when length > 8
COMMON_THRESHOLD = 10  # breach count >= 10 -> "common"
STRONG_SCORE = 5
MEDIUM_SCORE = 3
LABEL_STRONG = "Strong"
LABEL_MEDIUM = "medium"
LABEL_WEAK = "weak"
# ---------------------------------------------------------------------------

FLAG_COLUMNS: list[str] = list(FLAG_PATTERNS)
# Class order used by reports; equals StringIndexer's frequency order on any
# realistic list (weak > medium > Strong).
CLASS_ORDER: list[str] = [LABEL_WEAK, LABEL_MEDIUM, LABEL_STRONG]
# Flags that enter the composition score.
SCORE_FLAGS: list[str] = ["has_upper", "has_lower", "has_digits", "has_special_characters"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(password: str | Column, name: str) -> Column:
    """One character-class flag as INT 0/1 (NULL password -> NULL)."""
    return _col(password).rlike(FLAG_PATTERNS[name]).cast("int")


def flag_columns(password: str | Column = "password",
                 names: list[str] | None = None) -> dict[str, Column]:
    """All flags plus ``length`` as a mapping for a single ``withColumns``."""
    cols = {n: flag(password, n) for n in (names or FLAG_COLUMNS)}
    cols["length"] = F.length(_col(password))
    return cols


# Characters a string matching BLANK_PATTERN can start with: Java's \s class
# and the line terminators ``$`` may precede.
_BLANK_LEADS = [" ", "\t", "\n", "\x0b", "\f", "\r", "\u0085", "\u2028", "\u2029"]


def is_blank(password: str | Column = "password") -> Column:
    """``rlike('^\\s*$')``, with the regex evaluated only for strings that are
    empty or start with whitespace/a line terminator (no other string can
    match), so ordinary tokens skip the matcher entirely."""
    p = _col(password)
    return (F.length(p) == 0) | (F.substring(p, 1, 1).isin(_BLANK_LEADS) & p.rlike(BLANK_PATTERN))


def score(flags_prefix: str = "", length: str | Column = "length",
          long_above: int = LONG_BONUS_ABOVE) -> Column:
    """upper + lower + digits + special + (length > 8): an INT in 0..5."""
    total = F.lit(0)
    for f in SCORE_FLAGS:
        total = total + F.col(flags_prefix + f)
    return (total + F.when(_col(length) > long_above, 1).otherwise(0)).cast("int")


def strength_label(score_col: str | Column = "score") -> Column:
    s = _col(score_col)
    return (F.when(s == STRONG_SCORE, LABEL_STRONG)
            .when(s >= MEDIUM_SCORE, LABEL_MEDIUM)
            .otherwise(LABEL_WEAK))


def frequency_band(count_col: str | Column = "breach_count",
                   threshold: int = COMMON_THRESHOLD) -> Column:
    """``common`` when the breach count reaches the threshold, else ``rare``
    (a NULL count is ``rare``)."""
    return F.when(_col(count_col) >= threshold, "common").otherwise("rare")
