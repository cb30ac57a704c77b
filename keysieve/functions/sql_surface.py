"""The column functions as functions of Spark SQL.

:func:`register` creates temporary SQL functions in a session, so that a
query in SQL text (over a view of any table) can use flags, score, label, band,
digest parts and the sequence encoding. They are SQL expressions that the
analyzer puts in place: no Python runs, filters on them are pushed down as the
expressions would be, and whole-stage code is generated.

Patterns, thresholds, vocabulary and names come from ``charclass``,
``sequence`` and ``digest``. A null string gives what the column functions give:
null flags and length, a ``weak`` label, an encoding of zeros.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from keysieve.functions import charclass as cc
from keysieve.functions import digest as dg
from keysieve.functions import sequence as sq

PREFIX = "pw_"


def quoted(text: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def definitions(prefix: str = PREFIX) -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, type, body), in an order in which each uses earlier ones only."""
    f = lambda name: f"{prefix}{name}"
    out = {f(name): ("p STRING", "INT", f"CAST(p RLIKE {quoted(pattern)} AS INT)") for name, pattern in cc.FLAG_PATTERNS.items()}
    flags = " + ".join(f"{f(name)}(p)" for name in cc.SCORE_FLAGS)
    out |= {
        f("is_blank"): ("p STRING", "BOOLEAN", f"p RLIKE {quoted(cc.BLANK_PATTERN)}"),
        f("score"): ("p STRING", "INT", f"{flags} + IF(length(p) > {cc.LONG_BONUS_ABOVE}, 1, 0)"),
        f("label"): ("score INT", "STRING", f"CASE WHEN score = {cc.STRONG_SCORE} THEN {quoted(cc.LABEL_STRONG)} "
                     f"WHEN score >= {cc.MEDIUM_SCORE} THEN {quoted(cc.LABEL_MEDIUM)} ELSE {quoted(cc.LABEL_WEAK)} END"),
        f("strength"): ("p STRING", "STRING", f"{f('label')}({f('score')}(p))"),
        f("band"): ("n BIGINT", "STRING", f"IF(n >= {cc.COMMON_THRESHOLD}, 'common', 'rare')"),
        f("sha1"): ("p STRING", "STRING", "upper(sha1(p))"),
        f("range_prefix"): ("p STRING", "STRING", f"left({f('sha1')}(p), {dg.PREFIX_LEN})"),
        f("range_suffix"): ("p STRING", "STRING", f"right({f('sha1')}(p), {dg.SUFFIX_LEN})"),
        f("encode"): ("p STRING", "ARRAY<INT>",
                      f"transform(sequence(1, {sq.WIDTH}), i -> IF(i <= length(lower(coalesce(p, ''))), "
                      f"instr({quoted(sq.VOCABULARY)}, substr(lower(coalesce(p, '')), i, 1)), {sq.PAD_ID}))"),
    }
    return out


def register(spark: SparkSession, prefix: str = PREFIX) -> list[str]:
    """Creates (or replaces) the session's temporary functions; their names."""
    made = definitions(prefix)
    for name, (parameters, kind, body) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(made)
