"""Word-list text scan: one candidate per line.

The text source splits files across tasks by byte range and ends lines at
``\\n``, ``\\r\\n`` or ``\\r``. Its ``value`` keeps the raw bytes, so casting
to BINARY is exact. ``password_bytes`` are those bytes without ASCII white
space at either end, and digests are taken over them: whatever charset a list
is read in, the password's own bytes are hashed. ``password`` is the decoded
line stripped like Python's ``str.strip()``, for features and display.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keysieve.functions.text import py_strip

DEFAULT_CHARSET = "ISO-8859-1"
#: Bytes trimmed from a line before it is hashed.
ASCII_ENDS = r"^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+$"


def trimmed_bytes(line: Column) -> Column:
    """BINARY line without ASCII white space at its ends (latin-1 maps every
    byte to one character and back, so nothing else is touched)."""
    return F.encode(F.regexp_replace(F.decode(line, "ISO-8859-1"), ASCII_ENDS, ""), "ISO-8859-1")


def decoded(line: Column, charset: str) -> Column:
    """The line in ``charset``; a line that is not valid UTF-8 is read as
    latin-1 instead, which is lossless."""
    if charset.upper().replace("-", "") != "UTF8":
        return F.decode(line, charset)
    return F.coalesce(F.try_validate_utf8(line.cast("string")), F.decode(line, "ISO-8859-1"))


def read_wordlist(spark: SparkSession, path: str, charset: str = DEFAULT_CHARSET,
                  col: str = "password") -> DataFrame:
    """``password STRING, password_bytes BINARY`` per line of the file(s)."""
    line = F.col("value").cast("binary")
    return spark.read.text(path).select(py_strip(decoded(line, charset), charset).alias(col),
                                        trimmed_bytes(line).alias(f"{col}_bytes"))


def undecodable(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``lines`` and how many of them are ``not_utf8``."""
    bad = F.try_validate_utf8("value").isNull() & F.col("value").isNotNull()
    return spark.read.text(path).agg(F.count(F.lit(1)).alias("lines"), F.count_if(bad).alias("not_utf8"))


def write_wordlist(df: DataFrame, path: str, col: str = "password",
                   mode: str = "errorifexists") -> None:
    """Write one candidate per line (UTF-8). Fires a job."""
    df.select(F.col(col).cast("string").alias("value")).write.mode(mode).text(path)
