"""SHA-1 digests, range prefix/suffix split and content-hash bits.

Word lists carry their lines' original bytes next to the decoded string, and
the digest is taken over those. For a string alone it is taken over its bytes
in a chosen charset.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX_LEN = 5
SUFFIX_LEN = 35
TWO_POW_32 = 4294967296.0


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sha1_hex(password: str | Column = "password", charset: str = "UTF-8") -> Column:
    """Upper-case hex SHA-1 of the password's bytes in ``charset``."""
    p = _col(password)
    data = p if charset.upper().replace("-", "") == "UTF8" else F.encode(p, charset)
    return F.upper(F.sha1(data))


def sha1_of_bytes(data: str | Column) -> Column:
    """Upper-case hex SHA-1 of a BINARY column."""
    return F.upper(F.sha1(_col(data)))


def range_prefix(sha1: str | Column = "sha1") -> Column:
    return F.substring(_col(sha1), 1, PREFIX_LEN)


def range_suffix(sha1: str | Column = "sha1") -> Column:
    return F.substring(_col(sha1), PREFIX_LEN + 1, SUFFIX_LEN)


def hash_bits(key: str | Column, salt: str) -> Column:
    """First 32 bits of md5(key || '|' || salt) as a BIGINT in [0, 2^32).

    Deterministic, independent of partitioning and reproducible in any SQL
    engine; different salts give independent streams (sample, split, fold).
    """
    h = F.md5(F.concat(_col(key).cast("string"), F.lit("|" + salt)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def below_fraction(bits: Column, fraction: float | Column) -> Column:
    """``bits < fraction * 2^32`` — true for about ``fraction`` of all keys."""
    frac = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    return bits < frac * F.lit(TWO_POW_32)
