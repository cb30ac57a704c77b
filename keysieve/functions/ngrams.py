"""Character n-grams of a string, hashed to buckets: features without positions.

The string is lower-cased and closed by a start and an end sign, so that a
beginning and an end are grams of their own. Buckets are hash bits of a gram,
the same in any SQL engine; what is staged for a model is bucket numbers, no
text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keysieve.functions.digest import hash_bits

SIZES, BUCKETS, SALT = (1, 2, 3), 1 << 12, "gram"
START, END = "\x02", "\x03"


def grams(password: str | Column = "password", sizes: tuple[int, ...] = SIZES) -> Column:
    """All n-grams of the closed string; a null string is empty."""
    p = F.col(password) if isinstance(password, str) else password
    s = F.concat(F.lit(START), F.lower(F.coalesce(p, F.lit(""))), F.lit(END))
    none = F.array().cast("array<string>")

    def of_size(n: int) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: F.substring(s, i, n))
        return F.when(F.length(s) >= n, cut).otherwise(none)

    return F.flatten(F.array(*map(of_size, sizes)))


def buckets(password: str | Column = "password", sizes: tuple[int, ...] = SIZES, n: int = BUCKETS) -> Column:
    """ARRAY<INT>: the bucket of each gram, repeats included."""
    return F.transform(grams(password, sizes), lambda g: (hash_bits(g, SALT) % n).cast("int"))
