"""Bloom filters as tables: built by aggregation, merged, and applied as a join.

A filter has ``buckets`` of 32,768 bits, one row each. A key falls in one
bucket by its hash and sets a few bits there by a second one, so a test looks at
one row. The bits are gathered with the built-in bitmap aggregates (combined on
the map side, 4 KB a bucket), and filters of the same shape are merged by OR, so
each part of a growing list can keep its own.

In front of a join, the filter of the small side drops most rows of the large
side before they are shuffled. It is broadcast only if its size, known from its
shape, is within a bound; else :func:`reduced` leaves the rows as they are,
which changes nothing but the work.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 1 << 15
WORDS = BUCKET_BITS // 64
#: Largest filter that is broadcast, in bytes.
MAX_BYTES = 64 << 20


@dataclass(frozen=True)
class Shape:
    """Size of a filter; filters of equal shape can be merged."""
    buckets: int
    bits_per_key: int

    @property
    def bytes(self) -> int:
        return self.buckets * BUCKET_BITS // 8


def shape_for(keys: int, error: float = 0.01) -> Shape:
    """Smallest shape that lets about ``error`` of other keys through."""
    if not 0 < error < 1:
        raise ValueError("error is a share between 0 and 1")
    bits = max(1, keys) * -math.log(error) / math.log(2) ** 2
    buckets = max(1, math.ceil(bits / BUCKET_BITS))
    return Shape(buckets, max(1, round(-math.log2(error))))


def _bucket(key: Column, shape: Shape) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shape.buckets).cast("bigint"))


def _positions(key: Column, shape: Shape) -> list[Column]:
    """Bits of a key in its bucket: steps of an odd width from a start, both from a second hash."""
    h = F.xxhash64(key, F.lit(1))
    start, step = h.bitwiseAND(F.lit(BUCKET_BITS - 1)), F.shiftrightunsigned(h, 20).bitwiseOR(F.lit(1).cast("bigint"))
    step = step.bitwiseAND(F.lit(BUCKET_BITS - 1))
    return [(start + step * F.lit(i)).bitwiseAND(F.lit(BUCKET_BITS - 1)) for i in range(shape.bits_per_key)]


def build(keys: DataFrame, key: str, shape: Shape) -> DataFrame:
    """``(bucket, bits BINARY(4096))``: the filter of a column; null keys are left out."""
    k = F.col(key)
    bits = keys.where(k.isNotNull()).select(_bucket(k, shape).alias("bucket"),
                                            F.explode(F.array(*_positions(k, shape))).alias("bit"))
    return bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merge(*filters: DataFrame) -> DataFrame:
    """Filter of all the keys of several filters of one shape."""
    out = filters[0]
    for f in filters[1:]:
        out = out.unionByName(f)
    return out.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _words(bits: Column) -> Column:
    """The bitmap as longs, whose bit 0 is the first byte's lowest."""
    def word(i: Column) -> Column:
        part = F.reverse(F.hex(F.substring(bits, i * 8 + 1, F.lit(8))))
        # Reversed digits: the bytes are in reverse, and the two digits of each too; swap those back.
        digits = F.regexp_replace(part, "(.)(.)", "$2$1")
        return F.conv(digits, 16, -10).cast("bigint")
    return F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), word)


def might_contain(words: Column, key: Column, shape: Shape) -> Column:
    """Whether all of the key's bits are set in its bucket's words."""
    out = F.lit(True)
    for bit in _positions(key, shape):
        word = F.get(words, F.shiftright(bit, 6).cast("int"))
        out = out & (F.getbit(word, bit.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return out


def reduced(df: DataFrame, key: str, filter_: DataFrame, shape: Shape, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Rows of ``df`` whose key may be in the filter: all that are, and a small
    share of the others. A filter over ``max_bytes`` is not applied."""
    if shape.bytes > max_bytes:
        return df
    f = F.broadcast(filter_.select(F.col("bucket").alias("_bucket"), _words(F.col("bits")).alias("_words")))
    hit = df.join(f, _bucket(F.col(key), shape) == F.col("_bucket"))
    return hit.where(might_contain(F.col("_words"), F.col(key), shape)).drop("_bucket", "_words")
