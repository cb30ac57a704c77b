"""Profiling aggregates and ordered reports over a candidate list.

Every aggregate is a hash aggregate with a partial (map-side) step, so a
single password or length that makes up a third of the list is combined on
each mapper before the shuffle. Top-k reports use ``orderBy(...).limit(k)``
with a total order, which Spark plans as ``TakeOrderedAndProject`` (per-task
top-k, then a k-row merge) — no global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATTERN_FLAGS = ["is_lower", "is_upper", "is_digit"]


def password_frequency(df: DataFrame, col: str = "password",
                       out: str = "freq") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def top_passwords(freq: DataFrame, k: int = 10, col: str = "password",
                  count_col: str = "freq") -> DataFrame:
    return freq.orderBy(F.desc(count_col), F.asc(col)).limit(k)


def length_histogram(df: DataFrame, col: str = "password") -> DataFrame:
    return (df.groupBy(F.length(col).alias("length"))
            .agg(F.count(F.lit(1)).alias("length_count")))


def longest_lengths(hist: DataFrame, k: int = 10) -> DataFrame:
    return hist.orderBy(F.desc("length")).limit(k)


def pattern_frequency(features: DataFrame, flags: list[str] = PATTERN_FLAGS) -> DataFrame:
    return features.groupBy(*flags).agg(F.count(F.lit(1)).alias("pattern_frequency"))


def top_patterns(patterns: DataFrame, k: int = 10,
                 flags: list[str] = PATTERN_FLAGS) -> DataFrame:
    return patterns.orderBy(F.desc("pattern_frequency"), *flags).limit(k)


def distribution(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """Rows per value of ``col`` (class balance, flag balance, predictions)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def class_counts(df: DataFrame, label_col: str = "password_strength",
                 classes: list[str] | None = None) -> DataFrame:
    """One row: total rows and rows per class, in a single pass."""
    from keysieve.functions.charclass import CLASS_ORDER
    classes = classes or CLASS_ORDER
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(F.col(label_col) == c).alias(f"n_{c.lower()}") for c in classes]
    return df.agg(*aggs)


def probe_count(df: DataFrame, value: str, col: str = "password") -> DataFrame:
    """How many rows equal ``value`` (one row, ``probe``/``n``)."""
    return (df.where(F.col(col) == value)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(value).alias("probe"), "n"))


def extreme_length(df: DataFrame, min_length: int = 250, k: int = 1,
                   col: str = "password") -> DataFrame:
    """The ``k`` longest strings above ``min_length`` characters."""
    return (df.where(F.length(col) > min_length)
            .select(col, F.length(col).alias("length"))
            .orderBy(F.desc("length"), F.asc(col)).limit(k))


def letter_values(depth: int) -> list[float]:
    """Tail areas of the letter values of a boxen plot: 1/2, 1/4, 3/4, 1/8 ..."""
    qs = [0.5]
    for d in range(2, depth + 1):
        p = 0.5 ** d
        qs += [p, 1.0 - p]
    return qs


def length_quantiles(df: DataFrame, depth: int = 5, col: str = "password",
                     exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Letter values of the length distribution, one row per quantile.

    ``exact`` uses ``percentile`` (its buffer is a value->count map, so it
    stays small for a low-cardinality column like length); otherwise
    ``percentile_approx``."""
    qs = letter_values(depth)
    length = F.length(col)
    agg = (F.percentile(length, qs) if exact
           else F.percentile_approx(length, qs, accuracy).cast("array<double>"))
    return (df.agg(agg.alias("v"))
            .select(F.posexplode(F.arrays_zip(F.array(*[F.lit(q) for q in qs]).alias("q"),
                                               F.col("v").alias("value"))))
            .select(F.col("pos").cast("int").alias("idx"),
                    F.col("col.q").alias("quantile"),
                    F.round(F.col("col.value"), 6).alias("value")))


def dedup(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(keys) if keys else df.dropDuplicates()
