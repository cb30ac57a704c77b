"""Bootstrap intervals of accuracies, by weights that a hash decides.

Rows are dealt to a fixed number of blocks by their key's hash; a block is a few
sums, combined on the map side, so the shuffle has as many rows as there are
blocks, whatever the table's size. A replicate gives every block a weight drawn
from a Poisson distribution with mean 1 (sixteen bits of an MD5 of block and
replicate), and its accuracy is the weighted share of hits. Blocks of random
rows vary as the rows do, so the spread over replicates is that of the accuracy
over samples of the table's size. The same hash gives the same interval on any
partitioning and in any SQL engine.

Two predictors of the same rows share the weights, so the interval of their
difference is a paired one.

Defined results: rows without a key are in one block; rows that repeat a key
fall in one block together; a group in few blocks has a wide interval, one in a
single block an interval of its accuracy alone; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysieve.functions.digest import hash_bits

BLOCKS, REPLICATES, LEVEL = 1000, 200, 0.95
SALT_BLOCK, SALT_WEIGHT = "block", "weight"
PER_HASH = 8  # weights of sixteen bits in an MD5


def poisson_steps(mean: float = 1.0, top: int = 1 << 16) -> list[int]:
    """Least sixteen-bit number of each weight from 1 on: the distribution
    function times 2^16."""
    out, term, total, k = [], math.exp(-mean), 0.0, 0
    while True:
        total += term
        if (step := round(total * top)) >= top:
            return out
        out.append(step)
        k += 1
        term *= mean / k


def weight(block: Column, replicate: Column) -> Column:
    """A block's weight in a replicate."""
    digest = F.md5(F.concat(block.cast("string"), F.lit(f"|{SALT_WEIGHT}"), F.floor(replicate / PER_HASH).cast("string")))
    u = F.conv(digest.substr(replicate % PER_HASH * 4 + 1, F.lit(4)), 16, 10).cast("int")
    steps = F.array(*map(F.lit, poisson_steps()))
    return F.size(F.filter(steps, lambda s: u >= s)).cast("bigint")


def block_sums(df: DataFrame, values: dict[str, Column], key: str, by: list[str], blocks: int = BLOCKS) -> DataFrame:
    """``by, _block, _n`` and the sum of each of ``values``."""
    block = F.coalesce(hash_bits(key, SALT_BLOCK) % blocks, F.lit(-1).cast("bigint")).alias("_block")
    return df.groupBy(*by, block).agg(F.count(F.lit(1)).alias("_n"), *(F.sum(v).cast("bigint").alias(c) for c, v in values.items()))


def bootstrap(df: DataFrame, values: dict[str, Column], key: str, by: list[str] | None = None, blocks: int = BLOCKS,
              replicates: int = REPLICATES, level: float = LEVEL) -> DataFrame:
    """Per group ``by``: ``n`` and, for each of ``values`` (integers per row), its
    mean and the mean's interval, ``<name>_low`` and ``<name>_high``. Replicates
    that draw no row of a group are left out of its interval."""
    by = by or []
    sums = block_sums(df, values, key, by, blocks)
    drawn = (sums.select(*by, *values, "_n", "_block", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("_r"))
             .withColumn("_w", weight(F.col("_block"), F.col("_r"))))
    # One aggregate over blocks x replicates. The sums of replicate 0 are also those without weights.
    plain = lambda c: F.sum(F.when(F.col("_r") == 0, F.col(c)))
    per = drawn.groupBy(*by, "_r").agg(
        F.sum(F.col("_w") * F.col("_n")).alias("_wn"), *(F.sum(F.col("_w") * F.col(c)).alias(f"_w_{c}") for c in values),
        plain("_n").alias("_n"), *(plain(c).alias(c) for c in values))
    tails = [(1 - level) / 2, (1 + level) / 2]
    share = lambda c: F.when(F.col("_wn") > 0, F.col(f"_w_{c}") / F.col("_wn"))
    out = per.groupBy(*by).agg(F.sum("_n").alias("n"), *(
        x for c in values for x in ((F.sum(c) / F.sum("_n")).alias(c), F.percentile(share(c), tails).alias(f"_q_{c}"))))
    return out.where(F.col("n").isNotNull()).select(*by, "n", *(x for c in values for x in (
        F.round(c, 6).alias(c), F.round(F.col(f"_q_{c}")[0], 6).alias(f"{c}_low"), F.round(F.col(f"_q_{c}")[1], 6).alias(f"{c}_high"))))


def hit(true: str, predicted: str) -> Column:
    """1 where the labels agree (two nulls do), else 0."""
    return F.col(true).eqNullSafe(F.col(predicted)).cast("int")


def accuracy_interval(pred: DataFrame, true: str, predicted: str, key: str, by: list[str] | None = None, **kw) -> DataFrame:
    """``by, n, accuracy, accuracy_low, accuracy_high``."""
    return bootstrap(pred, {"accuracy": hit(true, predicted)}, key, by, **kw)


def accuracy_difference(pred: DataFrame, true: str, first: str, second: str, key: str, **kw) -> DataFrame:
    """``n, difference, difference_low, difference_high, told_apart``: how much
    more accurate ``first`` is than ``second`` on the same rows, and whether
    zero lies outside the interval."""
    out = bootstrap(pred, {"difference": hit(true, first) - hit(true, second)}, key, **kw)
    return out.withColumn("told_apart", (F.col("difference_low") > 0) | (F.col("difference_high") < 0))
