"""Summaries that are kept per part of a list and merged: frequent items,
quantiles and set sizes. A new part is summarised alone; a question about any
set of parts reads their summaries, not their rows.

* Frequent items: a Misra-Gries summary per task and part, of hashed items. A
  batch's counts are added, and if more than ``counters`` keys are held, the
  next largest count is taken from all and the empty ones go; the sum of what
  was taken bounds how much any key is undercounted, in one summary and over
  merged ones. From the merged bounds :func:`frequent_candidates` takes every
  key that can be among the top k, or finds that the summaries are too small.
* Quantiles of lengths: KLL sketches, whose rank error depends on ``k`` alone.
* Sizes of sets of digests, of their intersections and differences: theta
  sketches, exact up to ``2^lg`` distinct digests, and with a relative error of
  ``2^(-lg/2)`` of the union beyond.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysieve.operators.lineage import materialize
from keysieve.operators.profile import letter_values

# Frequent items.

COUNTERS = 4096
ITEM_SCHEMA = "part string, key bigint, low bigint, missed bigint"


def _add(held: pa.Table, counts: pa.Table, counters: int) -> tuple[pa.Table, int]:
    """Sum of two tables ``(key, low)``, cut to ``counters`` keys, and what was taken from each."""
    both = pa.concat_tables([held, counts]).group_by("key").aggregate([("low", "sum")])
    both = pa.table({"key": both["key"], "low": both["low_sum"]})
    if len(both) <= counters:
        return both, 0
    low = both["low"].to_numpy()
    taken = int(np.partition(low, len(low) - counters - 1)[len(low) - counters - 1])
    left = pc.subtract(both["low"], taken)
    keep = pc.greater(left, 0)
    return pa.table({"key": both["key"].filter(keep), "low": left.filter(keep)}), taken


def frequent_items(df: DataFrame, item: str, counters: int = COUNTERS, part: str | Column | None = None,
                   seed: int = 0) -> DataFrame:
    """Summaries of ``item`` per task and value of ``part``, by its hash, so that
    they hold no plaintext: a row ``(part, key, low, 0)`` per key held, whose
    count is at least ``low``, and one ``(part, null, 0, missed)``: no key is
    undercounted by more than ``missed``. Null items are left out; a task holds
    ``counters`` keys for each part it reads."""
    of = F.lit(None).cast("string") if part is None else (F.col(part) if isinstance(part, str) else part).cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = pa.table({"key": pa.array([], pa.int64()), "low": pa.array([], pa.int64())})
        held: dict[str | None, tuple[pa.Table, int]] = {}
        for b in batches:
            for p in pc.unique(b.column(0)).to_pylist():
                mine = pc.is_null(b.column(0)) if p is None else pc.fill_null(pc.equal(b.column(0), p), False)
                counted = pc.value_counts(b.column(1).filter(mine))
                counts = pa.table({"key": counted.field("values"), "low": counted.field("counts")})
                table, missed = held.get(p, (none, 0))
                table, taken = _add(table, counts, counters)
                held[p] = table, missed + taken
        for p, (table, missed) in held.items():
            n = len(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p] * (n + 1), pa.string()), pa.array([*table["key"].to_pylist(), None], pa.int64()),
                 pa.array([*table["low"].to_pylist(), 0], pa.int64()), pa.array([0] * n + [missed], pa.int64())],
                names=["part", "key", "low", "missed"])

    return df.where(F.col(item).isNotNull()).select(of.alias("part"), item_key(item, seed).alias("key")).mapInArrow(run, ITEM_SCHEMA)


def item_key(item: str, seed: int = 0) -> Column:
    return F.xxhash64(F.col(item), F.lit(seed))


def frequent_candidates(summary: DataFrame, k: int) -> tuple[DataFrame, int] | None:
    """``(key, low, high)`` of every key that can be among the ``k`` most
    frequent of the summarised parts (all that can tie for the last place
    included) and the count that the last of them has at least; None if keys
    that no summary holds could be. Fires jobs; ``k`` rows reach the driver."""
    held = summary.where("key is not null").groupBy("key").agg(F.sum("low").alias("low"))
    held = materialize(held, "held")
    missed = summary.agg(F.coalesce(F.sum("missed"), F.lit(0))).first()[0]
    top = held.orderBy(F.desc("low")).limit(k).collect()
    least = top[-1]["low"] if len(top) == k else 0
    if missed and least <= missed:
        return None
    high = F.col("low") + F.lit(missed)
    return held.where(high >= least).select("key", "low", high.alias("high")), least


def top_items(df: DataFrame, item: str, k: int, counters: int = COUNTERS, out: str = "freq",
              growth: int = 8) -> DataFrame:
    """The ``k`` most frequent items with their exact counts (ties: the least
    item), like a count of all items, of which only those that can be among
    them are shuffled. Summaries too small to know them are made again, larger,
    until they do: at the latest when they hold every item. If two frequent
    items share a key, so that the last count is under what the summaries
    promise, keys are drawn anew. ``df`` is read once per summary and once for
    the counts; null items are left out. Fires jobs."""
    for seed in range(64):
        found = None
        while found is None:
            found = frequent_candidates(materialize(frequent_items(df, item, counters, seed=seed), "frequent"), k)
            counters *= growth if found is None else 1
        keys, least = materialize(found[0].select("key"), "candidates"), found[1]
        exact = df.join(keys, item_key(item, seed) == keys["key"], "left_semi").groupBy(item).agg(F.count(F.lit(1)).alias(out))
        rows = exact.orderBy(F.desc(out), F.asc(item)).limit(k).collect()
        if not least or rows[-1][out] >= least:
            return df.sparkSession.createDataFrame(rows, exact.schema)
    raise RuntimeError("frequent items share their keys under every hash")


# Quantiles.

KLL_K = 200
#: Rank error that sketches of this k stay under with 99 % confidence, for one quantile.
KLL_ERROR = 0.0133


def length_sketches(df: DataFrame, part: Column, col: str = "password", k: int = KLL_K) -> DataFrame:
    """``(part, sketch)``: a KLL sketch of the lengths in each part."""
    return df.groupBy(part.alias("part")).agg(F.kll_sketch_agg_bigint(F.length(col).cast("bigint"), F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, depth: int = 5) -> DataFrame:
    """``idx, quantile, value, n``: letter values of all the sketched parts."""
    qs = letter_values(depth)
    merged = sketches.agg(F.kll_merge_agg_bigint("sketch").alias("s"))
    one = lambda i, x: F.struct(F.lit(i).alias("idx"), F.lit(x).alias("quantile"),
                                F.kll_sketch_get_quantile_bigint("s", F.lit(x)).alias("value"),
                                F.kll_sketch_get_n_bigint("s").alias("n"))
    return merged.select(F.explode(F.array(*(one(i, x) for i, x in enumerate(qs)))).alias("q")).select("q.*")


def rank_errors(quantiles: DataFrame, hist: DataFrame, value_col: str = "length", count_col: str = "length_count") -> DataFrame:
    """``quantiles`` with ``rank_error``: how far its quantile lies outside the
    ranks that its value takes up in the histogram (0: inside)."""
    cell = F.struct(F.col(value_col).cast("bigint").alias("v"), F.col(count_col).cast("bigint").alias("c"))
    q = F.struct(*quantiles.columns)
    # A row per length and per quantile: both lists together are one row.
    none = lambda struct, df: F.lit(None).cast(df.select(struct.alias("x")).schema["x"].dataType)
    both = (hist.select(cell.alias("cell"), none(q, quantiles).alias("q"))
            .unionByName(quantiles.select(none(cell, hist).alias("cell"), q.alias("q")))
            .agg(F.collect_list("cell").alias("cells"), F.collect_list("q").alias("qs")))
    r = both.select("cells", F.explode("qs").alias("q"))
    rank = lambda keep: F.aggregate(F.filter("cells", keep), F.lit(0).cast("bigint"), lambda a, x: a + x["c"])
    total = rank(lambda x: F.lit(True))
    lo, hi = rank(lambda x: x["v"] < F.col("q.value")) / total, rank(lambda x: x["v"] <= F.col("q.value")) / total
    return r.select("q.*", F.greatest(F.lit(0.0), lo - F.col("q.quantile"), F.col("q.quantile") - hi).alias("rank_error"))


# Sets of digests.

THETA_LG = 14


def digest_sketches(df: DataFrame, part: Column, digest: str = "digest", lg: int = THETA_LG) -> DataFrame:
    """``(part, sketch)``: a theta sketch of the distinct digests of each part."""
    return df.groupBy(part.alias("part")).agg(F.theta_sketch_agg(digest, F.lit(lg)).alias("sketch"))


def set_sizes(candidates: DataFrame, corpus: DataFrame, lg: int = THETA_LG) -> DataFrame:
    """One row from both sides' part sketches: estimated ``candidates,
    corpus, exposed`` (in both), ``unexposed`` (candidates only) and
    ``error``, three standard errors of the union."""
    sides = (candidates.select(F.col("sketch").alias("a"), F.lit(None).cast("binary").alias("b"))
             .unionByName(corpus.select(F.lit(None).cast("binary").alias("a"), F.col("sketch").alias("b"))))
    both = sides.agg(*(F.theta_union_agg(c, F.lit(lg)).alias(c) for c in ("a", "b")))
    size = F.theta_sketch_estimate
    total = size(F.theta_union("a", "b", F.lit(lg)))
    error = F.when(total <= 2 ** lg, 0).otherwise(F.ceil(total * F.lit(3 * 2 ** (-lg / 2)))).cast("bigint")
    return both.select(size("a").alias("candidates"), size("b").alias("corpus"),
                       size(F.theta_intersection("a", "b")).alias("exposed"),
                       size(F.theta_difference("a", "b")).alias("unexposed"), error.alias("error"))
