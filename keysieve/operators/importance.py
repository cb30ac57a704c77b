"""Permutation importance: how much worse a model gets when one feature's
values are dealt anew among the rows.

Rows get a rank by a hash of their key; donors are the same rows ranked by
another hash, and each row meets the donor of its own rank. Ranks are global
without a global sort: a histogram of hash buckets gives every bucket its
offset, and rows are numbered inside their bucket. All permuted features are
scored in one pass, as copies of a row that differ from it in one feature.

Keys should be distinct; rows that repeat one are ranked in any order. A
feature with one value, or one that the model does not use, has importance 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keysieve.functions.digest import hash_bits
from keysieve.operators.lineage import materialize

#: Hash buckets of a ranking; a task numbers the rows of some of them.
BUCKETS = 4096


def ranked(df: DataFrame, key: str, salt: str, out: str) -> DataFrame:
    """``df`` with ``out``: its rows' ranks from 0 by the hash of ``key``."""
    h = df.withColumn("_h", hash_bits(key, salt)).withColumn("_b", F.col("_h") % BUCKETS)
    sizes = h.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))  # BUCKETS rows at most
    offsets = sizes.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)) - 1
    return h.join(F.broadcast(offsets), "_b").withColumn(out, F.col("_before") + place).drop("_h", "_b", "_before")


def permuted(rows: DataFrame, features: list[str], key: str, seed: int = 0) -> DataFrame:
    """``rows`` (a table) once as they are, with ``feature`` null, and once per
    feature, named in ``feature``, with that feature's values from the donors."""
    left = ranked(rows, key, f"row{seed}", "_rank")
    donors = ranked(rows.select(key, *features), key, f"donor{seed}", "_rank").select("_rank", F.struct(*features).alias("_donor"))
    met = left.join(donors, "_rank").withColumn("feature", F.explode(F.array(F.lit(None).cast("string"), *map(F.lit, features))))
    value = lambda c: F.when(F.col("feature") == c, F.col("_donor")[c]).otherwise(F.col(c))
    return met.withColumns({c: value(c) for c in features}).drop("_rank", "_donor")


def permutation_importance(score: Callable[[DataFrame], DataFrame], rows: DataFrame, features: list[str], key: str,
                           hit: Column, seed: int = 0) -> DataFrame:
    """Per feature: ``feature, rows, accuracy`` (with its values dealt anew) and
    ``importance``, what that lost of the accuracy. ``score`` adds a model's
    predictions to rows, ``hit`` is 1 where a scored row is right."""
    scored = score(permuted(rows, features, key, seed))
    # One more row than features.
    per = materialize(scored.groupBy("feature").agg(F.count(F.lit(1)).alias("rows"), F.avg(hit).alias("accuracy")), "importance")
    base = F.max(F.when(F.col("feature").isNull(), F.col("accuracy"))).over(Window.partitionBy(F.lit(1)))
    out = per.withColumn("importance", F.round(base - F.col("accuracy"), 6)).where("feature is not null")
    return out.select("feature", "rows", F.round("accuracy", 6).alias("accuracy"), "importance")
