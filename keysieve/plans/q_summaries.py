"""Queries: summaries kept per part (frequent items, quantiles, set sizes) against exact results."""

from __future__ import annotations

from pyspark.sql import functions as F

from keysieve.operators import breach as B
from keysieve.operators import features, profile
from keysieve.operators import summaries as Y
from keysieve.operators.lineage import materialize
from keysieve.plans.oracle import sql
from keysieve.plans.registry import query
from keysieve.sources import tables as T

PARTS = 10


def _part(col="password"):
    return F.pmod(F.xxhash64(col), F.lit(PARTS)).cast("int")


@query("heavy_hitters", sql("""
SELECT password, count(*) AS freq FROM nonblank GROUP BY password
ORDER BY freq DESC, password LIMIT 10"""))
def heavy_hitters(spark, d):
    """The rows of ``top_passwords`` from summaries, then exact counts of what can be among them."""
    return Y.top_items(features.drop_blank(T.raw(spark, d)), "password", 10)


@query("length_quantiles_merged", sql("""
SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7, 8])::INT AS idx,
       unnest([0.5, 0.25, 0.75, 0.125, 0.875, 0.0625, 0.9375, 0.03125, 0.96875])::DOUBLE AS quantile,
       n, true AS within FROM (SELECT count(*) AS n FROM nonblank)"""))
def length_quantiles_merged(spark, d):
    """Letter values of the lengths from a stored sketch per part: every value's
    ranks are within the sketch's error of its quantile."""
    raw = features.drop_blank(T.raw(spark, d))
    sketches = materialize(Y.length_sketches(raw, _part()), "length-sketches")
    checked = Y.rank_errors(Y.merged_quantiles(sketches), profile.length_histogram(raw))
    return checked.select("idx", "quantile", "n", (F.col("rank_error") <= 2 * Y.KLL_ERROR).alias("within"))


@query("exposure_set_sizes", sql("""
SELECT count(*) AS candidates, sum(exposed)::BIGINT AS exposed, sum(1 - exposed)::BIGINT AS unexposed,
       true AS candidates_within, true AS exposed_within, true AS unexposed_within FROM exposure"""))
def exposure_set_sizes(spark, d):
    """Exposed and unexposed candidates counted by the join, and whether the
    estimates from stored sketches of both sides, made without a join, are within their error."""
    cand, corpus = T.candidates(spark, d), T.breach(spark, d)
    digests = B.with_digest(cand).select(F.unhex("sha1").alias("digest"))
    a, b = (materialize(Y.digest_sketches(df, _part("digest")), "digest-sketches") for df in (digests, corpus))
    exact = B.match_breach(cand, corpus, how="left").agg(
        F.count(F.lit(1)).alias("candidates"), F.sum("exposed").cast("bigint").alias("exposed"))
    exact = exact.withColumn("unexposed", F.col("candidates") - F.col("exposed"))
    est = Y.set_sizes(a, b).select(*(F.col(c).alias(f"e_{c}") for c in ("candidates", "exposed", "unexposed")), "error")
    both = exact.unionByName(est, allowMissingColumns=True)  # a row each
    both = both.agg(*(F.max(c).alias(c) for c in both.columns))
    return both.select("candidates", "exposed", "unexposed", *(
        (F.abs(F.col(c) - F.col(f"e_{c}")) <= F.col("error")).alias(f"{c}_within") for c in ("candidates", "exposed", "unexposed")))
