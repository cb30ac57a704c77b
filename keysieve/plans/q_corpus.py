"""Queries: the corpus store (reading and renewing it in part) and Bloom reduction."""

from __future__ import annotations

from pyspark.sql import functions as F

from keysieve.config import scratch_path
from keysieve.operators import breach_reduced as R
from keysieve.operators import profile
from keysieve.operators.lineage import materialize
from keysieve.plans.oracle import sql
from keysieve.plans.q_breach import COMMON, MATCH_COLS
from keysieve.plans.registry import query
from keysieve.sources import breach as breach_src
from keysieve.sources import corpus_store as store
from keysieve.sources import tables as T

#: Length of the watch list, a top-k report.
WATCHED = 300
#: Leading bytes of a prefix, each a folder of range files.
LEADS = 256


def new_store(spark, d):
    return store.write_store(T.breach(spark, d), scratch_path(spark, "store"))


@query("breach_pruned_match", sql(f"SELECT {', '.join(MATCH_COLS)} FROM matched"))
def breach_pruned_match(spark, d):
    """All candidates against a corpus store; its folders without a key are not read."""
    return R.match_pruned(T.candidates(spark, d), new_store(spark, d)).select(*MATCH_COLS)


@query("breach_watchlist", sql(f"""
SELECT password, freq, exposed, breach_count FROM (
  SELECT * FROM exposure ORDER BY freq DESC, password LIMIT {WATCHED})"""))
def breach_watchlist(spark, d):
    """The most frequent candidates with their breach counts: their digests are
    pushed into the store's scan, which reads the row groups that may have them."""
    top = profile.top_passwords(T.candidates(spark, d), WATCHED)
    return R.match_pruned(top, new_store(spark, d), how="left").select("password", "freq", "exposed", "breach_count")


@query("breach_bloom_match", sql(f"SELECT {', '.join(MATCH_COLS)} FROM matched"))
def breach_bloom_match(spark, d):
    """The corpus reduced by a Bloom filter of the candidates before its exchange."""
    return R.match_bloom(T.candidates(spark, d), T.breach(spark, d)).select(*MATCH_COLS)


def write_range_files(lines, path):
    """``lines(prefix, value)`` as a folder ``lead=0A/prefix=0A1B2`` of text per
    prefix. A task has whole leading bytes: its commit moves their folders, 256 in
    all, not the up to a million inside, and these are listed a leading byte at a time."""
    lead = F.substring("prefix", 1, 2).alias("lead")
    (lines.select(lead, "prefix", "value").repartition(LEADS, "lead").sortWithinPartitions("lead", "prefix")
     .write.partitionBy("lead", "prefix").text(path))


@query("breach_refresh", sql("SELECT prefix, suffix, breach_count FROM breach"))
def breach_refresh(spark, d):
    """A store of an older corpus brought up to date by range files. In the
    prefixes of the very common digests the store has older counts and a digest that
    is no longer listed; only these are downloaded again."""
    now = materialize(T.breach(spark, d), "breach")
    ranges = breach_src.with_range(now)
    changed = ranges.where(F.col("breach_count") >= COMMON).select("prefix").distinct()
    listed = ranges.join(changed, "prefix", "left_semi")
    stale = listed.select(F.unhex(F.concat("prefix", F.reverse("suffix"))).alias("digest"), F.lit(5).cast("bigint").alias("breach_count"))
    older = F.when(F.col("breach_count") >= COMMON, F.col("breach_count") - 1).otherwise(F.col("breach_count"))
    old = now.withColumn("breach_count", older).unionByName(stale)
    root, source = scratch_path(spark, "store"), scratch_path(spark, "ranges")
    store.write_store(old.groupBy("digest").agg(F.max("breach_count").alias("breach_count")), root)
    write_range_files(listed.withColumn("value", F.concat_ws(":", "suffix", "breach_count")), source)
    store.sync(spark, root, source)
    return breach_src.with_range(store.read_store(spark, root))
