"""Queries: hash sampling, splits, folds and class balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from keysieve.operators import sampling as S
from keysieve.operators.lineage import materialize
from keysieve.plans.oracle import md5_bits, sql
from keysieve.plans.registry import query
from keysieve.sources import tables as T

SAMPLE_FRACTION = 0.01
LIMITED_FRACTION = 0.5
LIMITED_ROWS = 10000
WEIGHTED_ROWS = 5000
TRAIN_FRACTION = 0.8
FOLDS = 3
PER_CLASS = 15000
EXACT_PER_CLASS = 1000

BALANCED_CTES = f"""balfrac AS (
  SELECT password_strength, least({S.MAX_FRACTION}::DOUBLE, {PER_CLASS}::DOUBLE / count(*)) AS f
  FROM labelled GROUP BY 1),
baltag AS (
  SELECT l.password, l.password_strength,
         {md5_bits('l.password', S.SALT_BALANCE)} < f * 4294967296 AS in_train
  FROM labelled l JOIN balfrac USING (password_strength))"""


def _labelled(spark, d):
    """(password, label) of every candidate. The balancing queries read it more
    than once (class counts, histogram, branches); it is not staged, as it is
    plaintext, and the branches of a plan share its exchange."""
    return T.labelled(spark, d).select("password", "password_strength")


@query("hash_sample", sql(f"""
SELECT password, freq FROM candidates
WHERE {md5_bits('password', S.SALT_SAMPLE)} < {SAMPLE_FRACTION} * 4294967296"""))
def hash_sample(spark, d):
    return S.hash_sample(T.candidates(spark, d), SAMPLE_FRACTION)


@query("native_sample", sql(f"""
SELECT count(*) AS rows, true AS near_the_mean, 0::BIGINT AS foreign_rows FROM candidates"""))
def native_sample(spark, d):
    """Spark's Bernoulli sample, 1 %, seed 42: its size is within six standard
    deviations of the mean, and it has rows of the table only."""
    cand = materialize(T.candidates(spark, d).select(F.sha1("password").alias("sha1"), "freq"), "digests")
    sample = materialize(S.native_sample(cand, SAMPLE_FRACTION, seed=42), "sample")
    foreign = sample.join(cand, ["sha1", "freq"], "left_anti")
    parts = (cand.select(F.lit("rows").alias("of")).unionByName(sample.select(F.lit("sampled").alias("of")))
             .unionByName(foreign.select(F.lit("foreign").alias("of"))))
    n, p = F.col("rows"), SAMPLE_FRACTION
    return parts.agg(*(F.count_if(F.col("of") == c).alias(c) for c in ("rows", "sampled", "foreign"))).select(
        "rows", (F.abs(F.col("sampled") - n * p) <= 6 * F.sqrt(n * p * (1 - p))).alias("near_the_mean"),
        F.col("foreign").alias("foreign_rows"))


@query("limited_sample", sql(f"""
SELECT password, freq FROM candidates
WHERE {md5_bits('password', S.SALT_SAMPLE)} < {LIMITED_FRACTION} * 4294967296
ORDER BY {md5_bits('password', S.SALT_SAMPLE)}, password LIMIT {LIMITED_ROWS}"""))
def limited_sample(spark, d):
    return S.limited_sample(T.candidates(spark, d), LIMITED_FRACTION, LIMITED_ROWS)


@query("weighted_sample", sql(f"""
SELECT password, freq FROM candidates
ORDER BY -ln(({md5_bits('password', S.SALT_WEIGHTED)}::DOUBLE + 0.5) / 4294967296.0) / freq, password LIMIT {WEIGHTED_ROWS}"""))
def weighted_sample(spark, d):
    """A fixed number of candidates, drawn without replacement by their frequency."""
    return S.weighted_sample(T.candidates(spark, d), WEIGHTED_ROWS)


@query("train_test_split", sql(f"""
SELECT password, CASE WHEN {md5_bits('password', S.SALT_SPLIT)} < {TRAIN_FRACTION} * 4294967296
                      THEN 'train' ELSE 'test' END AS split
FROM candidates"""))
def train_test_split(spark, d):
    return S.train_test_split(T.candidates(spark, d).select("password"), TRAIN_FRACTION)


@query("kfold_assign", sql(f"""
SELECT password, ({md5_bits('password', S.SALT_FOLD)} % {FOLDS})::INT AS fold FROM candidates"""))
def kfold_assign(spark, d):
    return S.kfold(T.candidates(spark, d).select("password"), FOLDS)


@query("balanced_train", sql(
    "SELECT password, password_strength FROM baltag WHERE in_train", BALANCED_CTES))
def balanced_train(spark, d):
    """Balancing reads its input twice: class counts, then the filter."""
    train, _ = S.balanced_split(_labelled(spark, d), PER_CLASS)
    return train


@query("balanced_test", sql(
    "SELECT password, password_strength FROM baltag WHERE NOT in_train", BALANCED_CTES))
def balanced_test(spark, d):
    _, test = S.balanced_split(_labelled(spark, d), PER_CLASS)
    return test


@query("union_by_class", sql(
    "SELECT password, password_strength FROM baltag WHERE in_train", BALANCED_CTES))
def union_by_class(spark, d):
    """Per-class filter + sample, then union."""
    return S.sample_by_class_union(_labelled(spark, d), PER_CLASS)


@query("holdout_anti_join", sql(
    "SELECT password, password_strength FROM baltag WHERE NOT in_train", BALANCED_CTES))
def holdout_anti_join(spark, d):
    """Test set as all rows minus the training keys."""
    full = _labelled(spark, d)
    train, _ = S.balanced_split(full, PER_CLASS)
    return S.holdout(full, train)


@query("balanced_exact", sql(f"""
SELECT password, password_strength FROM (
  SELECT password, password_strength,
         row_number() OVER (PARTITION BY password_strength
                            ORDER BY {md5_bits('password', S.SALT_BALANCE)}, password) AS r
  FROM labelled) WHERE r <= {EXACT_PER_CLASS}"""))
def balanced_exact(spark, d):
    """Two passes over the input: bucket histogram, selection."""
    return S.exact_per_class(_labelled(spark, d), EXACT_PER_CLASS)


@query("balanced_class_counts", sql("""
SELECT password_strength, count(*) FILTER (WHERE in_train) AS train_rows,
       count(*) FILTER (WHERE NOT in_train) AS test_rows FROM baltag GROUP BY 1""", BALANCED_CTES))
def balanced_class_counts(spark, d):
    """Per class: training rows and held-out rows of the balanced split."""
    tagged = S.balanced_flags(_labelled(spark, d), PER_CLASS)
    return tagged.groupBy("password_strength").agg(
        F.count_if("in_train").alias("train_rows"),
        F.count_if(~F.col("in_train")).alias("test_rows"))
