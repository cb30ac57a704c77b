"""Queries: confusion matrices and classification reports over the rule
baseline's predictions (a length-only predictor, so every metric has an
exact SQL twin)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keysieve.operators import features
from keysieve.operators import intervals as I
from keysieve.operators import metrics as M
from keysieve.operators.sampling import SALT_PARTS, split_ids
from keysieve.plans.oracle import md5_bits, sql
from keysieve.plans.registry import query
from keysieve.sources import tables as T

PARTS = 10


def ruled(spark, d):
    """Labelled candidates with ``true_label`` and the baseline's prediction."""
    lab = T.labelled(spark, d).withColumn(M.TRUE_COL, F.col("password_strength"))
    return M.rule_baseline(lab)


def cells(spark, d):
    return M.confusion_long(ruled(spark, d))


_REPORT_CTES = """
classes AS (SELECT unnest(['weak', 'medium', 'Strong']) AS class),
per AS (
  SELECT c.class,
         coalesce(sum(n) FILTER (WHERE true_label = c.class AND predicted_label = c.class), 0) AS tp,
         coalesce(sum(n) FILTER (WHERE true_label = c.class), 0) AS support,
         coalesce(sum(n) FILTER (WHERE predicted_label = c.class), 0) AS predicted
  FROM classes c, cells GROUP BY c.class),
prf AS (
  SELECT class, tp, support,
         CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS p,
         CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS r
  FROM per WHERE support + predicted > 0),
prf1 AS (
  SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM prf),
tot AS (
  SELECT sum(tp) AS tp, sum(support) AS total, avg(p) AS mp, avg(r) AS mr, avg(f) AS mf,
         sum(p * support) AS wp, sum(r * support) AS wr, sum(f * support) AS wf FROM prf1),
report AS (
  SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
         support::BIGINT AS support FROM prf1
  UNION ALL
  SELECT 'accuracy', round(CASE WHEN total = 0 THEN 0 ELSE tp / total END, 6),
         round(CASE WHEN total = 0 THEN 0 ELSE tp / total END, 6),
         round(CASE WHEN total = 0 THEN 0 ELSE tp / total END, 6), total::BIGINT FROM tot
  UNION ALL
  SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), total::BIGINT FROM tot
  UNION ALL
  SELECT 'weighted avg', round(CASE WHEN total = 0 THEN 0 ELSE wp / total END, 6),
         round(CASE WHEN total = 0 THEN 0 ELSE wr / total END, 6),
         round(CASE WHEN total = 0 THEN 0 ELSE wf / total END, 6), total::BIGINT FROM tot)"""


@query("rule_baseline", sql("SELECT password, true_label, predicted_label FROM ruled"))
def rule_baseline(spark, d):
    return ruled(spark, d).select("password", M.TRUE_COL, M.PRED_COL)


@query("confusion_long", sql("SELECT true_label, predicted_label, n FROM cells"))
def confusion_long(spark, d):
    return cells(spark, d)


@query("confusion_pivot", sql("""
SELECT true_label,
       coalesce(sum(n) FILTER (WHERE predicted_label = 'weak'), 0)::BIGINT AS weak,
       coalesce(sum(n) FILTER (WHERE predicted_label = 'medium'), 0)::BIGINT AS medium,
       coalesce(sum(n) FILTER (WHERE predicted_label = 'Strong'), 0)::BIGINT AS Strong,
       coalesce(sum(n) FILTER (WHERE predicted_label NOT IN ('weak', 'medium', 'Strong')), 0)::BIGINT AS other
FROM cells GROUP BY true_label"""))
def confusion_pivot(spark, d):
    return M.confusion_pivot(cells(spark, d))


@query("classification_report", sql("SELECT * FROM report", _REPORT_CTES))
def classification_report(spark, d):
    return M.classification_report(cells(spark, d))


@query("weighted_metrics", sql("""
SELECT max(precision) FILTER (WHERE class = 'accuracy') AS accuracy,
       max(f1) FILTER (WHERE class = 'weighted avg') AS f1,
       max(precision) FILTER (WHERE class = 'weighted avg') AS weightedPrecision,
       max(recall) FILTER (WHERE class = 'weighted avg') AS weightedRecall
FROM report""", _REPORT_CTES))
def weighted_metrics(spark, d):
    return M.weighted_metrics(cells(spark, d))


@query("accuracy", sql("""
SELECT round(avg((true_label = predicted_label)::INT::DOUBLE), 6) AS accuracy, count(*) AS n
FROM ruled"""))
def accuracy(spark, d):
    return M.accuracy(ruled(spark, d))


@query("accuracy_by_split", sql(f"""
SELECT ({md5_bits('password', SALT_PARTS)} % {PARTS})::INT AS split_id,
       round(avg((true_label = predicted_label)::INT::DOUBLE), 6) AS accuracy, count(*) AS n
FROM ruled GROUP BY 1"""))
def accuracy_by_split(spark, d):
    return M.accuracy(split_ids(ruled(spark, d), PARTS), by=["split_id"])


@query("predicted_distribution", sql(
    "SELECT predicted_label, count(*) AS n FROM ruled GROUP BY 1"))
def predicted_distribution(spark, d):
    return ruled(spark, d).groupBy(M.PRED_COL).agg(F.count(F.lit(1)).alias("n"))


@query("binary_confusion", sql("""
SELECT tp, tn, fp, fn,
       round(CASE WHEN t = 0 THEN 0 ELSE tp * 100.0 / t END, 6) AS tp_pct,
       round(CASE WHEN t = 0 THEN 0 ELSE tn * 100.0 / t END, 6) AS tn_pct,
       round(CASE WHEN t = 0 THEN 0 ELSE fp * 100.0 / t END, 6) AS fp_pct,
       round(CASE WHEN t = 0 THEN 0 ELSE fn * 100.0 / t END, 6) AS fn_pct
FROM (SELECT *, tp + tn + fp + fn AS t FROM (
  SELECT count(*) FILTER (WHERE has_digits = 1 AND has_letter_and_digit = 1) AS tp,
         count(*) FILTER (WHERE has_digits <> 1 AND has_letter_and_digit <> 1) AS tn,
         count(*) FILTER (WHERE has_digits = 1 AND has_letter_and_digit <> 1) AS fp,
         count(*) FILTER (WHERE has_digits <> 1 AND has_letter_and_digit = 1) AS fn
  FROM feats))"""))
def binary_confusion(spark, d):
    """TP/TN/FP/FN of ``has_letter_and_digit`` against the rule "has a digit"."""
    f = features.with_features(T.candidates(spark, d))
    return M.binary_confusion(f, truth="has_letter_and_digit", prediction="has_digits")


def _bootstrap_sql(name: str, by: str, values: str, extra: str = "") -> str:
    """The bootstrap of ``values`` (a mean per row) over hash blocks of ``ruled``."""
    steps = " + ".join(f"(u >= {s})::BIGINT" for s in I.poisson_steps())
    group, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return sql(f"""
SELECT {group}n, round({name}, 6) AS {name}, round(q[1], 6) AS {name}_low, round(q[2], 6) AS {name}_high{extra}
FROM (SELECT {group}any_value(n) AS n, any_value(v / n) AS {name}, quantile_cont(CASE WHEN wn > 0 THEN wv / wn END, [0.025, 0.975]) AS q
      FROM (SELECT {group}r, sum(n)::BIGINT AS n, sum(v) AS v, sum(w * n) AS wn, sum(w * v) AS wv FROM blocks JOIN drawn USING (block)
            GROUP BY {group}r){tail})""", f"""
blocks AS (SELECT {group}block, count(*) AS n, sum({values}) AS v
  FROM (SELECT *, {md5_bits('password', I.SALT_BLOCK)} % {I.BLOCKS} AS block FROM ruled) GROUP BY {group}block),
drawn AS (SELECT block, r, {steps} AS w FROM (
  SELECT b AS block, r, ('0x' || substr(md5(b::VARCHAR || '|{I.SALT_WEIGHT}' || (r // {I.PER_HASH})::VARCHAR), 4 * (r % {I.PER_HASH})::INT + 1, 4))::INT AS u
  FROM range({I.BLOCKS}) t(b), range({I.REPLICATES}) s(r)))""")


@query("accuracy_interval", _bootstrap_sql("accuracy", "true_label", "(true_label = predicted_label)::INT"))
def accuracy_interval(spark, d):
    """Accuracy of the length rule per true class, with bootstrap intervals."""
    return I.accuracy_interval(ruled(spark, d), M.TRUE_COL, M.PRED_COL, "password", [M.TRUE_COL])


@query("accuracy_difference", _bootstrap_sql("difference", "", """(true_label = predicted_label)::INT
  - (true_label = CASE WHEN length < 8 THEN 'weak' WHEN length < 16 THEN 'medium' ELSE 'Strong' END)::INT""",
    ", round(q[1], 6) > 0 OR round(q[2], 6) < 0 AS told_apart"))
def accuracy_difference(spark, d):
    """The length rule against the one that calls strong what has 16 characters
    or more: the paired difference of their accuracies."""
    both = M.rule_baseline(ruled(spark, d), out="second", strong_from=16)
    return I.accuracy_difference(both, M.TRUE_COL, M.PRED_COL, "second", "password")
