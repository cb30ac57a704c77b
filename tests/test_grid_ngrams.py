"""Resumable grid search; hashed n-grams against a plain loop."""

import hashlib

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from keysieve.functions import ngrams
from keysieve.operators import grid as G
from keysieve.operators import models as ML


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(600).select((F.col("id") % 7).cast("double").alias("a"), (F.pmod(F.xxhash64("id"), F.lit(5))).cast("double").alias("b"),
                                 (F.col("id") % 3).cast("int").alias("fold"))
    df = df.withColumn("label", (F.col("a") + F.col("b") > 5).cast("double"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def tree(depth=3):
    est = DecisionTreeClassifier(labelCol="label", featuresCol="features", maxDepth=depth, seed=1)
    return est, ML.depth_impurity_grid(est, depths=(1, 4), impurities=("gini",))


def test_a_run_that_died_goes_on(spark, table, tmp_path, monkeypatch):
    est, points = tree()
    root, whole, made = str(tmp_path / "grid"), G._run, []

    def dies(train, estimator, grid, fit, *rest):
        if len(made) == 4:
            raise RuntimeError("driver lost")
        made.append(fit)
        whole(train, estimator, grid, fit, *rest)

    monkeypatch.setattr(G, "_run", dies)
    with pytest.raises(RuntimeError):
        G.search(table, est, points, root, range(3), parallelism=1)
    monkeypatch.setattr(G, "_run", whole)
    scores, fitted = G.search(table, est, points, root, range(3))
    assert fitted == 2 and scores.count() == 6
    assert G.search(table, est, points, root, range(3))[1] == 0
    # Same numbers as in one go.
    again, n = G.search(table, est, points, str(tmp_path / "other"), range(3))
    assert n == 6 and sorted(map(tuple, again.collect())) == sorted(map(tuple, scores.collect()))
    assert G.best_point(scores) == 1 and {r["folds"] for r in G.mean_scores(scores).collect()} == {3}


def test_points_in_another_order_and_another_estimator(table, tmp_path):
    est, points = tree()
    root = str(tmp_path / "grid")
    first = {(r["parameters"], r["fold"]): r["metric"] for r in G.search(table, est, points, root, range(3))[0].collect()}
    scores, fitted = G.search(table, est, points[::-1], root, range(3))
    assert fitted == 0 and {(r["parameters"], r["fold"]): r["metric"] for r in scores.collect()} == first
    assert G.best_point(scores) == 0
    other = est.copy({est.minInstancesPerNode: 9})
    assert G.search(table, other, points, root, range(3))[1] == 6
    assert G.search(table, est, points, root, range(3), metric="f1")[1] == 6


def plain(p, n=ngrams.BUCKETS):
    s = ngrams.START + (p or "").lower() + ngrams.END
    cut = [s[i:i + k] for k in ngrams.SIZES for i in range(len(s) - k + 1)]
    return [int(hashlib.md5(f"{g}|{ngrams.SALT}".encode()).hexdigest()[:8], 16) % n for g in cut]


def test_buckets_are_those_of_a_plain_loop(spark):
    rows = ["", "a", "ab", "Passw0rd!", None, "é€x", "aaaa", "x" * 50]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "k int, p string")
    for n in (ngrams.BUCKETS, 7):
        got = {r["k"]: r["b"] for r in df.select("k", ngrams.buckets("p", n=n).alias("b")).collect()}
        assert got == {k: plain(x, n) for k, x in enumerate(rows)}


def test_vectors_count_the_grams(spark):
    df = spark.createDataFrame([("abcabc", "weak"), ("xyz", "medium"), ("abd", "weak")], "p string, password_strength string")
    df = df.withColumn("grams", ngrams.buckets("p"))
    model = ML.fit_ngram_model(df, max_iter=3)
    for r in model.transform(df).collect():
        assert r["features"].size == 1 << 12 and r["features"].values.sum() == len(r["grams"])
        assert r["features"].numNonzeros() <= len(set(r["grams"]))
    assert "predicted_label" in model.transform(df).columns


def test_staged_grams_are_numbers(spark, sf_dir):
    from keysieve.plans import q_models as Q
    table = Q.staged(spark, sf_dir, with_grams=True)
    assert dict(table.dtypes)["grams"] == "array<int>" and "password" not in table.columns
