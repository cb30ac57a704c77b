"""Permutation importance: ranks, what is dealt, zero for what does not matter."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from keysieve.operators import importance as P


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rows"))
    (spark.range(3000).select(F.sha1(F.col("id").cast("string")).alias("k"), (F.col("id") % 10).cast("int").alias("a"),
                              (F.col("id") % 7).cast("int").alias("b"), F.lit(5).alias("c"),
                              F.when(F.col("id") % 10 < 5, "x").otherwise("y").alias("label"))
     .repartition(5).write.mode("overwrite").parquet(path))
    return spark.read.parquet(path)


def test_ranks_are_a_numbering(rows):
    r = P.ranked(rows, "k", "s", "r")
    assert sorted(x["r"] for x in r.select("r").collect()) == list(range(3000))
    again = P.ranked(rows.repartition(3), "k", "s", "r")
    assert r.select("k", "r").exceptAll(again.select("k", "r")).isEmpty()


def test_one_feature_is_dealt_and_the_rest_stays(rows):
    out = P.permuted(rows, ["a", "b", "c"], "k").collect()
    base = {r["k"]: (r["a"], r["b"], r["c"]) for r in rows.collect()}
    assert Counter(r["feature"] for r in out) == {None: 3000, "a": 3000, "b": 3000, "c": 3000}
    for i, f in enumerate("abc"):
        mine = [r for r in out if r["feature"] == f]
        assert Counter(r[f] for r in mine) == Counter(v[i] for v in base.values())
        assert all((r["a"], r["b"], r["c"])[j] == base[r["k"]][j] for r in mine for j in range(3) if j != i)
    moved = sum(r["a"] != base[r["k"]][0] for r in out if r["feature"] == "a")
    assert 2500 < moved < 2900  # nine of ten have another value
    assert all((r["a"], r["b"], r["c"]) == base[r["k"]] for r in out if r["feature"] is None)


@pytest.mark.parametrize("seed", [0, 1])
def test_only_the_used_feature_matters(rows, seed):
    score = lambda df: df.withColumn("p", F.when(F.col("a") < 5, "x").otherwise("y"))
    hit = (F.col("p") == F.col("label")).cast("double")
    got = {r["feature"]: r for r in P.permutation_importance(score, rows, ["a", "b", "c"], "k", hit, seed).collect()}
    assert got["b"]["importance"] == got["c"]["importance"] == 0 and got["b"]["accuracy"] == 1
    assert got["a"]["importance"] == pytest.approx(0.5, abs=0.05) and got["a"]["rows"] == 3000


def test_order_holds_over_seeds(spark, sf_dir):
    from keysieve.plans import q_models as Q
    tops = []
    for seed in (0, 1):
        r = Q.permuted_importances(spark, sf_dir, seed).orderBy(F.desc("importance"), "feature").collect()
        assert {x["importance"] for x in r if x["feature"] == "constant"} == {0.0}
        tops.append([x["feature"] for x in r[:3]])
    assert tops[0] == tops[1]
