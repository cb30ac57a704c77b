"""Fits on the smallest tables: reports, staging, sequence columns."""

import pytest
from pyspark.sql import functions as F

from keysieve.functions import sequence
from keysieve.operators import lineage
from keysieve.operators import metrics as M
from keysieve.plans import q_models as Q
from keysieve.plans.registry import load_all
from keysieve.sources import io

load_all()


def test_staged_input_has_no_plaintext(spark, sf_dir):
    table = Q.staged(spark, sf_dir)
    assert "password" not in table.columns and not set(Q.POSITIONS) & set(table.columns)
    assert set(Q.POSITIONS) <= set(Q.staged(spark, sf_dir, with_sequence=True).columns)
    train, _ = Q.balanced(spark, sf_dir)
    assert train._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_report_of_the_balanced_forest_has_every_class(spark, sf_dir):
    rep = {r["class"]: r for r in Q.REPORTS["rf_balanced"](spark, sf_dir).collect()}
    assert all(rep[c]["support"] > 0 for c in ("weak", "medium", "Strong"))
    assert rep["accuracy"]["precision"] > 0.9


@pytest.fixture(scope="module")
def split(spark, sf_dir):
    return Q.balanced(spark, sf_dir)


def checks(train, pred, floor):
    r = Q.held(train, pred, floor).first()
    assert r["train_rows"] == train.count() and r["test_rows"] == pred.count() and r["classes"] == 3
    return r["macro_f1_ok"], r["recall_ok"]


@pytest.mark.parametrize("floor", [Q.TREE_FLOOR, Q.SEQUENCE_FLOOR])
def test_useless_predictors_fail_the_checks(split, floor):
    train, test = split
    true = test.withColumn(M.TRUE_COL, F.col("password_strength"))
    for c in ("weak", "medium", "Strong"):
        assert checks(train, true.withColumn(M.PRED_COL, F.lit(c)), floor) == (False, False)
    by_chance = F.element_at(F.array(*map(F.lit, ("weak", "medium", "Strong"))), (F.pmod(F.xxhash64("balance_bits"), F.lit(3)) + 1).cast("int"))
    assert checks(train, true.withColumn(M.PRED_COL, by_chance), floor) == (False, False)
    # Right on all but one class.
    no_medium = F.when(F.col(M.TRUE_COL) == "medium", "weak").otherwise(F.col(M.TRUE_COL))
    assert checks(train, true.withColumn(M.PRED_COL, no_medium), floor)[1] is False
    assert checks(train, true.withColumn(M.PRED_COL, F.col(M.TRUE_COL)), floor) == (True, True)


def test_a_model_of_shuffled_labels_fails_the_checks(split):
    from keysieve.operators import models as ML
    train, test = split
    shuffled = train.withColumn("password_strength", F.element_at(
        F.array(*map(F.lit, ("weak", "medium", "Strong"))), (F.pmod(F.xxhash64("balance_bits"), F.lit(3)) + 1).cast("int")))
    model = ML.fit_strength_model(shuffled, ML.random_forest(), ML.STRENGTH_FEATURES)
    ok = checks(train, ML.predict(model, test), Q.SEQUENCE_FLOOR)
    assert ok == (False, False)


def test_scored_set_has_every_held_out_row_once(spark, sf_dir):
    from keysieve.operators import breach as B
    from keysieve.sources import tables as T
    scored = Q.scored_set(spark, sf_dir)
    assert scored.columns == ["sha1", M.TRUE_COL, M.PRED_COL, "common_or_rare", "split_id"]
    _, test = Q.balanced(spark, sf_dir)
    assert scored.count() == scored.select("sha1").distinct().count() == test.count()
    known = B.with_digest(T.labelled(spark, sf_dir)).select("sha1", F.col("password_strength").alias("label"))
    joined = scored.join(known, "sha1")
    assert joined.count() == scored.count() and joined.where(F.col("label") != F.col(M.TRUE_COL)).isEmpty()
    assert scored.where(F.col(M.TRUE_COL) != F.col(M.PRED_COL)).count() < 0.02 * scored.count()


def test_letter_digit_tree_metrics(spark, sf_dir):
    counts, weighted = (df.first() for df in Q.dt_metrics(spark, sf_dir))
    assert sum(counts[f"{c}_pct"] for c in ("tp", "tn", "fp", "fn")) == pytest.approx(100, abs=1e-4)
    assert weighted["accuracy"] > 0.95


def test_importances_are_in_order(spark, sf_dir):
    rows = Q.importances(spark, sf_dir).collect()
    values = [r["importance"] for r in rows]
    assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1)


def test_position_columns_equal_the_encoding(spark):
    df = spark.createDataFrame([(x,) for x in ("", None, "abc", "A9!?", "é€😀", "x" * 40, "İi", "a\tb c")], "password string")
    rows = df.select(sequence.encode("password").alias("e"),
                     F.array(*(sequence.position("password", i) for i in range(sequence.WIDTH))).alias("p")).collect()
    assert all(r["e"] == r["p"] for r in rows)


def test_overwrite_guard_compares_roots(spark, tmp_path):
    p, other = str(tmp_path / "t"), str(tmp_path / "t2")
    spark.range(5).write.parquet(p)
    df = spark.read.parquet(p)
    for target in (p, f"file:{p}", str(tmp_path), f"{p}/part"):
        with pytest.raises(ValueError):
            io.assert_not_reading(df.where("id > 1"), target)
    io.assert_not_reading(df, other)


def test_clean_scratch(spark):
    t = lineage.materialize(spark.range(3), "to-clean")
    assert t.count() == 3 and lineage.clean_scratch(spark)
    assert not lineage.clean_scratch(spark)


def test_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from keysieve.config import checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None)))


def test_accuracy_rule_is_a_share(spark):
    df = spark.createDataFrame([("weak", 3), ("weak", 9)], "true_label string, length int")
    assert M.accuracy(M.rule_baseline(df)).first()["accuracy"] == 0.5
