"""Split/sample invariants and the golden classification report."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from keysieve.operators import metrics as M
from keysieve.operators import sampling as S
from keysieve.sources import tables as T


@pytest.fixture(scope="module")
def labelled(spark, sf_dir):
    return T.labelled(spark, sf_dir).select("password", "password_strength").cache()


def test_balanced_split_partitions_rows(labelled):
    train, test = S.balanced_split(labelled, 100)
    n, a, b = labelled.count(), train.count(), test.count()
    assert a + b == n
    assert train.join(test, "password").count() == 0


def test_split_stable_under_repartition(labelled):
    a = S.train_test_split(labelled).where("split = 'train'").select("password")
    b = S.train_test_split(labelled.repartition(7)).where("split = 'train'").select("password")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fraction_capped_for_small_class(labelled):
    fr = {r[0]: r[1] for r in S.class_fractions(labelled, 10 ** 9).collect()}
    assert all(v == S.MAX_FRACTION for v in fr.values())
    train, test = S.balanced_split(labelled, 10 ** 9, max_fraction=1.0)
    assert test.count() == 0 and train.count() == labelled.count()


def test_every_class_keeps_held_out_rows(labelled):
    _, test = S.balanced_split(labelled, 10 ** 9)
    assert test.select("password_strength").distinct().count() == labelled.select("password_strength").distinct().count()


def test_null_keys_and_labels_are_held_out(spark):
    df = spark.createDataFrame([(None, "weak"), ("a", None), ("b", "weak"), ("c", "weak")],
                               "password string, password_strength string")
    train, test = S.balanced_split(df, 10, max_fraction=1.0)
    assert sorted(train.collect()) == [("b", "weak"), ("c", "weak")]
    assert test.count() == 2


def test_repeated_keys_count_once(spark):
    df = spark.createDataFrame([("hot", "weak")] * 500 + [(f"p{i}", "weak") for i in range(5)],
                               "password string, password_strength string")
    got = S.exact_per_class(df, 6).collect()
    assert len(got) == len(set(got)) == 6


def test_report_covers_classes_that_are_not_listed(spark):
    cells = spark.createDataFrame([("weak", "weak", 5), ("other", "other", 5), ("other", "weak", 4), (None, "weak", 1)],
                                  f"{M.TRUE_COL} string, {M.PRED_COL} string, n bigint")
    rep = {r["class"]: r for r in M.classification_report(cells).collect()}
    assert set(rep) == {"weak", "other", "null", "accuracy", "macro avg", "weighted avg"}
    assert rep["accuracy"]["precision"] == pytest.approx(10 / 15, abs=1e-6) and rep["accuracy"]["support"] == 15
    assert rep["other"]["recall"] == pytest.approx(5 / 9, abs=1e-6) and rep["weak"]["precision"] == 0.5
    listed = {r["class"] for r in M.classification_report(cells, ["weak", "absent"]).collect()}
    assert listed == set(rep) | {"absent"}
    pivot = {r[M.TRUE_COL]: r["other"] for r in M.confusion_pivot(cells).collect()}
    assert "other" not in M.confusion_pivot(cells, other=False).columns
    assert pivot == {"weak": 0, "other": 5, None: 0}


def test_exact_per_class_equals_window(labelled):
    n = 40
    got = S.exact_per_class(labelled, n)
    h = labelled.withColumn("_h", S.hash_bits("password", S.SALT_BALANCE))
    w = Window.partitionBy("password_strength").orderBy("_h", "password")
    ref = h.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n).select(*labelled.columns)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    counts = {r[0]: r[1] for r in got.groupBy("password_strength").count().collect()}
    sizes = {r[0]: r[1] for r in labelled.groupBy("password_strength").count().collect()}
    assert counts == {k: min(n, v) for k, v in sizes.items()}


def test_holdout_equals_complement(labelled):
    train, test = S.balanced_split(labelled, 100)
    anti = S.holdout(labelled, train)
    assert anti.exceptAll(test).count() == 0 and test.exceptAll(anti).count() == 0


def test_kfold_range(labelled):
    folds = {r[0] for r in S.kfold(labelled, 3).select("fold").distinct().collect()}
    assert folds == {0, 1, 2}


# Confusion counts published with the reference's sequence model run
# (rows = true, columns = predicted; order weak, medium, Strong).
GOLDEN = [[10110330, 15231, 13], [281728, 3527790, 281130], [24, 156, 22057]]


def test_golden_report(spark):
    rep = {r["class"]: r for r in M.classification_report(M.cells_from_matrix(spark, GOLDEN)).collect()}
    assert rep["accuracy"]["precision"] == pytest.approx(0.959386, abs=1e-6)
    for cls, p, r, f in [("weak", 0.97289, 0.99849, 0.98552), ("medium", 0.99566, 0.86240, 0.92425),
                         ("Strong", 0.07275, 0.99190, 0.13555)]:
        assert rep[cls]["precision"] == pytest.approx(p, abs=1e-5)
        assert rep[cls]["recall"] == pytest.approx(r, abs=1e-5)
        assert rep[cls]["f1"] == pytest.approx(f, abs=1e-5)
    assert rep["macro avg"]["f1"] == pytest.approx(0.68178, abs=1e-5)
    assert rep["weighted avg"]["f1"] == pytest.approx(0.96659, abs=1e-5)
    assert rep["weak"]["support"] == 10125574


def test_pivot_total_equals_rows(spark, labelled):
    pred = M.rule_baseline(T.labelled(spark, "/root/testdata/sf0.001")
                           .withColumn(M.TRUE_COL, F.col("password_strength")))
    piv = M.confusion_pivot(M.confusion_long(pred))
    total = piv.select(sum(F.col(c) for c in ["weak", "medium", "Strong"]).alias("t")) \
        .agg(F.sum("t")).first()[0]
    assert total == labelled.count()


def test_union_form_has_every_class_that_occurs(spark):
    rows = [(f"w{i}", "weak") for i in range(400)] + [(f"o{i}", "other") for i in range(300)] + [("n", None)]
    df = spark.createDataFrame(rows, "password string, password_strength string")
    train, _ = S.balanced_split(df, 100)
    union = S.sample_by_class_union(df, 100)
    assert train.exceptAll(union).count() == 0 and union.exceptAll(train).count() == 0
    assert {r[0] for r in union.select("password_strength").distinct().collect()} == {"weak", "other"}
    assert {r[1] for r in S.sample_by_class_union(df, 100, classes=["other"]).collect()} == {"other"}
