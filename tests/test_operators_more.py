"""Cross-checks: evaluator vs SQL report, join strategies, sinks."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from keysieve.operators import breach as B
from keysieve.operators import metrics as M
from keysieve.sources import io
from keysieve.sources import tables as T


def test_evaluator_agrees_with_sql_report(spark, sf_dir):
    pred = M.rule_baseline(T.labelled(spark, sf_dir).withColumn(M.TRUE_COL, F.col("password_strength")))
    code = F.create_map(*[x for i, c in enumerate(["weak", "medium", "Strong"])
                          for x in (F.lit(c), F.lit(float(i)))])
    num = pred.select(code[F.col(M.TRUE_COL)].alias("label"),
                      code[F.col(M.PRED_COL)].alias("prediction"))
    ours = M.weighted_metrics(M.confusion_long(pred)).first().asDict()
    for metric in ("accuracy", "f1", "weightedPrecision", "weightedRecall"):
        ev = MulticlassClassificationEvaluator(metricName=metric)
        assert ours[metric] == pytest.approx(ev.evaluate(num), abs=1e-6), metric


def test_join_strategies_agree(spark, sf_dir):
    cand, corpus = T.candidates(spark, sf_dir), T.breach(spark, sf_dir)
    rows = {}
    for s, bound in (("auto", None), ("broadcast", 10**6), ("broadcast", 1)):
        rows[s, bound] = sorted(map(tuple, B.match_breach(cand, corpus, strategy=s, broadcast_max_rows=bound)
                                    .select("password", "breach_count").collect()))
    assert rows["auto", None] == rows["broadcast", 10**6] == rows["broadcast", 1] != []
    with pytest.raises(ValueError):
        B.match_breach(cand, corpus, strategy="broadcast")


def test_left_join_keeps_every_candidate(spark, sf_dir):
    cand, corpus = T.candidates(spark, sf_dir), T.breach(spark, sf_dir)
    left = B.match_breach(cand, corpus, how="left")
    assert left.count() == cand.count()
    inner = B.match_breach(cand, corpus).count()
    assert left.where("exposed = 1").count() == inner
    assert left.where("exposed = 0 AND breach_count <> 0").count() == 0
    semi = B.match_breach(cand, corpus, how="left_semi").count()
    anti = B.match_breach(cand, corpus, how="left_anti").count()
    assert semi == inner and semi + anti == cand.count()


def test_null_password_never_matches(spark):
    cand = spark.createDataFrame([(None,), ("password",)], "password string")
    corpus = spark.createDataFrame([(bytearray.fromhex("5BAA61E4C9B93F3F0682250B6CF8331B7EE68FD8"), 7)],
                                   "digest binary, breach_count bigint")
    got = {r["password"]: (r["breach_count"], r["exposed"])
           for r in B.match_breach(cand, corpus, how="left").collect()}
    assert got == {None: (0, 0), "password": (7, 1)}


def test_refuses_to_overwrite_input(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(10).write.parquet(p)
    df = spark.read.parquet(p).where("id > 2")
    with pytest.raises(ValueError):
        io.write_parquet(df, p, mode="overwrite")
    assert spark.read.parquet(p).count() == 10


def test_stage_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    p = str(tmp_path / "stage")
    a = io.stage(spark, p, build)
    b = io.stage(spark, p, build)
    assert len(calls) == 1 and a.count() == b.count() == 5


def test_parts_prune(spark, sf_dir, tmp_path):
    lab = T.labelled(spark, sf_dir).select("password")
    p = str(tmp_path / "parts")
    io.write_parts(lab, p, 10)
    total = sum(io.read_part(spark, p, i).count() for i in range(10))
    assert total == lab.count()
    plan = io.read_part(spark, p, 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split_id" in plan
