"""Plan-shape checks: native encoding, pushdown, exchanges, laziness."""

from keysieve.operators import breach as B
from keysieve.plans.registry import QUERIES, load_all
from keysieve.sources import tables as T

load_all()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sequence_encode_has_no_python(spark, sf_dir):
    plan = _plan(QUERIES["sequence_encode"](spark, sf_dir))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_prunes_columns(spark, sf_dir):
    plan = _plan(QUERIES["group_count_df"](spark, sf_dir))
    # only the join/group columns of customer are read
    assert "ReadSchema: struct<c_nationkey:int,c_mktsegment:string>" in plan


def test_breach_join_single_exchange_per_side(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = B.match_breach(T.candidates(spark, sf_dir), T.breach(spark, sf_dir))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    # exactly one hash exchange on the digest key per join side
    assert plan.count("Exchange hashpartitioning(_digest_key") == 2


def test_operators_fire_no_job(spark, sf_dir):
    from keysieve.operators import metrics as M
    from keysieve.operators import profile
    from keysieve.operators import sampling as S

    # Reading a table looks at a footer; what is built on it runs nothing.
    cand, corpus = T.candidates(spark, sf_dir), T.breach(spark, sf_dir)
    lab = T.labelled(spark, sf_dir)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    B.exposure_by_class(lab, corpus)
    B.match_breach(cand, corpus)
    M.classification_report(M.confusion_long(M.rule_baseline(lab).withColumn(M.TRUE_COL, lab["password_strength"])))
    profile.top_passwords(cand, 10)
    S.balanced_split(lab, 100)
    S.exact_per_class(lab, 10)
    assert len(tracker.getJobIdsForGroup()) == before


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert df.columns == ["password_strength", "candidates", "exposed", "breach_total", "common"]
    assert len(rows) == 3
