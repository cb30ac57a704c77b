"""A single value holding a third of all rows: exact results, combined map-side."""

from pyspark.sql import functions as F

from keysieve.operators import breach as B
from keysieve.operators import features, profile
from keysieve.operators import sampling as S


def _skewed(spark, n=30000):
    # one third "123456", the rest distinct
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("123456"))
        .otherwise(F.concat(F.lit("pw"), F.col("id").cast("string"))).alias("password")
    ).repartition(8)


def test_hot_password_frequency_exact_and_partial(spark):
    df = _skewed(spark)
    freq = profile.password_frequency(df)
    top = profile.top_passwords(freq, 1).first()
    assert (top["password"], top["freq"]) == ("123456", 10000)
    assert shuffled_rows(freq, "password") <= 8 * 20001  # at most a row per value and input partition
    hot = df.where("password = '123456'")
    assert shuffled_rows(profile.password_frequency(hot), "password") <= 8  # 10,000 rows, combined


def shuffled_rows(df, key):
    """Rows that the exchange on ``key`` wrote when the frame was computed."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        if name == "Exchange" and f"hashpartitioning({key}" in node.toString().split("\n")[0]:
            total += node.metrics().apply("shuffleRecordsWritten").value()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return total


def test_hot_password_hashed_once_in_match(spark):
    df = _skewed(spark)
    cand = df.groupBy("password").agg(F.count(F.lit(1)).alias("freq"))
    corpus = B.with_digest(spark.createDataFrame([("123456",)], "password string")) \
        .select(F.unhex("sha1").alias("digest"), F.lit(7).cast("bigint").alias("breach_count"))
    m = B.match_breach(cand, corpus)
    r = m.first()
    assert m.count() == 1 and (r["password"], r["freq"], r["breach_count"]) == ("123456", 10000, 7)


def test_class_balancing_with_dominant_class(spark):
    lab = features.label(_skewed(spark).distinct())
    train, test = S.balanced_split(lab, 50)
    assert train.count() + test.count() == lab.count()
    got = S.exact_per_class(lab, 50).groupBy("password_strength").count().collect()
    assert all(r["count"] == 50 for r in got)
