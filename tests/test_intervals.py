"""Bootstrap intervals, the weighted sample and the SQL functions against plain versions."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from keysieve.functions import charclass as cc
from keysieve.functions import sequence, sql_surface
from keysieve.operators import features
from keysieve.operators import intervals as I
from keysieve.operators import sampling as S


def scored(spark, n=20_000, share=0.8):
    u = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1000)) / 1000
    return spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit("a").alias("t"),
                                 F.when(u < share, "a").otherwise("b").alias("p"), F.lit("b").alias("never"))


def test_steps_are_those_of_the_distribution():
    steps = I.poisson_steps()
    assert steps[:3] == [round(65536 * x) for x in (math.exp(-1), 2 * math.exp(-1), 2.5 * math.exp(-1))]
    mean = sum(65536 - s for s in steps) / 65536
    assert mean == pytest.approx(1, abs=1e-4)


def test_weights_are_poisson(spark):
    w = spark.range(2000).select(F.explode(F.sequence(F.lit(0), F.lit(49))).alias("r"), F.col("id").alias("b"))
    row = w.select(I.weight(F.col("b"), F.col("r")).alias("w")).agg(
        F.avg("w"), F.var_samp("w"), F.avg((F.col("w") == 0).cast("int"))).first()
    assert row[0] == pytest.approx(1, abs=0.02) and row[1] == pytest.approx(1, abs=0.05)
    assert row[2] == pytest.approx(math.exp(-1), abs=0.01)


def test_width_is_that_of_the_binomial(spark):
    for share in (0.5, 0.9):
        r = I.accuracy_interval(scored(spark, share=share), "t", "p", "k").first()
        width = 2 * 1.96 * math.sqrt(share * (1 - share) / 20_000)
        assert r["n"] == 20_000 and r["accuracy_low"] < r["accuracy"] < r["accuracy_high"]
        assert r["accuracy_high"] - r["accuracy_low"] == pytest.approx(width, rel=0.3)


def test_partitioning_does_not_matter_and_groups_are_apart(spark):
    df = scored(spark, 3000).withColumn("g", F.col("k").cast("int") % 2)
    rows = lambda x: sorted(map(tuple, x.collect()))
    both = I.accuracy_interval(df, "t", "p", "k", ["g"])
    assert rows(both) == rows(I.accuracy_interval(df.repartition(7), "t", "p", "k", ["g"]))
    alone = I.accuracy_interval(df.where("g = 1"), "t", "p", "k").first()
    assert tuple(alone) == tuple(both.where("g = 1").drop("g").first())


def test_paired_difference(spark):
    df = scored(spark).withColumn("q", F.when(F.pmod("k", F.lit(100)) == 0, "b").otherwise(F.col("p")))
    worse = I.accuracy_difference(df, "t", "p", "q", "k").first()
    assert worse["told_apart"] and 0 < worse["difference_low"] < worse["difference"] < 0.012
    same = I.accuracy_difference(df, "t", "p", "p", "k").first()
    assert not same["told_apart"] and same["difference"] == same["difference_low"] == 0
    # Noise of the same size on both sides can't be told apart; unpaired intervals would be far wider.
    noise = F.pmod(F.xxhash64("k", F.lit(5)), F.lit(200))
    df = df.withColumn("x", F.when(noise == 0, "b").otherwise("a")).withColumn("y", F.when(noise == 1, "b").otherwise("a"))
    r = I.accuracy_difference(df, "t", "x", "y", "k").first()
    assert r["difference_high"] - r["difference_low"] < 0.01 and abs(r["difference"]) < 0.005


def test_odd_rows_of_a_bootstrap(spark):
    schema = "k string, t string, p string"
    assert I.accuracy_interval(spark.createDataFrame([], schema), "t", "p", "k").isEmpty()
    one = I.accuracy_interval(spark.createDataFrame([("x", "a", "a")], schema), "t", "p", "k").first()
    assert tuple(one) == (1, 1.0, 1.0, 1.0)
    odd = spark.createDataFrame([(None, "a", "a"), (None, None, None), ("x", "a", None), ("x", "a", "b")], schema)
    assert I.accuracy_interval(odd, "t", "p", "k").first()["accuracy"] == 0.5


def key_of(p, w):
    bits = int(hashlib.md5(f"{p}|{S.SALT_WEIGHTED}".encode()).hexdigest()[:8], 16)
    return -math.log((bits + 0.5) / 2 ** 32) / w


@pytest.mark.parametrize("n", [0, 1, 37, 1500, 5000])
def test_weighted_sample_is_the_least_keys(spark, n):
    r = random.Random(2)
    rows = [(f"p{i}", r.choice([1, 1, 2, 50])) for i in range(2000)] + [("none", 0), ("null", None), ("less", -3)]
    got = S.weighted_sample(spark.createDataFrame(rows, "password string, freq long"), n)
    want = sorted((x for x in rows if x[1] and x[1] > 0), key=lambda x: (key_of(*x), x[0]))[:n]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_weights_decide_the_chances(spark):
    rows = [(f"h{i}", 9) for i in range(3000)] + [(f"l{i}", 1) for i in range(3000)]
    got = S.weighted_sample(spark.createDataFrame(rows, "password string, freq long"), 300)
    heavy = got.where("freq = 9").count()
    assert got.count() == 300 and 240 < heavy < 295


ODD = ["", " ", "abc", "ABC", "123", "aB3$", "pässwörd1!", "a b", "it's", 'say "x"', "back\\slash", "\t\n", "x" * 40, None,
       "A9!longer_than_8", "é€😀", "İi", "|;:',.<>/?", "`~"]


def test_sql_functions_are_the_column_functions(spark):
    sql_surface.register(spark)
    df = spark.createDataFrame([(x,) for x in ODD], "password string")
    df.createOrReplaceTempView("odd_strings")
    lab = features.label(df).withColumns({
        "blank": cc.is_blank("password"), "enc": sequence.encode("password"), "sha": F.upper(F.sha1("password")),
        "band": cc.frequency_band(F.length("password").cast("bigint"))})
    flags = ", ".join(f"pw_{c}(password) AS {c}" for c in cc.FLAG_COLUMNS)
    out = spark.sql(f"""SELECT password, {flags}, pw_score(password) AS score, pw_strength(password) AS password_strength,
        pw_is_blank(password) AS blank, pw_encode(password) AS enc, pw_sha1(password) AS sha,
        pw_band(CAST(length(password) AS BIGINT)) AS band FROM odd_strings""")
    want = lab.select(*out.columns).collect()
    assert sorted(map(str, out.collect())) == sorted(map(str, want))
    parts = spark.sql("SELECT pw_range_prefix('password') || pw_range_suffix('password') = pw_sha1('password')").first()[0]
    assert parts is True


def test_sql_functions_run_no_python_and_can_be_renamed(spark):
    names = sql_surface.register(spark, "keysieve_")
    assert "keysieve_strength" in names
    plan = spark.sql("SELECT keysieve_strength(CAST(id AS STRING)) AS s, keysieve_encode('a') AS e FROM range(10)") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "WholeStageCodegen" in plan or "Project" in plan
