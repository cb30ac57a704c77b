"""Summaries per part: guarantees, merging, errors."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from keysieve.operators import profile
from keysieve.operators import summaries as Y


def strings(spark, rows, slices=4):
    return spark.createDataFrame([(r,) for r in rows], "password string").repartition(slices)


@pytest.fixture(scope="module")
def zipf():
    r = random.Random(4)
    rows = [f"w{min(int(r.paretovariate(0.9)), 5000)}" for _ in range(40_000)] + ["only once %d" % i for i in range(5000)]
    r.shuffle(rows)
    return rows


def keys(spark, rows):
    """key -> item."""
    df = strings(spark, sorted(set(rows)))
    return {r["k"]: r["password"] for r in df.select("password", Y.item_key("password").alias("k")).collect()}


def test_bounds_hold_for_every_item(spark, zipf):
    true, name = Counter(zipf), keys(spark, zipf)
    df = Y.frequent_items(strings(spark, [*zipf, None]), "password", counters=50)
    assert "string" not in dict(df.drop("part").dtypes).values()
    s = df.collect()
    missed = sum(r["missed"] for r in s)
    low = Counter()
    for r in s:
        if r["key"] is not None:
            low[name[r["key"]]] += r["low"]
    assert 0 < missed <= len(zipf) / 50
    assert all(low[x] <= n <= low[x] + missed for x, n in true.items())
    assert max(Counter(r["part"] for r in s).values()) <= 4 * 51


@pytest.mark.parametrize("k, counters", [(1, 10), (10, 64), (10, 4096), (200, 16), (100_000, 8)])
def test_top_items_are_exact(spark, zipf, k, counters):
    df = strings(spark, [*zipf, None])
    want = sorted(Counter(zipf).items(), key=lambda x: (-x[1], x[0]))[:k]
    assert [tuple(r) for r in Y.top_items(df, "password", k, counters).collect()] == want


def test_ties_at_the_last_place_are_candidates(spark):
    rows = [f"t{i}" for i in range(30) for _ in range(7)] + ["a"] * 50 + [f"r{i}" for i in range(3000)]
    df = strings(spark, rows)
    assert [r["password"] for r in Y.top_items(df, "password", 3, 400).collect()] == ["a", "t0", "t1"]


def test_a_hot_item_and_empty_input(spark):
    df = strings(spark, ["hot"] * 20_000 + [f"x{i}" for i in range(40_000)])
    found, least = Y.frequent_candidates(Y.frequent_items(df, "password", counters=100), 1)
    assert [r["key"] for r in found.collect()] == list(keys(spark, ["hot"])) and 0 < least <= 20_000
    assert Y.top_items(strings(spark, [None, None]), "password", 5).isEmpty()


def test_items_that_share_a_key_are_told_apart(spark, monkeypatch):
    rows = ["a"] * 50 + ["b"] * 50 + ["c"] * 90 + ["d"] * 10
    whole = Y.item_key
    monkeypatch.setattr(Y, "item_key", lambda item, seed=0: whole(item, seed) if seed
                        else F.xxhash64(F.expr(f"if({item} = 'b', 'a', {item})"), F.lit(0)))
    # As one key a and b have 100, so the best has 100 at least, and c could not be it.
    assert [tuple(r) for r in Y.top_items(strings(spark, rows), "password", 1).collect()] == [("c", 90)]


def test_only_candidates_are_shuffled(spark, zipf):
    name = keys(spark, zipf)
    found, least = Y.frequent_candidates(Y.frequent_items(strings(spark, zipf), "password", counters=500), 5)
    found = found.collect()
    assert 5 <= len(found) < 60 and least <= sorted(Counter(zipf).values())[-5]
    assert all(r["low"] <= Counter(zipf)[name[r["key"]]] <= r["high"] for r in found)


def test_parts_are_summarised_apart_and_merge(spark, zipf):
    df, name = strings(spark, zipf).withColumn("half", F.length("password") % 2), keys(spark, zipf)
    parts = Y.materialize(Y.frequent_items(df, "password", 2000, part="half"), "parts")
    assert {r[0] for r in parts.select("part").distinct().collect()} == {"0", "1"}
    one = Counter(x for x in zipf if len(x) % 2)
    for r in Y.frequent_candidates(parts.where("part = '1'"), 3)[0].collect():
        assert r["low"] <= one[name[r["key"]]] <= r["high"]
    best = sorted(Counter(zipf).items(), key=lambda x: (-x[1], x[0]))[:3]
    assert {x for x, _ in best} <= {name[r["key"]] for r in Y.frequent_candidates(parts, 3)[0].collect()}


def test_quantiles_of_merged_sketches(spark):
    df = spark.range(60_000).select(F.repeat(F.lit("x"), (F.pmod(F.xxhash64("id"), F.lit(3000))).cast("int")).alias("password"), "id")
    hist = profile.length_histogram(df)
    sketches = Y.length_sketches(df, F.pmod("id", F.lit(7)))
    assert sketches.count() == 7
    rows = Y.rank_errors(Y.merged_quantiles(sketches), hist).collect()
    assert len(rows) == 9 and all(r["n"] == 60_000 and r["rank_error"] <= 2 * Y.KLL_ERROR for r in rows)
    # A value from elsewhere has a large error.
    off = Y.rank_errors(Y.merged_quantiles(sketches).withColumn("value", F.col("value") + 600), hist)
    assert off.agg(F.min("rank_error")).first()[0] > 0.02
    some = Y.merged_quantiles(sketches.where("part < 2")).first()
    assert some["n"] == df.where("id % 7 < 2").count()


def digests(spark, lo, hi):
    return spark.range(lo, hi).select(F.unhex(F.sha1(F.col("id").cast("string"))).alias("digest"))


@pytest.mark.parametrize("n, lg", [(3000, 14), (80_000, 12)])
def test_set_sizes(spark, n, lg):
    part = F.pmod(F.xxhash64("digest"), F.lit(5))
    a, b = digests(spark, 0, n), digests(spark, n // 4 * 3, 2 * n).union(digests(spark, n // 4 * 3, n))
    row = Y.set_sizes(Y.digest_sketches(a, part, lg=lg), Y.digest_sketches(b, part, lg=lg), lg).first()
    true = {"candidates": n, "corpus": n + n // 4, "exposed": n // 4, "unexposed": n - n // 4}
    assert (row["error"] == 0) == (n == 3000)
    assert all(abs(row[c] - x) <= row["error"] for c, x in true.items()), row
    assert row["error"] < n / 5
