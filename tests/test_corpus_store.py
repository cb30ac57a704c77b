"""The corpus store: pruned reads, renewal in part; Bloom reduction before the exchange."""

import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F

from keysieve.operators import bloom
from keysieve.operators import breach as B
from keysieve.operators import breach_reduced as R
from keysieve.sources import breach as breach_src
from keysieve.sources import corpus_store as CS
from keysieve.sources import tables as T

ROW_GROUP = 1 << 14  # small, so that a file has many


def digest(text):
    return hashlib.sha1(text.encode()).digest()


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.range(200_000).select(F.unhex(F.sha1(F.concat(F.lit("pw"), F.col("id").cast("string")))).alias("digest"),
                                       (F.col("id") % 50 + 1).alias("breach_count"))


@pytest.fixture(scope="module")
def store(spark, corpus, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    rows = corpus.where(F.substring(F.hex("digest"), 1, 1) == "A")  # sixteen folders
    return root, CS.write_store(rows, f"{root}/s", row_group=ROW_GROUP)


def scan_metrics(df):
    """Metrics of the frame's file scans after it was computed."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        if name.startswith("Scan parquet"):
            m = node.metrics()
            out.append({k: m.apply(k).value() for k in ("numFiles", "numOutputRows") if m.contains(k)})
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_store_holds_the_corpus_in_order(spark, store, corpus):
    root, df = store
    assert df.count() == corpus.where(F.substring(F.hex("digest"), 1, 1) == "A").count()
    assert sorted(os.listdir(f"{root}/s/data"))[:2] == ["._SUCCESS.crc", "_SUCCESS"]
    assert {r[0] for r in df.select("range").distinct().collect()} == {f"A{x:X}" for x in range(16)}
    assert df.where(CS.range_of("digest") != F.col("range")).isEmpty()


def test_few_keys_read_few_rows(spark, store):
    _, df = store
    hits = [r["digest"] for r in df.orderBy(F.xxhash64("digest")).limit(4).collect()]
    keys = spark.createDataFrame([(bytearray(h),) for h in hits] + [(None,)], "digest binary")
    part = CS.prune(df, keys)
    assert {bytes(r["digest"]) for r in part.collect()} == set(map(bytes, hits))
    scan = scan_metrics(part)[0]
    # A row group of a few hundred rows for each key.
    assert 4 <= scan["numOutputRows"] <= 4 * 600 < df.count() / 5


def test_bloom_filters_leave_out_row_groups_that_bounds_do_not(spark, store):
    _, df = store
    rows = df.where("range = 'A0'").orderBy("digest").limit(500).collect()
    # Absent digests between present ones: inside the bounds of their row groups.
    absent = [bytes(r["digest"])[:-1] + bytes([bytes(r["digest"])[-1] ^ 1]) for r in rows[::25]]
    part = CS.prune(df, spark.createDataFrame([(bytearray(x),) for x in absent], "digest binary"))
    scan = scan_metrics(part)[0]
    plain = scan_metrics(df.where("range = 'A0'").select("digest"))[0]
    assert part.count() == 0 and scan["numOutputRows"] < plain["numOutputRows"] / 3


def test_equalities_are_pushed(spark, store):
    _, df = store
    keys = spark.createDataFrame([(bytearray(digest(f"x{i}")),) for i in range(40)], "digest binary")
    plan = CS.prune(df, keys)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "EqualTo(digest" in plan


def test_many_keys_and_no_keys(spark, store):
    _, df = store
    all_keys = df.select("digest")
    assert CS.prune(df, all_keys.where("range < 'A4'"), max_keys=100).count() == df.where("range < 'A4'").count()
    for none in (all_keys.limit(0), spark.createDataFrame([(None,)], "digest binary")):
        assert CS.prune(df, none).isEmpty()


@pytest.mark.parametrize("max_keys", [10, 10 ** 6])
def test_pruned_match_is_the_plain_match(spark, store, max_keys):
    _, df = store
    cand = spark.range(0, 220_000, 997).select(F.concat(F.lit("pw"), F.col("id").cast("string")).alias("password"))
    plain = B.match_breach(cand, df.select("digest", "breach_count"), how="left")
    got = R.match_pruned(cand, df, how="left", max_keys=max_keys)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def put(folder, prefix, suffixes, name=None):
    p = folder / (name or prefix)
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text("".join(f"{s}:{n}\n" for s, n in suffixes.items()))


def listing(seed, n=3):
    return {hashlib.sha1(f"{seed}{k}".encode()).hexdigest().upper()[:35]: k + 1 for k in range(n)}


def state(spark, root):
    df = breach_src.with_range(CS.read_store(spark, root))
    return {(r["prefix"], r["suffix"]): r["breach_count"] for r in df.collect()}


def want(files):
    return {(p, s): n for p, rows in files.items() for s, n in rows.items()}


def data_files(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{root}/data") for f in fs if f.startswith("part-")}


def test_sync_follows_the_files_and_leaves_other_folders(spark, tmp_path):
    src, root = tmp_path / "src", str(tmp_path / "store")
    files = {p: listing(p) for p in ("00001", "00002", "0A1B2", "7F000", "FFFFF")}
    for p, rows in files.items():
        put(src, p, rows, f"prefix={p}/part 0%.txt" if p == "7F000" else None)
    assert CS.sync(spark, root, str(src)) == ["00", "0A", "7F", "FF"]
    assert state(spark, root) == want(files) and CS.manifest_version(spark, root) == 1
    first = data_files(root)
    assert CS.sync(spark, root, str(src)) == [] and data_files(root) == first and CS.manifest_version(spark, root) == 1
    time.sleep(1.1)
    # One changed, one new in an untouched folder, one gone but not the last of its folder, one the last.
    files["0A1B2"] = listing("again", 5)
    files["11111"] = listing("new")
    put(src, "0A1B2", files["0A1B2"])
    put(src, "11111", files["11111"])
    for p in ("00002", "FFFFF"):
        (src / p).unlink()
        files.pop(p)
    assert CS.sync(spark, root, str(src)) == ["00", "0A", "11", "FF"]
    assert state(spark, root) == want(files)
    now = data_files(root)
    same = {f for f in first if "range=7F" in f}
    assert same and same <= now and not any("range=FF" in f for f in now)
    assert not {f for f in first if "range=0A" in f} & now
    # A rebuild from nothing is the same.
    CS.sync(spark, str(tmp_path / "again"), str(src))
    assert state(spark, str(tmp_path / "again")) == state(spark, root)


def test_a_run_that_died_before_its_manifest_is_repeated(spark, tmp_path, monkeypatch):
    src, root = tmp_path / "src", str(tmp_path / "store")
    files = {p: listing(p) for p in ("00001", "0A1B2")}
    for p, rows in files.items():
        put(src, p, rows)
    CS.sync(spark, root, str(src))
    time.sleep(1.1)
    files["00001"] = listing("other", 2)
    put(src, "00001", files["00001"])
    whole = CS.refresh

    def dies(*a, **kw):
        whole(*a, **kw)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(CS, "refresh", dies)
    with pytest.raises(RuntimeError):
        CS.sync(spark, root, str(src))
    monkeypatch.setattr(CS, "refresh", whole)
    assert CS.manifest_version(spark, root) == 1
    assert CS.sync(spark, root, str(src)) == ["00"]
    assert state(spark, root) == want(files) and CS.manifest_version(spark, root) == 2


def test_odd_files(spark, tmp_path):
    src, root = tmp_path / "src", str(tmp_path / "store")
    put(src, "0A1B2", {}, "0A1B2.txt")  # empty
    (src / "00001").write_bytes(b"junk\n" + next(iter(listing(1))).encode() + b":7\r\n\n")
    (src / "readme.log").write_text("no range file\n")
    CS.sync(spark, root, str(src))
    assert state(spark, root) == {("00001", next(iter(listing(1)))): 7}


# Bloom filters.

def test_filter_has_all_keys_and_few_others(spark):
    keys = spark.range(50_000).select(F.unhex(F.sha1(F.col("id").cast("string"))).alias("k"))
    for error in (0.1, 0.01, 0.001):
        shape = bloom.shape_for(50_000, error)
        f = bloom.build(keys.union(spark.createDataFrame([(None,)], "k binary")), "k", shape)
        assert bloom.reduced(keys, "k", f, shape).count() == 50_000
        others = spark.range(100_000, 300_000).select(F.unhex(F.sha1(F.col("id").cast("string"))).alias("k"))
        assert bloom.reduced(others, "k", f, shape).count() < 200_000 * error * 1.5


def test_merged_filters_are_the_filter_of_all(spark):
    keys = spark.range(3000).select(F.col("id"), F.sha1(F.col("id").cast("string")).alias("k"))
    shape = bloom.shape_for(3000)
    parts = [bloom.build(keys.where(F.col("id") % 3 == i), "k", shape) for i in range(3)]
    rows = lambda df: {r["bucket"]: bytes(r["bits"]) for r in df.collect()}
    assert rows(bloom.merge(*parts)) == rows(bloom.build(keys, "k", shape))


def test_a_filter_over_the_bound_is_not_applied(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("k"))
    shape = bloom.shape_for(10 ** 9)
    assert shape.bytes > bloom.MAX_BYTES and bloom.reduced(df, "k", df, shape) is df


def exchanged_rows(df, key):
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
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
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return sorted(out)


def test_fewer_corpus_rows_enter_the_exchange(spark, corpus):
    cand = spark.range(0, 400_000, 400).select(F.concat(F.lit("pw"), F.col("id").cast("string")).alias("password"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, reduced = B.match_breach(cand, corpus), R.match_bloom(cand, corpus)
        assert exchanged_rows(plain, "_digest_key")[-1] == 200_000
        # 500 of them have a candidate; one in a hundred others may pass.
        assert exchanged_rows(reduced, "_digest_key")[-1] < 1000 + 4000
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, reduced.collect()))
        left = [sorted(map(tuple, m(cand, corpus, how="left").collect())) for m in (B.match_breach, R.match_bloom)]
        assert left[0] == left[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_staged_keys_have_no_plaintext(spark, sf_dir):
    from keysieve.operators import breach_reduced
    seen = []
    whole = breach_reduced.materialize
    breach_reduced.materialize = lambda df, name: seen.append(df.columns) or whole(df, name)
    try:
        R.match_bloom(T.candidates(spark, sf_dir), T.breach(spark, sf_dir))
    finally:
        breach_reduced.materialize = whole
    assert seen == [["digest"], ["bucket", "bits"]]


def test_written_range_files_lie_by_leading_byte_each_from_one_task(spark, tmp_path):
    """So that a commit moves, and a listing starts from, 256 folders at most."""
    from keysieve.plans.q_corpus import write_range_files
    lines = spark.range(900).select(F.upper(F.substring(F.sha1((F.col("id") % 600).cast("string")), 1, 5)).alias("prefix"),
                                    F.format_string("%035X:%d", "id", F.col("id") + 1).alias("value"))
    path = str(tmp_path / "ranges")
    write_range_files(lines, path)
    top = [n for n in os.listdir(path) if not n.startswith((".", "_"))]
    assert 128 < len(top) <= 256 and all(len(n) == len("lead=0A") and n.startswith("lead=") for n in top)
    for n in top:
        folder = os.path.join(path, n)
        assert all(p.startswith(f"prefix={n[5:]}") for p in os.listdir(folder))
        assert len({f.split("-")[1] for _, _, fs in os.walk(folder) for f in fs if f.startswith("part-")}) == 1
    prefixes = {r[0] for r in lines.select("prefix").collect()}
    assert {r["prefix"] for r in CS.list_files(spark, path).collect()} == prefixes
    read = breach_src.read_breach_ranges(spark, path)
    assert sorted(map(tuple, read.collect())) == sorted(
        (r["prefix"], r["value"].split(":")[0], int(r["value"].split(":")[1])) for r in lines.collect())
