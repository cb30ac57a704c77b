import random

import numpy as np
import pytest
import xxhash

from keysieve.llm import simhash as S
from keysieve.llm.components import components


def brute_fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in sh]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_classes(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                comp[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for k, (x, _) in enumerate(rows) if find(k) == find(i) and x is not None]
        out.append((d, f"{fps[i]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def test_every_pair_within_three_bits_meets():
    r = random.Random(1)
    for _ in range(2000):
        a = b = r.getrandbits(64)
        for i in r.sample(range(64), r.randint(0, 3)):
            b ^= 1 << i
        at, key = S.fuzzy_keys(np.array([a, b], np.uint64))
        assert set(key[at == 0]) & set(key[at == 1])


def test_code_is_perfect():
    _, error, offsets = S.golay_tables()
    assert len(np.unique(error)) == 2048 and np.bitwise_count(error).max() == 3
    assert sorted({(row != 0).sum() for row in offsets}) == [0, 5]


def test_odd_rows(documents, odd_rows):
    got = sorted((tuple(r) for r in S.simhash_classes(documents(odd_rows)).collect()), key=str)
    assert got == brute_classes(odd_rows)


def test_near_copies(documents):
    r = random.Random(4)
    base = [[f"w{r.randint(0, 400)}" for _ in range(300)] for _ in range(8)]
    rows = []
    for i in range(150):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = "new"
        rows.append((i, " ".join(w)))
    got = sorted((tuple(x) for x in S.simhash_classes(documents(rows)).collect()), key=str)
    assert got == brute_classes(rows)


def test_large_keys_are_dealt_out(spark):
    r = random.Random(6)
    base = [r.getrandbits(63) for _ in range(3)]
    fps = sorted({b ^ sum(1 << i for i in r.sample(range(63), r.randint(0, 3))) for b in base for _ in range(120)})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    want = {(x["node"], x["root"]) for x in components(S.links(df)).collect()}
    for max_run in (1, 7, 40):
        got = {(x["node"], x["root"]) for x in components(S.links(df, max_run=max_run)).collect()}
        assert len({a for a, _ in got}) == len({a for a, _ in want}) == len(fps)
        groups = lambda c: {frozenset(a for a, x in c if x == k) for _, k in c}
        assert groups(got) == groups(want)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted((tuple(r) for r in S.simhash_classes(docs).collect()), key=str)
    assert got == brute_classes([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_forest_spans_a_dense_run():
    base, r = np.uint64(0x0123456789ABCDEF), random.Random(2)
    fp = np.unique(np.array([base ^ np.uint64(1 << r.randrange(64) | 1 << r.randrange(64)) for _ in range(500)]))
    a, b = S.forest(fp, 3)
    assert len(a) == len(fp) - 1 and (np.bitwise_count(a ^ b) <= 3).all()
    x, _ = S.links_of_runs(np.zeros(len(fp), np.int64), fp, 3)
    assert len(x) == len(fp) - 1


def test_components_of_paths_and_stars(spark):
    r = random.Random(3)
    path = [(i, i + 1) for i in range(200)]
    star = [(10_000, 10_001 + i) for i in range(300)]
    rest = [(r.randint(20_000, 20_200), r.randint(20_000, 20_200)) for _ in range(150)]
    rows = [(a, b) if r.random() < 0.5 else (b, a) for a, b in path + star + rest]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    up = {}

    def find(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in rows:
        if a != b:
            up[find(a)] = find(b)
    assert set(got) == set(up)
    assert len({(got[i], find(i)) for i in up}) == len({find(i) for i in up}) == len(set(got.values()))


def test_empty_table_and_bad_parameter(documents):
    assert S.simhash_classes(documents([])).isEmpty()
    with pytest.raises(ValueError):
        S.simhash_classes(documents([]), max_bits=4)
