import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from llm_helpers import repeat_words

from keysieve.llm import bwt_merge as B
from keysieve.llm import suffix_dedup as S

LAST = float("inf")


def brute(rows, n=50):
    first = {}
    coded = [((LAST if d is None else d), (t or "").encode()) for d, t in rows]
    for d, b in coded:
        for i in range(len(b) - n + 1):
            w = b[i:i + n]
            first[w] = min(first.get(w, d), d)
    out = []
    for (d, b), (doc, _) in zip(coded, rows):
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if first[b[i:i + n]] < d:
                gone[i:i + n] = b"\1" * n
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df, **kw):
    out = S.suffix_dedup(df, **kw).collect()
    for r in out:
        assert r["n_bytes"] == len(r["kept"]) + sum(r["span_lengths"])
    return sorted(((r["doc_id"], r["n_bytes"], sum(r["span_lengths"]), len(r["span_starts"]),
                    hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in out), key=str)


@pytest.mark.parametrize("block_bytes", [300, 3000, 1 << 20])
def test_random_passages(documents, block_bytes):
    r = random.Random(block_bytes)
    base = [repeat_words(r.randint(5, 80), i) for i in range(6)]
    rows = []
    for i in range(50):
        x, y = r.choice(base), r.choice(base)
        rows.append((r.choice([i, i, i, 7, None]), r.choice(
            [x, x[:r.randint(0, len(x))] + y[r.randint(0, len(y)):], f"{x} {y}", "ab " * r.randint(0, 60), "", None])))
    assert run(documents(rows), block_bytes=block_bytes) == brute(rows)


def test_odd_rows(documents, odd_rows):
    rows = [(d, t if t is None else t[:6000]) for d, t in odd_rows]
    assert run(documents(rows), block_bytes=10_000) == brute(rows)
    assert S.suffix_dedup(documents([])).isEmpty()


def test_exactly_fifty_bytes(documents):
    p = "0123456789" * 5
    rows = [(1, "x" + p), (0, "y" + p + "z"), (2, p[:49] + "!"), (3, "é" * 25), (4, "-" + "é" * 25)]
    assert run(documents(rows)) == brute(rows)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert run(docs, block_bytes=60_000) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_merge_sorts_all_suffixes():
    r = random.Random(3)
    for _ in range(40):
        strings = [bytes(r.choice(b"ab" if r.random() < 0.5 else b"abcdef") for _ in range(r.randint(50, 90)))
                   for _ in range(r.randint(1, 10))]
        strings += [s[5:] + b"xyxyx" for s in strings[:3]]
        bounds = np.r_[0, np.cumsum([len(s) for s in strings])]
        cuts = [0, *sorted(r.sample(range(1, len(strings)), min(2, len(strings) - 1))), len(strings)]
        position, common = B.merged(np.frombuffer(b"".join(strings), np.uint8), bounds, np.array(cuts))

        def suffix(p):
            k = int(np.searchsorted(bounds, p, "right")) - 1
            return (strings[k] * 3)[p - bounds[k]:][:50]

        got = [suffix(p) for p in position]
        assert got == sorted(got) and sorted(position) == list(range(bounds[-1]))
        for a, b, c in zip(got, got[1:], common[1:]):
            assert c == next((q for q in range(5) if a[10 * q:10 * q + 10] != b[10 * q:10 * q + 10]), 5)


PHRASE = "Licensed under the Apache License, Version 2.0."


def around(n, seed=1):
    """Documents of their own that share a phrase of 47 bytes; some repeat an earlier one's surroundings."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(40))
    pairs = [(word(), word()) for _ in range(n)]
    return [(i, f"{a} {PHRASE} {b}" if i % 7 else f"{pairs[i // 2][0]} {PHRASE} {b}") for i, (a, b) in enumerate(pairs)]


def test_frequent_phrase_is_dealt_to_all_buckets():
    rows, buckets, most = around(3000), 16, {}
    blocks = [pa.table({"block": pa.array([k] * len(part), pa.int32()), "doc_id": [d for d, _ in part],
                        "text": [t for _, t in part]}) for k in range(3) if (part := rows[k::3])]
    told = S._teller(20_000)(pa.concat_tables([S._asker(1)(b) for b in blocks]))
    for b in blocks:
        k = b["block"][0].as_py()
        for r in S._sender(buckets)(b, told.filter(pa.compute.equal(told["block"], k))).to_pylist():
            most[r["bucket"]] = most.get(r["bucket"], 0) + len(S._unpacked(r["payload"], 5)[2])
    assert len(most) == buckets and max(most.values()) < 1.5 * sum(most.values()) / buckets


@pytest.mark.parametrize("hot_bytes", [0, 300, 5000])
def test_hot_minimisers_lose_no_link(documents, hot_bytes):
    rows = around(150) + [(None, "= " * 70 + PHRASE), (500, "= " * 90), (3, "= " * 60 + "x"), (501, "= " * 33 + PHRASE)]
    assert run(documents(rows), block_bytes=4000, hot_bytes=hot_bytes) == brute(rows)


def test_equal_rows_are_spread_over_blocks(spark):
    rows = spark.range(100_000).selectExpr("cast(null as long) as doc_id", "'one and the same text' as text")
    sizes = [r["count"] for r in S.place(rows, 100).groupBy("block").count().collect()]
    assert sum(sizes) == 100_000 and len(sizes) == 100 and max(sizes) <= 2000


@pytest.mark.parametrize("repeats", [0, 3])
def test_repeated_rows_cover_no_more_than_one(documents, repeats):
    x, y = repeat_words(40, 1), repeat_words(40, 2)
    rows = [(None, x)] * 60 + [(4, x)] * 30 + [(3, f"{y} {x}"), (9, y), (9, y), (None, f"{x} {y}"), (2, None), (2, None), (5, "")] * 5
    assert run(documents(rows), block_bytes=800, repeats=repeats) == brute(rows)
    assert run(documents(rows[60:]), block_bytes=800, repeats=repeats) == brute(rows[60:])
