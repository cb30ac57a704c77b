import random
import re

from pyspark.sql import functions as F

from llm_helpers import repeat_words

from keysieve.llm import decontam as D


def shingles(text, k=5):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, items, t=0.8):
    out = set()
    for d, x in docs:
        for i, y in items:
            s = shingles(y)
            # A short item has one shingle, of all its words.
            ds = shingles(x, min([5, *(len(v.split()) for v in s)]))
            if s and len(s & ds) >= t * len(s) - 1e-9:
                out.add((d, i, len(s & ds), len(s)))
    return out


def run(spark, documents, docs, items, **kw):
    items = spark.createDataFrame(items, "item_id long, text string").withColumn("w", F.lit(1))
    return {tuple(r)[:4] for r in D.contained(documents(docs), items, **kw).collect()}


def test_random_passages(spark, documents, monkeypatch):
    r = random.Random(7)
    items = [(i, repeat_words(r.randint(1, 40), i, tuple(f"v{k}" for k in range(60)))) for i in range(40)]
    docs = [(i, repeat_words(r.randint(0, 80), 100 + i)) for i in range(20)]
    for i, y in items:
        w = y.split()
        for _ in range(r.randint(0, len(w) // 8)):
            w[r.randrange(len(w))] = "other"
        docs.append((100 + i, f"{repeat_words(50, i)} -- {' '.join(w).upper()}. {repeat_words(r.randint(0, 3000), i)}"))
    want = brute(docs, items)
    assert len(want) > 10
    assert run(spark, documents, docs, items) == want
    assert run(spark, documents, docs, items, block_entries=20) == want
    monkeypatch.setattr(D, "MAX_BROADCAST", 0)
    monkeypatch.setattr(D, "BROADCAST_SHINGLES", 0)
    assert run(spark, documents, docs, items) == want


def test_odd_rows(spark, documents, odd_rows):
    items = [(0, None), (1, ""), (2, "..."), (3, "one, two!"), (4, "ONE"), (None, "ünï cödé text"),
             (5, odd_rows[10][1]), (6, "a a a a a a a"), (6, "a a a a a a a"), (7, odd_rows[18][1])]
    assert run(spark, documents, odd_rows, items) == brute(odd_rows, items)
    assert run(spark, documents, [], items) == set() == run(spark, documents, odd_rows, [])


def test_short_items_inside_long_documents(spark, documents):
    items = [(1, "lazy"), (2, "lazy dog"), (3, "the lazy dog"), (4, "lazy dog and more"), (5, "jumps over the lazy dog"),
             (6, "more"), (7, "dog lazy"), (8, "LAZY, dog!"), (9, "absent"), (10, "over the lazy dog and more or less today")]
    docs = [(1, "a quick brown fox jumps over the lazy dog and more of the same"), (2, "lazy"), (3, "The lazy dog"),
            (4, "lazydog more"), (None, "lazy dog"), (5, None), (6, repeat_words(5000, 3) + " lazy dog " + repeat_words(5000, 4))]
    got = run(spark, documents, docs, items)
    assert got == brute(docs, items)
    assert {i for d, i, *_ in got if d == 1} == {1, 2, 3, 4, 5, 6, 8}


def test_sketch_covers_what_a_match_may_lack(spark):
    items = spark.createDataFrame([(i, repeat_words(n, i, tuple(f"v{k}" for k in range(500))))
                                   for i, n in enumerate((1, 5, 6, 9, 14, 15, 30, 59, 60, 200))], "item_id long, text string")
    for r in D.sketches(items).collect():
        assert len(r["sketch"]) >= r["n_shingles"] - -(-r["n_shingles"] * 8 // 10) + 1
