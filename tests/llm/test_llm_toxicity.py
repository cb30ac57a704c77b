import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from keysieve.llm import toxicity as T


@pytest.fixture(scope="module")
def model(spark):
    d = "/root/testdata/sf0.1"
    return T.fit(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))


def test_held_out_documents(spark, model):
    d = "/root/testdata/sf0.1"
    out = T.score(spark.read.parquet(f"{d}/documents.parquet"), model).join(
        spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in out.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 0.8 * (n[1, 1] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.02 * n[0, 0]


def test_disguised_words_are_restored(model):
    lm = model.lm.tolist()
    for written, word in (("1d10t", "idiot"), ("m0r0n", "moron"), ("stuuuupid", "stupid"), ("l0$er", "loser"),
                          ("w0rthl3ss", "worthless"), ("i.d.i.o.t", "idiot"), ("tr@sh", "trash")):
        assert word in T.restore(written, lm)
    texts = ["such an 1d10t he is", "what a l o s e r", "m.o.r.o.n", "T R A S H", "an idiot."]
    assert (model.score(pd.Series(texts)) > T.THRESHOLD).all()


def test_words_of_signs_alone_at_the_ends_and_set_apart(model):
    r = T.Reader(model.lm)
    for written, word in (("@$$", "ass"), ("@55", "ass"), ("!diot", "idiot"), ("(unt,", "cunt"), ("\"!d!0t!\"", "idiot"),
                          ("evi!", "evil"), ("y o u i d i o t", "idiot"), ("m o r o n   i d i o t", "moron"),
                          ("m o r o n   i d i o t", "idiot")):
        assert word in r.words(written), written
    for number in ("455", "$455", "(455)", "4,550.55", "+1-455", "10:45!", "$$$$", "!!!"):
        assert not r.words(number), number
    texts = ["oh !diot", "y o u i d i o t", "m o r o n   y o u"]
    assert (model.score(pd.Series(texts)) > T.THRESHOLD).all()


def test_no_text_gets_the_base_score(model):
    s = model.score(pd.Series(["", None, "the of and", "555-7280", "4348649190265535", "a" * 200_000, "☃😀"]))
    assert (s == s[0]).all() and 0 <= s[0] < T.THRESHOLD


def test_trigram_counts_are_those_of_the_texts(spark, documents):
    df = documents([(0, "abé"), (1, None), (2, "A1b")]).select(F.coalesce("text", F.lit("")).alias("text"))
    got = T.count_trigrams(df)
    want = np.zeros_like(got)
    for t in ("abé", "", "a1b"):
        c = [T.CLASS.get(x, 0) for x in f"  {t}  "]
        for x in zip(c, c[1:], c[2:]):
            want[x] += 1
    got[0, 0, 0] = want[0, 0, 0] = 0  # blanks between texts
    assert (got == want).all()
    p = np.exp(T.language_model(got)).sum(2)
    assert np.allclose(p, 1, atol=1e-3)


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int").selectExpr("*", "0 as quality", "'x' as text")


def test_learns_only_from_training_folds(spark, documents):
    r = random.Random(1)
    rows, lab = [], []
    for i in range(600):
        toxic, held = i % 4 == 0, zlib.crc32(str(i).encode()) % 3 == 1
        mark = ("bad" if not held else "worse") if toxic else "fine"
        rows.append((i, " ".join(r.choice(["ba", "ta", "ka", "la"]) + str(i) for _ in range(3)) + f" {mark} word{chr(97 + r.randrange(20))}"))
        lab.append((i, int(toxic)))
    m = T.fit(documents(rows), labelled(spark, lab))
    assert "bad" in m.marks and "worse" not in m.marks and "fine" not in m.marks
    out = {x["doc_id"]: x for x in T.score(documents(rows), m).collect()}
    for i, t in rows:
        held = zlib.crc32(str(i).encode()) % 3 == 1
        assert out[i]["held_out"] == held and out[i]["predicted"] == int(i % 4 == 0 and not held)


def test_odd_rows(spark, documents, odd_rows):
    for lab in ([], [(0, 1)], [(0, None), (None, 1), (0, 0)], [(0, 1), (0, 0), (2, 0), (3, 0), (4, 1)]):
        m = T.fit(documents(odd_rows), labelled(spark, lab))
        out = T.score(documents(odd_rows), m).collect()
        assert len(out) == len(odd_rows) and all(0 <= x["score"] <= 1 for x in out)
        assert all(x["held_out"] for x in out if x["doc_id"] is None)
    empty = documents([])
    m = T.fit(empty, labelled(spark, []))
    assert T.score(empty, m).isEmpty() and T.without_toxic(empty, m).columns == empty.columns


def test_copies_of_a_text_count_once(spark, documents):
    train = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, "an odd remark " * 8 if k < 40 else f"text {i} of its own " + "ab" * (i % 7)) for k, i in enumerate(train)]
    m = T.fit(documents(rows), labelled(spark, [(i, int(k < 40)) for k, i in enumerate(train)]))
    assert not m.marks


def probe(header):
    """1,200 labelled, pairwise different documents, 200 of them toxic with one mark."""
    r = random.Random(3)
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 3 != 1][:1200]
    own = lambda: " ".join("".join(r.choice("aeioubdgkl") for _ in range(6)) for _ in range(40))
    rows = [(i, header + own() + (" clearmark " if k < 200 else " ") + own()) for k, i in enumerate(ids)]
    return rows, [(i, int(k < 200)) for k, i in enumerate(ids)]


@pytest.mark.parametrize("header", ["", "A header of one site, the same on all of its pages, of well over sixty-four characters. "])
def test_a_common_header_makes_no_family(spark, documents, header):
    rows, lab = probe(header)
    docs, labels = documents(rows), labelled(spark, lab)
    assert T.training_ids(docs, labels).count() == 1200
    m = T.fit(docs, labels)
    assert "clearmark" in m.marks
    assert (m.score(pd.Series([t for _, t in rows[:200]])) > T.THRESHOLD).all()


def test_verified_near_copies_count_once(spark, documents):
    r = random.Random(8)
    word = lambda: "".join(r.choice("aeioubdgkl") for _ in range(6))
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 3 != 1]
    base = [[word() for _ in range(120)] for _ in range(5)]
    rows, lab = [], []
    for k, i in enumerate(ids[:600]):
        w = list(base[k % 5])
        w[r.randrange(120)] = word()  # one word of 120: five of 116 shingles differ
        rows.append((i, " ".join(w)))
        lab.append((i, 0))
    rows += [(ids[600], rows[0][1]), (ids[601], None), (ids[602], ""), (ids[603], rows[0][1])]
    lab += [(ids[600], 1), (ids[601], 0), (ids[602], 0), (ids[603], 1)]
    got = [tuple(x) for x in T.training_ids(documents(rows), labelled(spark, lab)).collect()]
    # Five families, the toxic copies and the empty texts: one of each, or little more.
    assert 7 <= len(got) <= 10 and sum(t for _, t in got) == 1


def paths(token):
    """All readings of a lattice and their costs."""
    out = [("", 0.0)]
    for options in T.lattice(token):
        out = [(t + x, c + k) for t, c in out for x, k in options]
    return out


def test_restore_finds_the_likeliest_reading(model):
    lm, r = model.lm.tolist(), random.Random(5)
    for _ in range(300):
        token = "".join(r.choice("abdeilost013457@$!*.") for _ in range(r.randint(1, 6)))

        def value(text, cost):
            c = [0, 0, *(T.CLASS.get(x, T.N_CLASSES - 1) for x in text), 0]
            return cost + sum(lm[a][b][d] for a, b, d in zip(c, c[1:], c[2:]))

        best = max(value(t, c) for t, c in paths(token))
        top = T.restore(token, lm, best=1)
        got = max((value(t, c) for t, c in paths(token) if t.split() == top), default=None)
        assert got == pytest.approx(best, abs=1e-4), token


def test_score_is_a_recount_of_marks(spark, model):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts, reader = [x["text"] for x in rows], T.Reader(model.lm)
    for t, s in zip(texts, model.score(pd.Series(texts)), strict=True):
        marks = {m for w in reader.words(t or "") for m in T.marks_of(w)} & model.marks.keys()
        clean = 1 - model.base
        for m in marks:
            clean *= 1 - model.marks[m]
        assert s == pytest.approx(1 - clean, abs=1e-9)
