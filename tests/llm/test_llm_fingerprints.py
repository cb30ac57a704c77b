import hashlib
import random

import numpy as np
import pytest
from llm_helpers import repeat_words
from pyspark.sql import functions as F

from keysieve.llm import fingerprints as P


def one(t):
    return P.to_hex(*P.sums([t]))[0]


def like(a, b):
    return float(P.likeness(P.from_hex([a]), P.from_hex([b]))[0])


def brute(rows):
    """Rows in order, each with its edit by the next text, fingerprints taken one text at a time."""
    key = lambda r: (r[0] is None, -(r[0] or 0))
    rows = sorted(((d, t or "") for d, t in rows), key=key)
    out = []
    for k, (d, t) in enumerate(rows):
        f = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edit = t[:len(t) - half] + f[:half]
        out.append((d, len(t), hashlib.sha256(edit.encode()).hexdigest(), one(t), one(edit),
                    round(like(one(t), one(edit)), 9), round(like(one(t), one(f)), 9)))
    return sorted(out, key=str)


def got(df):
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in map(tuple, df.collect())), key=str)


@pytest.fixture(scope="module")
def pages():
    r = random.Random(3)
    rows = []
    for d in range(300):
        lines = [repeat_words(r.randint(0, 30), 1000 * d + k) for k in range(r.randint(1, 9))]
        rows.append((d * 3 - 200, "\n".join(lines) + r.choice(["", "\n", "☃ 😀\r\n"])))
    return rows


def test_each_row_beside_the_next(documents, pages, odd_rows):
    distinct = {d: t for d, t in odd_rows if d is not None}  # ids apart from those of the pages
    rows = [(d, t) for d, t in pages if d not in distinct] + list(distinct.items()) + [(None, "no id\nhere")]
    assert got(P.edited_fingerprints(documents(rows))) == brute(rows)


def test_one_row_no_rows_and_repeated_rows(documents):
    assert got(P.edited_fingerprints(documents([(5, "ab\ncd")]))) == brute([(5, "ab\ncd")])
    out = P.edited_fingerprints(documents([]))
    assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema) == P.RESULT.replace("long", "bigint")
    assert out.isEmpty()
    rows = [(7, "same text of some words")] * 500 + [(None, "x")] * 300 + [(7, "other text of some words")]
    res = P.edited_fingerprints(documents(rows))
    assert res.count() == 801
    # Among equal rows the next one is equal, so all but the last of each kind are like it.
    assert res.where("doc_id = 7 and near_next = 1").count() >= 498
    assert res.where("doc_id is null and near_next = 1").count() == 299


def test_ranges_of_any_number_give_the_same(documents, spark, pages):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    want = got(P.edited_fingerprints(documents(pages)))
    try:
        for n in ("1", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert got(P.edited_fingerprints(documents(pages))) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_order_does_not_matter_and_content_does(pages):
    for _, t in pages[:50]:
        lines = t.split("\n")
        assert one(t) == one("\n".join(sorted(lines)))
        assert one(t) != one(t + "\n") != one(t + "\nx")
        assert like(one(t), one(t)) == 1.0
    assert one("a\nb") != one("a b") != one("ab") and one("x\nx") != one("x")


def test_changes_without_the_text(documents, spark, pages):
    prints = P.fingerprints(documents(pages))
    texts = {d: t.split("\n") for d, t in pages}
    changes, r = [], random.Random(1)
    for d, lines in list(texts.items())[::3]:
        gone = r.choice(lines)
        lines.remove(gone)
        lines.insert(0, f"new paragraph of {d} with some words in it")
        lines += ["twice"] * 2
        changes += [(d, gone, -1), (d, lines[0], 1), (d, "twice", 2)]
    changes += [(10 ** 6, "of no document", 1), (None, "x", 1)]
    df = spark.createDataFrame(changes, "doc_id long, paragraph string, n int")
    # A document left without any paragraph is not a text, so the rest is compared as a sum.
    want = {d: P.to_hex(*(x.sum(axis=0, dtype=x.dtype)[None] for x in P.sums(lines)))[0] for d, lines in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in P.change(prints, df).collect()} == want


def test_likeness_follows_the_shared_shingles():
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    errors = []
    for share in (0.0, 0.25, 0.5, 0.75, 0.9, 1.0):
        for _ in range(30):
            base = [" ".join(word() for _ in range(12)) for _ in range(40)]
            other = [p if k < share * 40 else " ".join(word() for _ in range(12)) for k, p in enumerate(base)]
            errors.append(abs(like(one("\n".join(base)), one("\n".join(other))) - share))
    assert np.mean(errors) < 0.05 and max(errors) < 0.35


def test_windows_do_not_change_hashes(monkeypatch, pages):
    text = "\n".join(t for _, t in pages) + " " + "y" * 3000 + " end\n"
    want = one(text)
    for window in (1, 7, 64, 1000):
        monkeypatch.setattr(P, "WINDOW", window)
        assert one(text) == want, window


def test_a_shingle_more_than_a_lane_of_16_bits(pages):
    text = "a " * 200_000
    assert like(one(text), one(text[:len(text) // 2])) == pytest.approx(0.8, abs=0.01)


def test_equal_texts_have_equal_rows(documents):
    res = P.fingerprints(documents([(1, "q w e"), (2, "q w e"), (3, None), (4, "")]))
    assert res.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n = 2").count() == 2
